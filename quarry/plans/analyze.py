"""Analyse batch (E2): raw records -> enriched records.

eligible (status ok, non-blank text) -> URL key -> first occurrence per key
-> anti join with keys already enriched -> prompt -> annotator -> native
validation -> first valid attempt -> enriched or failed record -> success
limit -> summary counters.

The anti join runs before the annotator: Catalyst cannot push a join
through a Python map, so the expensive model stage only ever sees new keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.analysis import build_prompt
from quarry.functions.text import not_blank
from quarry.functions.urls import url_key
from quarry.operators.annotate import (DEFAULT_MODEL, Annotator, first_valid_attempt,
                                       offline_annotator, validate_responses)
from quarry.operators.dedup import seen_keys
from quarry.operators.incremental import only_new
from quarry.operators.limits import process_until_successes
from quarry.session import materialize
from quarry.schemas import ENRICHED_FIELDS, RAW_FIELDS


@dataclass
class AnalyzeResult:
    records: DataFrame   # new ENRICHED records (with ord)
    summary: DataFrame   # processed, failed, skipped_already


def eligible_for_analysis(raw: DataFrame) -> DataFrame:
    return raw.where((F.col("status") == "ok") & not_blank(F.col("text")))


def candidates(raw: DataFrame, prior_enriched: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(eligible rows with key, first new occurrence per key).  First
    occurrences and the anti join work on (key, ordinal); texts are read for
    the rows that remain."""
    elig = eligible_for_analysis(raw).withColumn("url_key", url_key(F.col("url")))
    firsts = elig.groupBy("url_key").agg(F.min("ord").alias("ord"))
    if prior_enriched is not None:
        firsts = only_new(firsts, seen_keys(prior_enriched), "url_key")
    wide = elig.select("url_key", "ord", *RAW_FIELDS).join(firsts, ["url_key", "ord"], "left_semi")
    return elig, wide.dropDuplicates(["url_key", "ord"])


def annotate_records(cands: DataFrame, annotator: Annotator | None = None,
                     model: str = DEFAULT_MODEL) -> DataFrame:
    """ENRICHED records for candidate raw rows (key column ``url_key``)."""
    annotator = annotator or offline_annotator
    calls = cands.select(F.col("url_key").alias("key"),
                         build_prompt(F.col("title"), F.col("text")).alias("prompt"),
                         "title", "text")
    outcome = first_valid_attempt(validate_responses(annotator(calls)))
    outcome = outcome.select(F.col("key").alias("url_key"), F.col("valid").alias("o_valid"),
                             F.col("error").alias("o_error"), F.col("summary").alias("o_summary"),
                             F.col("topics").alias("o_topics"))
    joined = cands.join(outcome, "url_key", "left")
    ok = F.coalesce(F.col("o_valid"), F.lit(False))
    err = F.coalesce(F.col("o_error"), F.lit("RuntimeError: no model output"))
    cols = {c: F.col(c) for c in RAW_FIELDS}
    cols["status"] = F.when(ok, F.lit("ok")).otherwise(F.lit("failed"))
    cols["error"] = F.when(ok, F.col("error")).otherwise(F.concat(F.lit("llm error: "), err))
    cols["summary"] = F.when(ok, F.col("o_summary"))
    cols["topics"] = F.when(ok, F.col("o_topics")).otherwise(F.array().cast("array<string>"))
    cols["llm_model"] = F.lit(model)
    return joined.select("ord", *[cols[c].alias(c) for c in ENRICHED_FIELDS])


def analyze(raw: DataFrame, prior_enriched: DataFrame | None = None, *, limit: int | None = None,
            annotator: Annotator | None = None, model: str = DEFAULT_MODEL) -> AnalyzeResult:
    elig, firsts = candidates(raw, prior_enriched)
    # the model stage's input feeds the model and the join back to the raw
    # columns: checkpoint it once (also makes the model stage restartable)
    firsts = materialize(firsts)
    if limit is None:
        # stored once: records and counters read it, the model must not run again
        records = materialize(annotate_records(firsts, annotator, model))
    else:
        # annotate only as far as needed for `limit` successes (failures and
        # skips do not count), each window once
        records, cutoff = process_until_successes(
            firsts, limit, lambda c: annotate_records(c, annotator, model), F.col("status") == "ok")
        if cutoff is not None:
            elig = elig.where(F.col("ord") <= F.lit(cutoff))
    outcome = elig.select("ord").join(records.select("ord", "status"), "ord", "left")
    summary = outcome.agg(F.count_if(F.col("status") == "ok").alias("processed"),
                          F.count_if(F.col("status") == "failed").alias("failed"),
                          F.count_if(F.col("status").isNull()).alias("skipped_already"))
    return AnalyzeResult(records, summary)
