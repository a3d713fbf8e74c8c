"""End-to-end ingest (E5) for a *set* of URLs: one status row per URL key.

For every key: skip when already analysed and indexed; scrape when not yet
scraped; take the latest usable raw record (earlier output or this run's);
analyse it; take the usable enriched record; index it unless its id is stored.
A key that was analysed but never indexed is indexed from its stored enriched
record.  Each URL stops at the first stage that fails, and its row names the
stage.  All stages are joins keyed by URL key, so every URL is handled by the
same few shuffles whatever the size of the set; earlier records are reduced to
the keys at work before anything wide moves.

``ingest`` computes; ``ingest_into`` also adds what it made to the tables of a
folder, all of them in one commit, so a rerun adds nothing and an interrupted
run leaves nothing behind.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import not_blank
from quarry.functions.urls import url_key
from quarry.operators.dedup import latest_matching, seen_keys
from quarry.operators.embed import Embedder, embed
from quarry.operators.incremental import flag_existing, only_new
from quarry.operators.annotate import Annotator
from quarry.operators.scrape import scrape_records
from quarry.plans.analyze import annotate_records
from quarry.plans.index import vector_documents
from quarry.schemas import ENRICHED, ENRICHED_FIELDS, RAW, RAW_FIELDS, VECTOR_ROW
from quarry.session import materialize
from quarry.sources import commits
from quarry.sources.pages import fetch

# Offset that places this run's records after every earlier record.
RUN_ORD_OFFSET = 1 << 40
WITH_ORD = [T.StructField("ord", T.LongType())]


@dataclass
class IngestResult:
    status: DataFrame     # url_key, status, stage, skipped, reason, index_added
    raw: DataFrame        # new RAW records (with ord)
    enriched: DataFrame   # new ENRICHED records (with ord)
    vectors: DataFrame    # new VECTOR_ROW rows


def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``ord`` and the fields of ``schema``; those that ``df`` lacks are null."""
    fields = [f for f in schema.fields]
    return df.select("ord", *[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def latest_usable_raw(raw: DataFrame, keys: DataFrame) -> DataFrame:
    """Latest raw record of each of ``keys`` with status ok and non-blank text."""
    keyed = raw.withColumn("url_key", url_key(F.col("url"))).join(keys.select("url_key"), "url_key", "left_semi")
    return latest_matching(keyed, "url_key", (F.col("status") == "ok") & not_blank(F.col("text")))


def _usable_enriched(enriched: DataFrame) -> DataFrame:
    return enriched.where((F.col("status") == "ok") & not_blank(F.col("summary")))


def ingest(keys: DataFrame, snapshots: DataFrame, prior_raw: DataFrame, prior_ai: DataFrame,
           stored_ids: DataFrame, *, min_chars: int = 300, run_ts: str, ord_offset: int = RUN_ORD_OFFSET,
           annotator: Annotator | None = None, embedder: Embedder | None = None) -> IngestResult:
    """``keys``: (ord, url_key); ``snapshots``: snapshot rows as they come."""
    stored_keys = stored_ids.select(url_key(F.col("url")).alias("url_key"))
    k = flag_existing(keys, seen_keys(prior_ai), "url_key", "analysed")
    k = flag_existing(k, seen_keys(prior_raw), "url_key", "scraped")
    k = materialize(flag_existing(k, stored_keys, "url_key", "stored"))
    work = k.where(~F.col("analysed"))
    to_scrape = work.where(~F.col("scraped")).select("ord", "url_key")
    new_raw = materialize(scrape_records(fetch(to_scrape, snapshots), min_chars, run_ts)
                          .withColumn("ord", F.col("ord") + F.lit(ord_offset)))
    prior = _aligned(prior_raw, RAW)
    raw = materialize(latest_usable_raw(prior.unionByName(new_raw.select("ord", *RAW_FIELDS)), work))
    ai = materialize(annotate_records(raw, annotator))   # model output is computed once
    # keys whose enriched record is stored but not their vector
    left = k.where(F.col("analysed") & ~F.col("stored"))
    old = _aligned(prior_ai, ENRICHED).withColumn("url_key", url_key(F.col("url"))).join(left.select("url_key"), "url_key", "left_semi")
    resumed = latest_matching(old, "url_key", (F.col("status") == "ok") & not_blank(F.col("summary")))
    resumed = materialize(resumed.select("ord", *ENRICHED_FIELDS))
    docs = vector_documents(_usable_enriched(ai.select("ord", *ENRICHED_FIELDS)).unionByName(resumed))
    docs = flag_existing(docs.withColumn("url_key", url_key(F.col("id"))), stored_keys, "url_key", "in_store")
    vec = materialize(embed(docs.where(~F.col("in_store")), "text", embedder))
    taken_up = resumed.select(url_key(F.col("url")).alias("url_key"))
    stages = (work.select("url_key", F.lit(False).alias("resumed")).unionByName(taken_up.withColumn("resumed", F.lit(True)))
              .join(raw.select("url_key", F.lit(True).alias("has_raw")), "url_key", "left")
              .join(ai.select(url_key(F.col("url")).alias("url_key"), F.col("status").alias("ai_status")), "url_key", "left")
              .join(docs.select("url_key", "in_store"), "url_key", "left")
              .join(vec.select("url_key", "embed_error"), "url_key", "left"))
    failed_stage = (F.when(~F.col("resumed") & F.col("has_raw").isNull(), F.lit("scrape"))
                     .when(~F.col("resumed") & (F.col("ai_status") != "ok"), F.lit("analyze"))
                     .when(F.col("in_store").isNull(), F.lit("index"))
                     .when(~F.col("in_store") & F.col("embed_error").isNotNull(), F.lit("index")))
    worked = stages.select(
        "url_key",
        F.when(failed_stage.isNull(), "ok").otherwise("failed").alias("status"),
        failed_stage.alias("stage"),
        F.lit(False).alias("skipped"),
        F.lit(None).cast("string").alias("reason"),
        F.when(failed_stage.isNull() & ~F.col("in_store"), 1)
         .when(failed_stage.isNull(), 0).cast("int").alias("index_added"))
    skipped = k.where(F.col("analysed")).join(taken_up, "url_key", "left_anti").select(
        "url_key", F.lit("ok").alias("status"), F.lit(None).cast("string").alias("stage"),
        F.lit(True).alias("skipped"), F.lit("already_analyzed").alias("reason"),
        F.lit(None).cast("int").alias("index_added"))
    vectors = vec.where(F.col("embed_error").isNull()).select(*[f.name for f in VECTOR_ROW.fields])
    return IngestResult(worked.unionByName(skipped), new_raw, ai.select("ord", *ENRICHED_FIELDS), vectors)


TABLES = {"raw": RAW, "enriched": ENRICHED, "vectors": VECTOR_ROW}
STATUS = "url_key string, status string, stage string, skipped boolean, reason string, index_added int"


def read_table(spark: SparkSession, base: str, name: str, schema: T.StructType) -> DataFrame:
    """The committed rows of a table that ``ingest_into`` keeps."""
    full = schema if name == "vectors" else T.StructType(WITH_ORD + list(schema.fields))
    return commits.read(spark, base, name, full)


def ingest_into(spark: SparkSession, keys: DataFrame, snapshots: DataFrame, base: str, *, min_chars: int = 300, run_ts: str,
                commit: str | None = None, annotator: Annotator | None = None, embedder: Embedder | None = None) -> DataFrame:
    """Ingest ``keys`` against the tables under ``base`` (raw, enriched,
    vectors) and add what is new to all three in one commit: readers see all
    of a run or nothing, and a run that is cut off is done again.  A ``commit``
    name that is recorded already is not done again; its status rows are given
    back.  Failed records are kept in raw; a failed analysis is not, so it is
    tried again, and an analysis whose embedding failed is taken up again."""
    name = commit or f"run-{uuid.uuid4().hex}"
    if commits.is_done(spark, base, name):
        return spark.read.schema(STATUS).parquet(f"{base}/status/{name}")
    prior_raw, prior_ai = read_table(spark, base, "raw", RAW), read_table(spark, base, "enriched", ENRICHED)
    last = prior_raw.agg(F.coalesce(F.max("ord"), F.lit(-1)).alias("last")).first()["last"]
    stored = read_table(spark, base, "vectors", VECTOR_ROW).select("id")
    out = ingest(keys, snapshots, prior_raw, prior_ai, stored.select(F.col("id").alias("url")), min_chars=min_chars, run_ts=run_ts,
                 ord_offset=last + 1, annotator=annotator, embedder=embedder)
    commits.commit(spark, base, name, {
        "status": out.status, "raw": out.raw.select("ord", *RAW_FIELDS), "enriched": out.enriched.where(F.col("status") == "ok"),
        "vectors": only_new(out.vectors, stored, "id").dropDuplicates(["id"])})
    return spark.read.schema(STATUS).parquet(f"{base}/status/{name}")
