"""Batch scrape (E1) and the per-URL single scrape (S7).

URL list -> strip/skip/first-wins -> URL key -> optional head limit ->
first occurrence per key -> anti join with keys already scraped -> fetch
(snapshot join) -> audit records -> summary counters.

Shuffles, all on narrow rows but the last: list de-duplication, the first
occurrence per key, the anti join (broadcast when the earlier output's keys
are small, sort-merge otherwise), the winner of each key's snapshots, and the
join that reads the pages of winners, the one exchange that HTML may cross.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.urls import url_key
from quarry.operators.dedup import seen_keys, url_list
from quarry.operators.incremental import flag_existing
from quarry.operators.limits import head_by_order
from quarry.operators.scrape import scrape_records
from quarry.sources.pages import fetch


@dataclass
class ScrapeResult:
    records: DataFrame      # new RAW records to append (with ord)
    summary: DataFrame      # one row of counters


def keyed_urls(lines: DataFrame, limit: int | None = None) -> DataFrame:
    """``(ord, url, url_key)`` of a URL list, limited to the first ``limit``
    URLs after list de-duplication (before any seen check)."""
    urls = url_list(lines).withColumn("url_key", url_key(F.col("url")))
    return head_by_order(urls, limit)


def scrape(lines: DataFrame, snapshots: DataFrame, prior_raw: DataFrame | None = None, *,
           limit: int | None = None, min_chars: int = 500, run_ts: str) -> ScrapeResult:
    urls = keyed_urls(lines, limit)
    first = urls.groupBy("url_key").agg(F.min("ord").alias("ord"))
    if prior_raw is not None:
        first = flag_existing(first, seen_keys(prior_raw), "url_key", "in_prior")
    else:
        first = first.withColumn("in_prior", F.lit(False))
    todo = first.where(~F.col("in_prior")).select("ord", "url_key")
    records = scrape_records(fetch(todo, snapshots), min_chars, run_ts)
    summary = summarize_scrape(urls, records)
    return ScrapeResult(records, summary)


def summarize_scrape(urls: DataFrame, records: DataFrame) -> DataFrame:
    """Counters of a scrape run: every listed URL either produced a record
    (ok or failed) or was skipped as already present."""
    outcome = urls.select("ord").join(records.select("ord", "status"), "ord", "left")
    return outcome.agg(
        F.count("*").alias("total_input"),
        F.count("status").alias("added"),
        F.count_if(F.col("status") == "ok").alias("ok"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status").isNull()).alias("skipped_existing"),
    )


def scrape_each(urls: DataFrame, snapshots: DataFrame, prior_raw: DataFrame | None = None, *,
                min_chars: int = 500, run_ts: str) -> DataFrame:
    """The single-URL scrape applied to every URL independently: each URL's
    result is ``total=1`` and ``ok``/``failed``/``skipped_existing`` as if
    it were scraped alone against the earlier output."""
    keyed = urls.select("ord", url_key(F.col("url")).alias("url_key"))
    if prior_raw is not None:
        keyed = flag_existing(keyed, seen_keys(prior_raw), "url_key", "in_prior")
    else:
        keyed = keyed.withColumn("in_prior", F.lit(False))
    # a URL that is listed many times is fetched and extracted once, one that is stored not at all
    once = fetch(keyed.where(~F.col("in_prior")).select("url_key").distinct(), snapshots)
    rec = scrape_records(once, min_chars, run_ts, keep=())
    done = rec.select(F.col("url").alias("url_key"), "status")
    ok = F.col("status") == "ok"
    result = keyed.join(done, "url_key", "left")
    return result.select(
        "ord", F.col("url_key").alias("url"), F.lit(1).alias("total"),
        F.when(~F.col("in_prior") & ok, 1).otherwise(0).alias("ok"),
        F.when(~F.col("in_prior") & ~ok, 1).otherwise(0).alias("failed"),
        F.when(F.col("in_prior"), 1).otherwise(0).alias("skipped_existing"), "status")
