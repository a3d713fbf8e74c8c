"""Properties: counters add up, reruns add nothing, output does not depend
on partitioning, batch equals streaming."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.operators.dedup import url_list
from quarry.plans import workloads as WL
from quarry.plans.scrape import scrape
from quarry.sources import derived as D


def test_scrape_counters_add_up(spark):
    s = WL.W["scrape_summary"](spark, SF_SMALL).first()
    assert s["total_input"] == s["added"] + s["skipped_existing"]
    assert s["added"] == s["ok"] + s["failed"]


def test_scrape_rerun_adds_nothing(spark):
    lines, snaps = D.url_lines(spark, SF_SMALL), D.snapshot_rows(spark, SF_SMALL)
    first = scrape(lines, snaps, D.raw_prior(spark, SF_SMALL), run_ts=D.RUN_TS)
    prior = D.raw_prior(spark, SF_SMALL).select("url", "status").unionByName(first.records.select("url", "status"))
    again = scrape(lines, snaps, prior, run_ts=D.RUN_TS)
    assert first.records.count() > 0
    assert again.records.count() == 0


def test_analyze_counters_add_up(spark):
    s = WL.W["analyze_summary"](spark, SF_SMALL).first()
    elig = WL.W["eligible_for_analysis"](spark, SF_SMALL).count()
    assert s["processed"] + s["failed"] + s["skipped_already"] == elig


def test_index_counters_add_up(spark):
    s = WL.W["index_summary"](spark, SF_SMALL).first()
    total = WL._enriched_all(spark, SF_SMALL).count()
    assert s["added"] + s["skipped_existing"] + s["skipped_ineligible"] + s["failed"] == total


def test_first_wins_ignores_partitioning(spark):
    lines = D.url_lines(spark, SF_SMALL)
    a = sorted(tuple(r) for r in url_list(lines).collect())
    b = sorted(tuple(r) for r in url_list(lines.repartition(7, F.rand(1))).collect())
    assert a == b


def test_streaming_equals_batch(spark):
    stream = sorted(tuple(r) for r in WL.W["stream_ingest"](spark, SF_SMALL).collect())
    keyed = WL.load(spark, SF_SMALL, "pages").select(
        WL.url_key(F.col("url")).alias("url_key"), "page_id")
    batch = sorted(tuple(r) for r in keyed.groupBy("url_key").agg(F.min("page_id")).collect())
    assert stream == batch
