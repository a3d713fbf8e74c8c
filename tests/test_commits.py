"""Tables that change together: a cut between two tables is invisible and is
made good once; compaction swaps whole."""

import pytest
from pyspark.sql import functions as F

from quarry.plans.ingest import ingest_into, read_table
from quarry.schemas import ENRICHED, RAW, VECTOR_ROW
from quarry.session import scratch_path
from quarry.sources import commits
from quarry.streaming.ingest import ingest_stream
from test_runs import keys_of, snapshots, tables


def test_cut_between_tables_is_invisible_and_done_again_once(spark, monkeypatch):
    base, rows = scratch_path(spark, "t-cut"), snapshots(spark, 5)
    record = commits._record
    monkeypatch.setattr(commits, "_record", lambda *a: (_ for _ in ()).throw(OSError("cut")))
    with pytest.raises(OSError):
        ingest_into(spark, keys_of(rows), rows, base, run_ts="t", commit="batch-0")
    assert tables(spark, base) == [0, 0, 0]
    monkeypatch.setattr(commits, "_record", record)
    first = ingest_into(spark, keys_of(rows), rows, base, run_ts="t", commit="batch-0")
    assert tables(spark, base) == [5, 5, 5]
    again = ingest_into(spark, keys_of(rows), rows, base, run_ts="t", commit="batch-0")
    assert sorted(map(str, again.collect())) == sorted(map(str, first.collect())) and again.count() == 5
    assert tables(spark, base) == [5, 5, 5]


def test_replayed_stream_batch_is_stored_once(spark):
    rows, source, base = snapshots(spark, 4), scratch_path(spark, "t-src"), scratch_path(spark, "t-base")
    rows.selectExpr("page_id", "page_url AS url", "html").coalesce(1).write.parquet(source)

    def run(checkpoint):
        ingest_stream(spark, source, "*.parquet", base, checkpoint, min_chars=300, run_ts="t", to_snapshot_rows=lambda b: b.selectExpr(
            "page_id", "url AS page_url", "url AS final_url", "200 AS http_status", "'text/html' AS content_type", "html", "CAST(NULL AS string) AS fetch_error"))
    checkpoint = scratch_path(spark, "t-ck")
    run(checkpoint)
    run(checkpoint)
    run(scratch_path(spark, "t-ck"))
    assert tables(spark, base) == [4, 4, 4]


def test_compaction_swaps_whole(spark, monkeypatch):
    base, schema = scratch_path(spark, "t-compact"), spark.range(1).schema
    for n in range(4):
        assert commits.commit(spark, base, f"c{n}", {"t": spark.range(n * 10, n * 10 + 10)})
    assert not commits.commit(spark, base, "c0", {"t": spark.range(5)})

    def ids():
        return sorted(r.id for r in commits.read(spark, base, "t", schema).collect())
    assert ids() == list(range(40)) and len(commits.folders(spark, base, "t")) == 4
    record = commits._record
    monkeypatch.setattr(commits, "_record", lambda *a: (_ for _ in ()).throw(OSError("cut")))
    with pytest.raises(OSError):
        commits.compact(spark, base, "small", "t", schema, 1)
    assert ids() == list(range(40)) and len(commits.folders(spark, base, "t")) == 4
    monkeypatch.setattr(commits, "_record", record)
    assert commits.compact(spark, base, "small", "t", schema, 1)
    assert ids() == list(range(40)) and len(commits.folders(spark, base, "t")) == 1
    assert commits.commit(spark, base, "c9", {"t": spark.range(100, 101)}) and ids()[-1] == 100


def test_empty_tables_have_their_schema(spark):
    base = scratch_path(spark, "t-none")
    for name, schema in (("raw", RAW), ("enriched", ENRICHED), ("vectors", VECTOR_ROW)):
        assert read_table(spark, base, name, schema).where(F.lit(True)).count() == 0
