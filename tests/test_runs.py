"""Runs that store: ingest, streaming ingest, index rounds, URL files, kNN."""

import numpy as np
from pyspark.sql import functions as F

from quarry.functions.urls import url_key
from quarry.operators.annotate import offline_annotator
from quarry.operators.embed import batch_embedder
from quarry.operators.knn import knn, knn_one, wrong_vectors
from quarry.plans.index import index
from quarry.plans.ingest import ingest_into, read_table
from quarry.plans.scrape import keyed_urls
from quarry.schemas import ENRICHED, RAW
from quarry.session import scratch_path
from quarry.sources.urls import read_url_lines
from quarry.sources.vectors import append_vectors, read_vectors
from quarry.streaming.ingest import ingest_stream

SNAP = "page_id long, page_url string, final_url string, http_status int, content_type string, html string, fetch_error string"
BODY = "<article>" + "<p>The harbour town opened its market again. People came early, and the boats were full of silver fishes.</p>" * 6 + "</article>"


def snapshots(spark, n):
    return spark.createDataFrame([(i, f"http://x.org/p{i}", f"http://x.org/p{i}", 200, "text/html", f"<title>T{i}</title>{BODY}", None) for i in range(n)], SNAP)


def keys_of(rows):
    return rows.groupBy(url_key(F.col("page_url")).alias("url_key")).agg(F.min("page_id").alias("ord"))


def tables(spark, base):
    return [read_table(spark, base, "raw", RAW).count(), read_table(spark, base, "enriched", ENRICHED).count(), read_vectors(spark, f"{base}/vectors").count()]


def test_ingest_stores_reruns_add_nothing_and_missing_stages_resume(spark):
    base, rows = scratch_path(spark, "t-ingest"), snapshots(spark, 6)
    bad = batch_embedder(lambda texts: (_ for _ in ()).throw(RuntimeError("down")))
    first = ingest_into(spark, keys_of(rows), rows, base, run_ts="t", embedder=bad)
    assert {(r.status, r.stage) for r in first.collect()} == {("failed", "index")}
    assert tables(spark, base) == [6, 6, 0]
    second = ingest_into(spark, keys_of(rows), rows, base, run_ts="t").collect()
    assert {(r.status, r.stage, r.skipped, r.index_added) for r in second} == {("ok", None, False, 1)}
    assert tables(spark, base) == [6, 6, 6]
    third = ingest_into(spark, keys_of(rows), rows, base, run_ts="t").collect()
    assert {(r.status, r.skipped, r.reason) for r in third} == {("ok", True, "already_analyzed")}
    assert tables(spark, base) == [6, 6, 6]


def test_streaming_ingest_equals_batch_over_several_batches(spark):
    rows, source, base = snapshots(spark, 9), scratch_path(spark, "t-src"), scratch_path(spark, "t-stream")
    pages = rows.selectExpr("page_id", "page_url AS url", "html")
    for part in range(3):   # three files, one micro-batch each; the last repeats a page
        some = pages.where(F.col("page_id") % 3 == part)
        (some.union(pages.where("page_id = 0")) if part == 2 else some).coalesce(1).write.mode("append").parquet(source)

    def to_rows(b):
        return b.selectExpr("page_id", "url AS page_url", "url AS final_url", "200 AS http_status", "'text/html' AS content_type", "html", "CAST(NULL AS string) AS fetch_error")
    ingest_stream(spark, source, "*.parquet", base, scratch_path(spark, "t-ckpt"), to_snapshot_rows=to_rows, min_chars=300, run_ts="t", files_per_trigger=1)
    batch = scratch_path(spark, "t-batch")
    ingest_into(spark, keys_of(rows), rows, batch, run_ts="t")

    def vectors(path):
        return sorted(map(str, read_vectors(spark, f"{path}/vectors").collect()))
    assert vectors(base) == vectors(batch) and len(vectors(base)) == 9


def test_index_tries_the_next_record_of_an_id(spark):
    def flaky(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("bad")
        return [[1.0] * 64 for _ in texts]
    rows = [(1, "u1", "bad one", "s"), (2, "u1", "good", "s"), (3, "u1", "later", "s"), (4, "u2", "bad", "s"), (5, "u3", "fine", "s"), (6, "stored", "x", "s")]
    enriched = spark.createDataFrame([(o, u, t, s, "ok", ["a"], "src") for o, u, t, s in rows],
                                     "ord long, url string, title string, summary string, status string, topics array<string>, source string")
    stored = spark.createDataFrame([("stored",)], "id string")
    out = index(enriched, stored, embedder=batch_embedder(flaky))
    assert {r.ord: r.status for r in out.rows.collect()} == {1: "failed", 2: "ok", 4: "failed", 5: "ok"}
    assert out.summary.first().asDict() == {"added": 2, "skipped_existing": 2, "skipped_ineligible": 0, "failed": 2}
    limited = index(enriched, stored, limit=1, embedder=batch_embedder(flaky))
    assert {r.ord: r.status for r in limited.rows.collect()} == {1: "failed", 2: "ok"}


def test_append_stores_an_id_once(spark):
    path = scratch_path(spark, "t-vec")
    rows = spark.sql("SELECT 'a' AS id, 't' AS text, named_struct('url','a','title','','source','','summary','','topics','','topic_count',0) AS metadata, array(1f) AS embedding")
    append_vectors(rows.union(rows), path)
    append_vectors(rows, path)
    assert read_vectors(spark, path).count() == 1


def test_url_files_have_numeric_ordinals_and_limits(spark, tmp_path):
    for name, lines in (("b.txt", ["http://c", "http://d", "# no", "http://a"]), ("a.txt", ["http://a", "", "http://b/"])):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    lines = read_url_lines(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r.ord, r.line) for r in lines] == list(enumerate(["http://a", "", "http://b/", "http://c", "http://d", "# no", "http://a"]))
    assert [r.url for r in keyed_urls(read_url_lines(spark, str(tmp_path)), 3).orderBy("ord").collect()] == ["http://a", "http://b/", "http://c"]


def test_knn_blocks_mixed_sizes_and_single(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8)).round(2)
    x[40:60] = x[40]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, [1.0]), (901, None), (902, [None] * 8)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    out = knn(df, df, 4, dim=8, query_id_col="id", corpus_block=37, query_block=29, group_blocks=3).collect()
    got = {}
    for r in out:
        got.setdefault(r.query_id, []).append((r.rank, r.id))
    for q in range(300):
        d = ((x[q] - x) ** 2).cumsum(axis=1)[:, -1]
        assert [i for _, i in sorted(got[q])] == sorted(range(300), key=lambda j: (d[j], j))[:4]
    assert set(got) == set(range(300))
    assert sorted(r.id for r in wrong_vectors(df, 8).collect()) == [900, 901, 902]
    one = knn_one(df, x[45].tolist(), 3)
    assert [(r.rank, r.id) for r in one.orderBy("rank").collect()] == [(1, 40), (2, 41), (3, 42)]
    assert "TakeOrderedAndProject" in one._jdf.queryExecution().executedPlan().toString()


def test_offline_annotator_moves_nothing(spark):
    docs = spark.createDataFrame([("k", "Beta beta alpha. Gamma? alpha delta! More.", "p", "t")], "key string, text string, prompt string, title string")
    out = offline_annotator(docs)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.first()["raw_text"] == '{"summary":"Beta beta alpha. Gamma? alpha delta!","topics":["alpha","beta","delta","gamma","more"]}'


def test_records_with_defaults_and_numbers_as_text(spark, tmp_path):
    from quarry.sources.jsonl import quarantined, read_records, valid_rows
    (tmp_path / "r.jsonl").write_text('{"url":"u1","text":"t"}\n{"url":"u2","http_status":"200","chars":"7","status":"failed","topics":["a"]}\n{"url":"u3","chars":3}\n{"url": bad\n')
    back = read_records(spark, str(tmp_path), ENRICHED)
    rows = {r.url: r for r in valid_rows(back).collect()}
    assert [(r.status, r.chars, r.topics, r.http_status) for r in (rows["u1"], rows["u2"], rows["u3"])] == [
        ("ok", 0, [], None), ("failed", 7, ["a"], 200), ("ok", 3, [], None)]
    assert len(rows) == 3 and quarantined(back.cache()).count() == 1
