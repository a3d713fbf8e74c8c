"""Bounded, isolating model calls; tries of one id in order in one pass."""

import pytest
from pyspark.sql import functions as F

from quarry.operators.embed import batch_embedder, hashed_embedder, native_hashed_embedder
from quarry.operators.model_calls import Calls
from quarry.plans.index import index
from quarry.operators.annotate import batch_annotator, first_valid_attempt, validate_responses

GOOD = '{"summary": "ok", "topics": ["a", "b", "c"]}'


def model(log, bad=(), most=10**9):
    def call(texts):
        log.append(len(texts))
        if len(texts) > most or any(t in bad for t in texts):
            raise ValueError("no")
        return [t.upper() for t in texts]
    return call


def test_one_bad_text_costs_its_neighbours_nothing():
    log = []
    texts = [f"t{i}" for i in range(1000)]
    out = list(Calls(model(log, {"t500"}), "answers", 256).each(texts))
    assert [i for i, _, _ in out] == list(range(1000))
    assert [(i, e) for i, _, e in out if e] == [(500, "ValueError: no")]
    assert all(a == texts[i].upper() for i, a, e in out if not e)
    assert len(log) < 30


def test_size_limited_model_is_not_called_text_by_text():
    log = []
    out = list(Calls(model(log, most=40), "answers", 256).each(["x"] * 10_000))
    assert all(e is None for _, _, e in out) and len(out) == 10_000
    assert len(log) < 700 and log.count(1) == 0


def test_calls_are_bounded_by_characters_and_count():
    log = []
    calls = Calls(lambda ts: log.append(sum(map(len, ts))) or ts, "answers", 8, 100)
    assert len(list(calls.each(["y" * 30] * 20 + ["z" * 500, "", ""]))) == 23
    assert sorted(set(log))[-1] == 500 and all(n <= 100 for n in log if n != 500)


def test_a_lone_text_has_three_tries():
    tries = {}

    def flaky(texts):
        for t in texts:
            tries[t] = tries.get(t, 0) + 1
        if any(t == "bad" or t == "late" and tries[t] < 4 for t in texts):
            raise RuntimeError("down")
        return texts
    got = Calls(flaky, "vectors").settled(["a", "bad", "late", "b"], 3)
    assert got[0] == ("a", None) and got[3] == ("b", None)
    assert got[1] == (None, "RuntimeError: down") and got[2] == ("late", None)


def test_bad_prompt_fails_alone_after_three_attempts(spark):
    def call(prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("refused")
        return [GOOD] * len(prompts)
    df = spark.createDataFrame([(f"k{i}", "bad" if i == 3 else "good") for i in range(6)], "key string, prompt string").coalesce(1)
    responses = batch_annotator(call)(df)
    assert sorted((r.key, r.attempt) for r in responses.collect()) == sorted([(f"k{i}", 1) for i in range(6)] + [("k3", 2), ("k3", 3)])
    out = {r.key: (r.valid, r.error) for r in first_valid_attempt(validate_responses(responses)).collect()}
    assert out == {f"k{i}": (i != 3, "RuntimeError: refused" if i == 3 else None) for i in range(6)}


def records(spark, rows):
    df = spark.createDataFrame(rows, "ord long, url string, summary string")
    return df.select("ord", "url", "summary", F.lit(None).cast("string").alias("title"), F.lit("s").alias("source"),
                     F.array().cast("array<string>").alias("topics"), F.lit("ok").alias("status"))


def embedder():
    def embedding(texts):  # local, so that it pickles by value
        if any("bad" in t for t in texts):
            raise RuntimeError("refused")
        return [[1.0] * 64 for _ in texts]
    return batch_embedder(embedding)


@pytest.mark.parametrize("batch", [10_000, 7])
def test_first_success_after_many_failures(spark, batch):
    rows = [(i, "http://a", "bad") for i in range(300)] + [(300, "http://a", "fine"), (301, "http://a", "never tried"), (302, "http://b", "bad"),
            (303, "http://b", " x "), (304, "http://c", "at once"), (305, "http://c", "bad"), (306, "http://d", "bad"), (307, "http://d", "bad")]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = {r.ord: r.status for r in index(records(spark, rows), embedder=embedder()).rows.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = {i: "failed" for i in range(300)} | {300: "ok", 302: "failed", 303: "ok", 304: "ok", 306: "failed", 307: "failed"}
    assert out == want


def test_number_of_jobs_does_not_follow_failures(spark):
    tracker = spark.sparkContext.statusTracker()

    def jobs(n):
        group = f"tries-{n}"
        spark.sparkContext.setJobGroup(group, group)
        index(records(spark, [(i, "http://a", "bad") for i in range(n)]), embedder=embedder()).rows.collect()
        return len(tracker.getJobIdsForGroup(group))
    assert jobs(1000) <= jobs(3) + 2


def test_embedders_of_every_kind_agree(spark):
    rows = [(i, "http://a", "?!") for i in range(5)] + [(9, "http://a", "some words"), (10, "http://a", "more")]
    got = [sorted((r.ord, r.status) for r in index(records(spark, rows), embedder=e).rows.collect()) for e in (hashed_embedder(), native_hashed_embedder(), None)]
    assert got[0] == got[1] == got[2] == [(i, "failed") for i in range(5)] + [(9, "ok")]
