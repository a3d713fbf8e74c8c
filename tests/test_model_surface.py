"""Pluggable model stages: batch annotator retries recorded as data, the
first valid attempt wins, batch embedder runs per Arrow batch."""

from pyspark.sql import functions as F

from quarry.operators.annotate import batch_annotator, first_valid_attempt, validate_responses
from quarry.operators.embed import batch_embedder, embed


def test_batch_annotator_retries_and_first_valid(spark):
    state = {"calls": 0}

    def flaky_model(prompts):
        # first call: invalid for every prompt; later calls: valid unless
        # the prompt asks for a failure (defined here so it pickles by value)
        state["calls"] += 1
        if state["calls"] == 1:
            return ["not json" for _ in prompts]
        return ['{"summary": "ok", "topics": ["a", "b", "c"]}' if "bad" not in p else "[]" for p in prompts]

    calls = spark.createDataFrame([("k1", "good prompt"), ("k2", "bad prompt")], "key string, prompt string")
    responses = batch_annotator(flaky_model)(calls.coalesce(1))
    rows = sorted((r["key"], r["attempt"]) for r in responses.collect())
    assert rows == [("k1", 1), ("k1", 2), ("k2", 1), ("k2", 2), ("k2", 3)]
    out = {r["key"]: r for r in first_valid_attempt(validate_responses(responses)).collect()}
    assert out["k1"]["valid"] and out["k1"]["attempt"] == 2 and out["k1"]["topics"] == ["a", "b", "c"]
    assert not out["k2"]["valid"] and out["k2"]["error"] == "ValidationError: output is not an object"


def test_batch_embedder_and_guard(spark):
    df = spark.createDataFrame([(1, "alpha"), (2, "  "), (3, "beta gamma")], "id int, text string")
    emb = batch_embedder(lambda texts: [[float(len(t))] * 4 for t in texts])
    out = {r["id"]: r for r in embed(df, "text", emb, dim=4).collect()}
    assert out[1]["embedding"] == [5.0] * 4 and out[1]["embed_error"] is None
    assert out[2]["embedding"] is None and out[2]["embed_error"].startswith("ValueError")
    assert out[3]["embedding"] == [10.0] * 4


def test_blank_after_valid_is_tried_again_and_short_answers_are_errors(spark):
    state = {"calls": 0}

    def model(prompts):
        state["calls"] += 1
        if state["calls"] == 1:
            return ['{"summary": "  ", "topics": ["a", "b", "c"]}' for _ in prompts]
        if state["calls"] == 2:
            return []
        return ['{"summary": "ok", "topics": ["a", "b", "c"]}' for _ in prompts]

    calls = spark.createDataFrame([("k1", "p")], "key string, prompt string").coalesce(1)
    responses = batch_annotator(model)(calls).collect()
    assert [(r["attempt"], r["call_error"]) for r in responses] == [
        (1, None), (2, "RuntimeError: 0 answers for 1 prompts"), (3, None)]


def test_embedder_sees_no_blanks_and_failures_are_rows(spark, tmp_path):
    log = str(tmp_path / "calls")

    def strict(texts):
        with open(log, "a") as f:
            f.write(f"{len(texts)}\n")
        if any(not (t or "").strip() for t in texts):
            raise ValueError("blank")
        if "poison" in texts:
            raise RuntimeError("no vector")
        return [[1.0, 2.0] for _ in texts]

    rows = [(1, "good"), (2, "  "), (3, None), (4, "poison"), (5, "fine")]
    df = spark.createDataFrame(rows, "id int, text string").coalesce(1)
    out = {r["id"]: r for r in embed(df, "text", batch_embedder(strict), dim=2).collect()}
    assert {i: r["embed_error"] for i, r in out.items()} == {
        1: None, 2: "ValueError: Cannot embed empty text", 3: "ValueError: Cannot embed empty text", 4: "RuntimeError: no vector", 5: None}
    assert out[1]["embedding"] == [1.0, 2.0] and out[4]["embedding"] is None
    # the call, its failing half, that half's texts with two more tries of the
    # lone failure after the other half
    assert open(log).read().split() == ["3", "2", "1", "1", "1", "1", "1"]


def test_wrong_size_is_an_error(spark):
    df = spark.createDataFrame([(1, "a")], "id int, text string")
    out = embed(df, "text", batch_embedder(lambda t: [[1.0] * 3 for _ in t]), dim=2).first()
    assert out["embed_error"] == "RuntimeError: Invalid embedding response"
