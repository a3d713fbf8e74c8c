"""Operators against brute force on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.vectors import embedding_text, preview
from quarry.operators.dedup import first_wins, latest_matching, url_list
from quarry.operators.embed import _hashed_vectors, embed, native_hashed_embedder
from quarry.operators.knn import knn, knn_one, wrong_vectors
from quarry.operators.limits import FETCH_LIMIT, nth_smallest, until_successes


def test_url_list_first_wins_and_skips(spark):
    lines = spark.createDataFrame(
        [(0, " a "), (1, "# c"), (2, ""), (3, "a"), (4, "b"), (5, "   "), (6, "b")], "ord long, line string")
    got = sorted((r["ord"], r["url"]) for r in url_list(lines).collect())
    assert got == [(0, "a"), (4, "b")]


def test_winners_of_null_keys_ties_and_missing_ordinals(spark):
    df = spark.createDataFrame([(None, 2, "a"), (None, 1, "b"), ("k", 1, "c"), ("k", 1, "c"), ("n", None, "d")], "key string, ord int, v string")
    assert sorted(map(tuple, first_wins(df, "key", "ord").collect()), key=str) == [("k", 1, "c"), ("n", None, "d"), (None, 1, "b")]
    assert sorted(map(tuple, latest_matching(df, "key", F.lit(True), "ord").collect()), key=str) == [("k", 1, "c"), (None, 2, "a")]
    assert first_wins(df.limit(0), "key", "ord").count() == latest_matching(df.limit(0), "key", F.lit(True), "ord").count() == 0


def test_fetch_of_repeated_and_unnumbered_snapshots(spark):
    """One snapshot a key: the least ordinal, repeated rows once, none without an ordinal."""
    from quarry.sources.pages import SNAPSHOT_COLS, fetch
    page = lambda n, u, h: (n, u, u, 200, "text/html", h, None)
    rows = spark.createDataFrame([page(2, "http://a/x", "late"), page(1, "http://a/x", "first"), page(1, "http://a/x", "first"),
                                  page(None, "http://a/y", "none")],
                                 "page_id long, page_url string, final_url string, http_status int, content_type string, html string, fetch_error string")
    todo = spark.createDataFrame([("http://a/x", 7), ("http://a/y", 8), ("http://a/z", 9)], "url_key string, ord int")
    out = fetch(todo, rows)
    assert out.columns == ["url_key", "ord", *SNAPSHOT_COLS, "snap_found"]
    assert sorted((r.ord, r.html, r.snap_found) for r in out.collect()) == [(7, "first", True), (8, None, False), (9, None, False)]


def test_first_wins_and_latest(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "a"), ("j", 2, "b"), ("k", 5, "x")],
                               "key string, ord int, v string")
    assert sorted(tuple(r) for r in first_wins(df, "key", "ord").collect()) == [("j", 2, "b"), ("k", 1, "a")]
    lat = latest_matching(df, "key", F.col("v") != "x", "ord").collect()
    assert sorted((r["key"], r["v"]) for r in lat) == [("j", "b"), ("k", "c")]


def test_success_limit_matches_loop(spark):
    rng = np.random.default_rng(7)
    flags = rng.random(300) < 0.3
    df = spark.createDataFrame([(i, bool(f)) for i, f in enumerate(flags)], "ord long, ok boolean")
    for n in (1, 5, 40, 10_000):
        kept, done = [], 0
        for i, f in enumerate(flags):
            if done >= n:
                break
            kept.append(i)
            done += int(f)
        got = sorted(r["ord"] for r in until_successes(df, n, F.col("ok")).collect())
        assert got == kept


def test_nth_smallest_large_n_path(spark):
    n = FETCH_LIMIT + 1234
    vals = np.random.default_rng(3).integers(0, 10**9, size=3 * FETCH_LIMIT)
    df = spark.createDataFrame([(int(v),) for v in vals], "o long")
    assert nth_smallest(df, "o", n) == int(np.sort(vals)[n - 1])
    assert nth_smallest(df, "o", 10**6) is None


def test_knn_exact_with_ties_and_small_corpus(spark):
    rng = np.random.default_rng(11)
    corpus = rng.normal(size=(60, 8)).astype(np.float32)
    corpus[10] = corpus[3]          # duplicate vector: equal distances, tie by id
    queries = rng.normal(size=(7, 8)).astype(np.float32)
    queries[0] = corpus[3]
    cdf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "id long, embedding array<float>")
    qdf = spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in enumerate(queries)],
                                "query_id string, embedding array<float>")
    got = knn(cdf.repartition(3), qdf, 4, dim=8).collect()
    for qi, q in enumerate(queries):
        d = [float(sum((float(a) - float(b)) ** 2 for a, b in zip(q, c))) for c in corpus]
        exp = sorted(range(len(corpus)), key=lambda j: (d[j], j))[:4]
        mine = sorted((r["rank"], r["id"]) for r in got if r["query_id"] == f"q{qi}")
        assert [i for _, i in mine] == exp
    assert len(knn(cdf.limit(2), qdf, 5, dim=8).collect()) == 2 * len(queries)


@pytest.mark.parametrize("kind", ["long", "int", "string"])
def test_knn_ties_of_more_than_k_equal_vectors(spark, kind):
    ids = [100, 11, 9, 101, 8, 10, 1000, 12]
    rows = [(i if kind != "string" else str(i), [1.0, 2.0]) for i in ids]
    cdf = spark.createDataFrame(rows, f"id {kind}, embedding array<float>")
    qdf = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0, 0.0])], "query_id long, embedding array<float>")
    expected = sorted(i for i, _ in rows)[:5]
    for options in ({}, {"corpus_block": 3, "group_blocks": 1}):
        got = knn(cdf, qdf, 5, dim=2, **options).collect()
        for q in (1, 2):
            assert [r["id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == expected
    nulls = cdf.unionByName(cdf.limit(1).selectExpr(f"CAST(NULL AS {kind}) AS id", "embedding"))
    got = knn(nulls, qdf, 5, dim=2).where("query_id = 1").orderBy("rank").collect()
    assert [r["id"] for r in got] == [None, *expected[:4]]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_knn_leaves_out_non_finite_vectors_only(spark, kind):
    rng = np.random.default_rng(12)
    vectors = rng.normal(size=(100, 4)).astype(np.float32).tolist()
    rows = [*enumerate(vectors), (900, [1.0, float("nan"), 0.0, 0.0]), (901, [float("inf"), 0.0, 0.0, 0.0]), (902, [0.0, float("-inf"), 0.0, 0.0])]
    cdf = spark.createDataFrame(rows, f"id long, embedding array<{kind}>")
    qdf = spark.createDataFrame([(i, vectors[i]) for i in range(10)] + [(10, [float("nan")] * 4)], f"query_id long, embedding array<{kind}>")
    right = sorted(tuple(r) for r in knn(cdf.where("id < 900"), qdf.where("query_id < 10"), 5, dim=4).collect())
    assert len(right) == 50 and sorted(tuple(r) for r in knn(cdf, qdf, 5, dim=4).collect()) == right
    assert sorted(r.id for r in wrong_vectors(cdf, 4).collect()) == [900, 901, 902]
    assert [r.id for r in knn_one(cdf, vectors[0], 5).orderBy("rank").collect()] == [i for q, _, _, i in right if q == 0]


def test_knn_of_vectors_whose_squares_overflow(spark):
    rows = [(1, [1e200, 0.0]), (2, [1.0, 2.0]), (3, [1e200, 1.0]), (4, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    got = sorted(tuple(r) for r in knn(df, df.withColumnRenamed("id", "query_id"), 2, dim=2).collect())
    assert got == [(1, 1, 0.0, 1), (1, 2, 1.0, 3), (2, 1, 0.0, 2), (2, 2, 5.0, 4),
                   (3, 1, 0.0, 3), (3, 2, 1.0, 1), (4, 1, 0.0, 4), (4, 2, 5.0, 2)]


def test_knn_chunked_queries_equal_single_pass(spark):
    rng = np.random.default_rng(5)
    cdf = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(50)], "id long, embedding array<float>")
    qdf = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(30)], "query_id long, embedding array<float>")
    one = sorted(tuple(r) for r in knn(cdf, qdf, 3, dim=4).collect())
    many = sorted(tuple(r) for r in knn(cdf, qdf, 3, dim=4, query_block=5, corpus_block=9, group_blocks=2).collect())
    assert one == many


def test_native_and_arrow_embedders_agree(spark):
    texts = ["Hello, World! héllo 42 hello", "   ", "...", "Über straße ÉTÉ été 2024", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    native = {r["id"]: r["e"] for r in df.select("id", native_hashed_embedder()(F.col("text")).alias("e")).collect()}
    py = _hashed_vectors(__import__("pandas").Series(texts), 64)
    for i in range(len(texts)):
        if py[i] is None:
            assert native[i] is None
        else:
            assert np.array_equal(np.asarray(native[i], dtype=np.float32), py[i])
    out = {r["id"]: r["embed_error"] for r in embed(df).collect()}
    assert out[1] is not None and out[2] is not None and out[0] is None


def test_embedding_text_and_preview(spark):
    df = spark.createDataFrame([
        (None, "Sum.", ["a", "b"]), ("  ", "Sum.", []), ("T ", None, None)],
        "title string, summary string, topics array<string>")
    got = [r[0] for r in df.select(embedding_text(F.col("title"), F.col("summary"), F.col("topics"))).collect()]
    assert got == ["Sum.\n\nTopics: a, b", "\n\nSum.", "T"]
    long = spark.createDataFrame([("x" * 501,), ("y" * 500,)], "d string")
    p = [r[0] for r in long.select(preview(F.col("d"))).collect()]
    assert p == ["x" * 500 + "...", "y" * 500]


def test_hashed_embedder_hashes_a_token_once_and_keeps_every_letter(spark, monkeypatch):
    """Tokens of earlier texts are not hashed again; letters and digits of any
    script are told as the pattern tells them."""
    import regex
    from quarry.functions.vectors import TOKEN_SPLIT_RE
    from quarry.operators import embed as N
    texts = ["İI ΑΣ ΑΣ. Σ", "áb ﬁ ǅ x\x00y z\x1cq", "日本語 １２３ Ⅷ ½ ²", "\U0001F600 \U00020000\U0001D7D8 a_b", "", None, "..."] * 40
    hashed, md5 = [], N.md5
    monkeypatch.setattr(N, "_kept", {})
    monkeypatch.setattr(N, "md5", lambda b: hashed.append(b) or md5(b))
    want = {t for x in texts for t in regex.split(TOKEN_SPLIT_RE, (x or "").lower()) if t}
    for _ in range(2):
        vectors, held = N._hashed_matrix(texts, 64)
        assert sorted(hashed) == sorted(t.encode() for t in want)
        assert held.tolist() == ([True] * 4 + [False] * 3) * 40 and np.allclose((vectors ** 2).sum(1), held)
    got = spark.createDataFrame(list(enumerate(texts[:7])), "i int, t string").select("i", N.hashed_embedder()(F.col("t")).alias("e")).collect()
    assert [r.e for r in sorted(got)] == [v.tolist() if h else None for v, h in zip(vectors[:7], held)]
