"""Every operator and stage on nulls, empty and very long texts, ties,
repeated rows, empty tables and extra columns with clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from quarry.llm import bpe, html_extract, minhash, mixing, quality_classifier, quality_rules, secrets, suffixes, token_files, vptree
from quarry.session import scratch_path

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i} the of and" for i in range(12_000))
PROSE = "The river of the valley is long and it runs to the sea with the boats that are on it by the town for all of us."
ROWS = [
    (1, None, "en", "a", None), (2, "", None, "a", 0), (3, " \t\n ", "en", None, 3), (None, PROSE, "en", "b", None),
    (4, PROSE, "en", "b", 1), (4, PROSE, "en", "b", 1), (5, "ONE", "en", None, 3), (6, LONG, "de", "c", None),
    (7, "x" * 30_000, None, None, None), (None, None, None, None, None), (8, "\u0000 ퟿   é 漢字 😀 " + PROSE, "fr", "a", 9),
]
CLASH = ["n_words", "kept", "__row", "__text", "size", "taken", "pieces", "ids", "score", "removed", "spans", "__key", "__n", "key", "secrets",
         "candidates", "value", "chunk", "skey", "target", "__words", "broken_rules", "__pass"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def wide(docs):
    return docs.select("*", *[F.lit("mine").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def forest(spark):
    return secrets.train(secrets.labelled_findings(spark, per_kind=40), trees=8)


OPERATORS = {
    "quality_rules": lambda df, forest: quality_rules.apply_rules(df),
    "secrets": lambda df, forest: secrets.scan(df, forest),
    "bpe": lambda df, forest: bpe.encode(df, RANKS, public_tokenizers.PATTERN),
    "minhash": lambda df, forest: minhash.near_duplicates(df),
    "mixing": lambda df, forest: mixing.mix(df),
    "suffixes": lambda df, forest: suffixes.remove_repeats(df),
    "classifier": lambda df, forest: quality_classifier.score(df, quality_classifier.Model(0.1, (quality_classifier.Rule(((0, True, 2.0),), 0.5),))),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_give_a_row_each(name, docs, forest):
    out = OPERATORS[name](docs, forest).collect()
    assert len(out) == len(ROWS)
    id_of = [r["doc_id"] for r in out]
    assert sorted(map(str, id_of)) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(name, empty, forest):
    assert OPERATORS[name](empty, forest).collect() == []


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_columns(name, docs, wide, forest):
    plain = OPERATORS[name](docs, forest)
    out = OPERATORS[name](wide, forest)
    written = [c for c in plain.columns if c not in docs.columns]
    key = ["doc_id", "text"] if "text" in plain.columns else ["doc_id"]

    def rows(df):
        return sorted(map(str, df.select(*key, *written).collect()))
    assert rows(out) == rows(plain)


def test_quality_values(docs):
    out = {(r.doc_id, r.text): r for r in quality_rules.apply_rules(docs).collect()}
    assert out[(1, None)].n_words == 0 and not out[(1, None)].kept
    assert out[(4, PROSE)].kept and out[(None, PROSE)].kept
    assert out[(6, LONG)].n_words == 48_000
    assert out[(7, "x" * 30_000)].word_chars == 30_000


def test_minhash_values(docs):
    out = minhash.near_duplicates(docs).collect()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert all(r.component_id == r.doc_id and r.n_shingles == 0 for i in (1, 2, 3) for r in by[i])
    assert {r.component_id for r in by[4]} == {4} and all(r.kept for r in by[4])
    assert sorted(str(r.component_id) for r in by[None]) == ["4", "None"]  # the prose joins its copies, the null text nothing
    assert by[5][0].n_shingles == 1


def test_mixing_bounds(docs):
    for r in mixing.mix(docs).collect():
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert sum(p["n"] for p in r.pieces) == r.taken
        assert (r["size"] == 0) == (r.text is None or not r.text.split())


def test_suffix_values(docs):
    out = {(r.doc_id, r.text): r for r in suffixes.remove_repeats(docs).collect()}
    assert bytes(out[(4, PROSE)].kept) == PROSE.encode()  # copies, but shorter than a repeat
    assert bytes(out[(7, "x" * 30_000)].kept) == b""
    assert bytes(out[(1, None)].kept) == b"" and bytes(out[(6, LONG)].kept) == LONG.encode()


def test_pages(spark):
    pages = spark.createDataFrame([(1, None, None, "mine"), (None, "u", "", "mine"), (2, "u", "<p>" + PROSE, "mine"), (2, "u", "<p>" + PROSE, "mine"),
                                   (3, "u", "<article>" + f"<p>{PROSE}</p>" * 3000, "mine")], "page_id long, url string, html string, text string")
    out = html_extract.extract(pages).orderBy("page_id", F.length("text")).collect()
    assert [r.page_id for r in out] == [None, 1, 2, 2, 3]
    assert [len(r.text) for r in out] == [0, 0, len(PROSE), len(PROSE), 3000 * len(PROSE) + 2 * 2999]
    blocks = html_extract.extract(pages, with_blocks=True).filter("page_id = 2").first().blocks
    assert [(b.text, b.content) for b in blocks] == [(PROSE, True)]
    assert html_extract.extract(pages.limit(0)).collect() == []


def test_token_files(spark, docs, empty):
    for rows, n in ((docs, len(ROWS)), (empty, 0)):
        path = scratch_path(spark, "t-files")
        token_files.write(rows, path, TOKENIZER, public_tokenizers.PATTERN, block_ids=64, lanes=8, segment_ids=200)
        out = token_files.read(spark, path, lanes=8).orderBy("start").collect()
        assert len(out) == n
        assert [r.start for r in out] == [sum(x.n_tokens for x in out[:i]) for i in range(n)]
        ids = [r.doc_id for r in out]
        assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    assert {r.n_tokens for r in out if r.doc_id in (1, 2)} <= {1}


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "m"), (50, None, "m"), (100, [0.0, 0.0], "m"), (150, [nan, 1.0], "m"), (200, [1.0, None], "m"), (250, [inf, 1.0], "m"),
            (None, [1.0, 0.0], "m"), (1, [1.0, 0.0], "m"), (2, [2.0, 0.0], "m"), (3, [-1.0, 0.0], "m"), (3, [-1.0, 0.0], "m"), (4, [1.0, 1.0, 1.0], "m"),
            (300, [1.0, 2.0, 1.0], "m"), (350, [1e-30, 0.0], "m")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    out = vptree.search(vptree.build_index(df), df.filter("vec_id % 50 = 0"), k=5).orderBy("query_id", "rank").collect()
    found = {}
    for r in out:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 6)))
    assert set(found) == {0, 300, 350}
    assert found[0] == [(1, 1, 1.0), (2, 2, 1.0), (3, 350, 1.0), (4, 3, -1.0), (5, 3, -1.0)]
    assert found[300] == [(1, 4, 0.942809)]
    none = df.limit(0)
    assert vptree.search(vptree.build_index(none), none).collect() == []


@pytest.mark.parametrize("place", range(len(corpus_pipeline.STAGES)))
def test_stages_on_odd_and_empty_tables(spark, docs, empty, wide, place):
    name, stage = corpus_pipeline.STAGES[place]
    assert stage(spark, empty, "").collect() == []
    out = stage(spark, docs, "")
    rows = out.collect()
    last = place == len(corpus_pipeline.STAGES) - 1
    assert out.columns == docs.columns or last
    if name == "quality_rules":
        assert {r.doc_id for r in rows} >= {None, 4}
    if name == "near_duplicates":
        assert sum(r.text == PROSE for r in rows) == 1 and {1, 2, 3} <= {r.doc_id for r in rows}
    if name == "secret_scan":
        assert sorted(str(r.text) for r in rows) == sorted(str(r[1]) for r in ROWS)
    if not last:
        wider = stage(spark, wide, "")
        assert wider.columns == wide.columns
        assert sorted(map(str, wider.select(docs.columns).collect())) == sorted(map(str, rows))
