"""BPE with word ends against the tokenizers library."""

import hashlib
import random
import struct

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from quarry.llm import word_bpe
from quarry.llm.queries import W

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = W["op12_word_bpe"](spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_random_texts_equal_the_library(library):
    rng = random.Random(1)
    signs = ["a", "b", "é", "É", "İ", "Σ", "ς", "é", "ͅ", " ", "\t", "\x1c", "\x85", " ", " ", "'s", "'LL", "1", "²", "漢",
             "😀", "<|endoftext|>", "<|startoftext|>", "<|END", "!!", "the", "ẛ", "̣", "ﬁ", "\x00", "'", "’", "İ"]
    own = word_bpe.Encoder(PATH, 50)  # small caches: both generations turn over
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["x" * 30_000, "ab" * 4000 + "!?" * 3000, "".join(rng.choice("etaoin") for _ in range(20_000))]
    texts += [c * n for c in "a!漢" for n in (word_bpe.SHORT - 1, word_bpe.SHORT, word_bpe.SHORT + 1)]
    for t, got in zip(texts, own.encode_all(texts)):
        ids = library.encode(t, add_special_tokens=False).ids
        assert got == struct.pack(f"<{len(ids)}i", *ids), repr(t[:80])


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n\t", "x"), (None, "Null key", "x"), (4, "same", "x"), (4, "same", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = word_bpe.encode(df, PATH)
    assert out.columns == ["doc_id", "text", "ids"]
    got = out.withColumn("back", word_bpe.decode(F.col("ids"), PATH)).collect()
    assert sorted((str(r.doc_id), r.back) for r in got) == [
        ("1", ""), ("2", ""), ("3", ""), ("4", "same</w>"), ("4", "same</w>"), ("None", "null</w> key</w>")]
    assert word_bpe.encode(df.limit(0), PATH).collect() == []
    lists = spark.createDataFrame([(None,), ([320, None, 10**6],)], "ids array<int>")
    assert [r.t for r in lists.select(word_bpe.decode(F.col("ids"), PATH).alias("t")).collect()] == ["", "a</w>"]


def test_runs_of_letters_need_no_pattern(monkeypatch, library):
    """Runs of ASCII letters, and these with a sign behind, are words as they are."""
    seen, found = [], word_bpe.ASCII_WORDS
    monkeypatch.setattr(word_bpe, "ASCII_WORDS", lambda text: seen.append(text) or found(text))
    text = "Plain words, THEN others. it's a1 x-- y7! don't 'tis 'S s' end's! é. Straße, a_ b"
    ids = library.encode(text, add_special_tokens=False).ids
    assert word_bpe.Encoder(PATH, 100).encode_all([text]) == [struct.pack(f"<{len(ids)}i", *ids)]
    assert set("\n".join(seen).split()) == set("it's x-- y7! don't 'tis 's end's!".split())
