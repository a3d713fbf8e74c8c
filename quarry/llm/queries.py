"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, html_extract, minhash, mixing, prefix_trie, quality_classifier, quality_rules, secrets, suffixes, token_files, vptree, whitening, word_bpe
from quarry.llm.sql import SQL  # noqa: F401
from quarry.session import scratch_path, store

W: dict = {}


def query(fn):
    W[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = store(mixing.sized(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text"), "mix-sizes")
    return mixing.mix(narrow).select("doc_id", "size", "source_size", "target", "taken")


def encoded_digests(docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2(bpe.decode(F.col("ids"), path), 256).alias("decoded_sha256"))


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"))


@query
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, shingle=3, percent=85).drop("set_key")


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = secrets.train(secrets.labelled_findings(spark))
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), forest)
    return found.select("doc_id", "candidates", F.size("secrets").cast("long").alias("n_secrets"),
                        F.transform("secrets", lambda s: s["value"]).alias("secrets"))


@query
def op8_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vptree.search(vptree.build_index(rows), rows.filter("vec_id % 50 = 0"))


@query
def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    cut = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", n_bytes, "text"), keep_text=False)
    return cut.select(
        "doc_id", "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.extract(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a row without an id cannot have a label; it counts as held out
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality_classifier.fit(docs, labels.filter(~held_out), most_rows=quality_classifier.MOST_ROWS)
    scored = quality_classifier.score(docs, model).withColumn("held_out", held_out)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents").select("doc_id", "text"), path,
                      public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    both = word_bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(table(spark, sf_dir, "conversations"))
