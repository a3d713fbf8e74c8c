"""Mixing sources to target weights.

The words of each source form one stream, packed into blocks of a fixed
number of words.  Each source gets a number of slots that meets its target
(full passes over its blocks, then a part of one more pass).  Every slot is
drawn into one of the output shards at random, so a shard's source counts are
multinomial while the totals hold exactly.  Slot j of a pass reads block
perm(j) of its source, perm being a pseudorandom permutation of the block
numbers for each source and pass (swap-or-not rounds, which can be evaluated
at one point).  The join of slots and blocks by index is solved from the
block's side: a block finds its slot in each pass by the inverse permutation,
so no slot table is made and nothing moves for it.

Scale: one pass over the texts for the sizes; a map-side combined sum by
(source, chunk); one shuffle of narrow rows by (source, chunk) for the places
in the stream.  Chunks split a source by a hash of id and text, so a source
with a third of all rows is spread like the others.

Defined results: a null text has no words and nothing is taken of it; a null
source is a source of its own, last in order; rows with null or repeated ids
are rows like any other (repeated rows share out the same places); an empty
table gives an empty result; other input columns are carried along, those
with names written here (or starting with ``__mix_``) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import bind
from quarry.llm.textstats import words

WEIGHTS = (3, 1, 2)
BLOCK_WORDS = 64
CHUNKS = 4096
ROUNDS = 8
SHARD_SLOTS = 4096
WRITTEN = ("size", "source_size", "target", "taken", "pieces")


def _source_key(col: Column) -> Column:
    return F.when(col.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), col))


def source_targets(sizes: DataFrame, weights=WEIGHTS, factor: float = 1.5, limit: float = 2.0) -> DataFrame:
    """Targets from rows (skey, source, source_size): sources by code point,
    null last, weigh ``weights`` in turn and share ``factor`` times all words;
    a target stops at ``limit`` times its source, the excess goes to the
    others by weight.  The result is min(limit * size, level * weight) for one
    level, found by a scan of the sources in order of their limit per weight.
    One row per source is all that meets in one task."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("weight", w).withColumn("most", F.col("source_size") * F.lit(limit))
    s = s.withColumn("ratio", F.col("most") / F.col("weight"))
    everything = Window.partitionBy()
    before = Window.orderBy("ratio", "skey").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("ratio", "skey").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(everything) * F.lit(factor) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                     / F.sum("weight").over(onward))
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "skey", "level"))).over(everything)["level"])
    return s.select("skey", "source_size", F.least("most", F.col("weight") * F.coalesce("level", F.lit(0.0))).alias("target"))


def _unpermute(b: Column, n: Column, key: Column, rounds: int) -> Column:
    """Place of block ``b`` in the permutation of 0..n-1 named by ``key``:
    swap-or-not rounds, last one first; each swaps x with K - x or not, by a
    hash bit of the pair's larger member."""
    def step(x, r):
        k = F.pmod(F.xxhash64(key, r), n)
        return bind(F.pmod(k - x, n), lambda y: F.when(
            F.pmod(F.xxhash64(key, r, F.greatest(x, y)), F.lit(2)) == 1, y).otherwise(x))
    return F.aggregate(F.sequence(F.lit(rounds), F.lit(1), F.lit(-1)), b, step)


def _pieces(block_words: int, rounds: int, shards: Column, seed: int) -> Column:
    """array<struct<shard, slot, pass, block, first, n>> of one document: for
    each of its blocks and each pass that reads it, the words taken (``first``
    counts from 0 within the document)."""
    start, size, total = F.col("__mix_start"), F.col("size"), F.col("source_size")
    n_blocks = F.ceil(total / block_words).cast("long")
    passes = F.floor(F.col("target") / total).cast("long")
    rest = F.round(F.col("target") - passes * total).cast("long")
    key = F.xxhash64(F.lit(seed), F.col("__mix_skey"))

    def of_block(b):
        lo = F.greatest(b * block_words, start)
        hi = F.least((b + 1) * block_words, start + size)

        def of_pass(p):
            def rank(j):
                # words of this block that the pass reads: all, a head, or none
                reads = F.when(p < F.col("__mix_passes"), F.lit(block_words).cast("long")).otherwise(
                    F.greatest(F.least(F.col("__mix_rest") - j * block_words, F.lit(block_words)), F.lit(0)))
                slot = p * F.col("__mix_blocks") + j
                return F.struct(
                    F.pmod(F.xxhash64(F.lit(seed + 1), F.col("__mix_skey"), slot), shards).alias("shard"), slot.alias("slot"),
                    p.cast("int").alias("pass"), b.alias("block"), (lo - start).alias("first"),
                    (F.greatest(F.least(hi, b * block_words + reads), lo) - lo).alias("n"))
            return bind(_unpermute(b, F.col("__mix_blocks"), F.xxhash64(key, p), rounds), rank)
        return F.transform(F.sequence(F.lit(0).cast("long"), F.col("__mix_passes")), of_pass)

    found = F.flatten(F.transform(F.sequence(F.floor(start / block_words), F.floor((start + size - 1) / block_words)), of_block))
    out = F.when(size > 0, F.filter(found, lambda x: x["n"] > 0)).otherwise(
        F.array().cast("array<struct<shard:bigint,slot:bigint,pass:int,block:bigint,first:bigint,n:bigint>>"))
    # the last block of a source is short: where the part pass reads it whole, it reads so many words more
    tail = total - (F.col("__mix_blocks") - 1) * block_words
    at = _unpermute(F.col("__mix_blocks") - 1, F.col("__mix_blocks"), F.xxhash64(key, F.col("__mix_passes")), rounds)
    rest = F.when(at * block_words + tail <= rest, rest + block_words - tail).otherwise(rest)
    return out, {"__mix_blocks": n_blocks, "__mix_passes": passes, "__mix_rest": rest}


def mix(df: DataFrame, sizes: DataFrame | None = None, weights=WEIGHTS, factor: float = 1.5, limit: float = 2.0,
        block_words: int = BLOCK_WORDS, chunks: int = CHUNKS, rounds: int = ROUNDS, shard_slots: int = SHARD_SLOTS,
        seed: int = 17) -> DataFrame:
    """``df`` (doc_id, source, text or size, ...) with size, source_size,
    target, taken and pieces (the places of its words in the mixture).

    ``size`` is counted from ``text`` unless ``df`` brings ``__mix_size`` and
    ``__mix_hash`` (see ``sized``); ``sizes`` may be a stored narrow copy of
    ``df`` for the sums, else ``df`` is read twice."""
    if "__mix_size" not in df.columns:
        df = sized(df)
    own = {c.lower() for c in WRITTEN}
    df = df.select(*[f"`{c}`" for c in df.columns if c.lower() not in own])
    narrow = (sizes if sizes is not None else df).select("source", "__mix_size", "__mix_hash")
    placed = narrow.withColumn("skey", _source_key(F.col("source"))).withColumn("chunk", F.pmod(F.col("__mix_hash"), F.lit(chunks)))
    sums = placed.groupBy("skey", "chunk").agg(F.sum("__mix_size").alias("n"), F.first("source").alias("source"))
    totals = sums.groupBy("skey").agg(F.sum("n").alias("source_size"), F.first("source").alias("source"))
    before = Window.partitionBy("skey").orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = sums.select(F.col("skey").alias("__mix_skey"), F.col("chunk").alias("__mix_chunk"),
                         (F.sum("n").over(before) - F.col("n")).alias("__mix_base"))
    targets = source_targets(totals, weights, factor, limit).withColumnRenamed("skey", "__mix_skey")
    shards = F.greatest(F.ceil(F.sum(F.ceil("target") / block_words).over(Window.partitionBy()) / shard_slots), F.lit(1)).cast("long")
    table = starts.join(targets.withColumn("__mix_shards", shards), "__mix_skey")

    rows = df.withColumn("__mix_skey", _source_key(F.col("source"))).withColumn("__mix_chunk", F.pmod(F.col("__mix_hash"), F.lit(chunks)))
    within = Window.partitionBy("__mix_skey", "__mix_chunk").orderBy("__mix_hash", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = rows.join(table, ["__mix_skey", "__mix_chunk"])
    rows = rows.withColumnRenamed("__mix_size", "size").withColumn(
        "__mix_start", F.col("__mix_base") + F.sum("size").over(within) - F.col("size"))
    pieces, helpers = _pieces(block_words, rounds, F.col("__mix_shards"), seed)
    for name, col in helpers.items():
        rows = rows.withColumn(name, F.when(F.col("source_size") > 0, col).otherwise(F.lit(0).cast("long")))
    rows = rows.withColumn("pieces", pieces)
    rows = rows.withColumn("taken", F.aggregate("pieces", F.lit(0).cast("long"), lambda a, x: a + x["n"]))
    return rows.drop(*[c for c in rows.columns if c.startswith("__mix_")])


def sized(df: DataFrame) -> DataFrame:
    """``df`` with the word count and the hash that orders the stream."""
    keep = [f"`{c}`" for c in df.columns if not c.startswith("__mix_")]
    return df.select(*keep, F.size(words(F.col("text"))).cast("long").alias("__mix_size"),
                     F.xxhash64("doc_id", "text").alias("__mix_hash"))


def mixed_texts(df: DataFrame, **options) -> DataFrame:
    """The mixture as documents: for each document and pass, the words that
    the pass takes, in order (the text itself where it takes all).  Returns
    the columns of ``df``; ``n_chars``, if there, is counted again.  A document
    of which nothing is taken gives no row."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")
    mixed = mix(df.select(row, "doc_id", "source", "text"), **options)
    passes = F.explode(F.array_distinct(F.transform("pieces", lambda x: x["pass"])))
    out = mixed.select("__row", "text", "size", "pieces", passes.alias("__pass"))
    here = F.filter("pieces", lambda x: x["pass"] == F.col("__pass"))
    n = F.aggregate(here, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    cut = bind(words(F.col("text")), lambda w: F.array_join(F.flatten(F.transform(
        here, lambda x: F.slice(w, (x["first"] + 1).cast("int"), x["n"].cast("int")))), " "))
    out = out.withColumn("__text", F.when(n == F.col("size"), F.col("text")).otherwise(cut))
    fields = {"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return out.select(*[fields.get(c, F.col("__row")[c]).alias(c) for c in df.columns])
