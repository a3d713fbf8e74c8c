"""Removal of byte strings that occur more than once in a collection.

Documents are byte strings; a byte goes if a string of ``length`` bytes that
covers it also starts somewhere else.  The collection's suffixes are sorted
column by column: each round inserts one symbol of every string, turns the
order of the suffixes behind it (the Burrows-Wheeler order of the column) into
the order with it by one stable sort, and updates the common prefixes of
neighbours.  Inserting columns for whole documents would take as many rounds
over all data as the longest document has bytes, so strings are aligned first:
in every window of ``length`` bytes the k-grams of least hash are anchors, so
two equal windows have an anchor at the same place in them.  Around an anchor
only 2 * length - k columns matter, and only strings with an equal anchor can
match; rounds run over bounded collections of such strings, in memory, so no
external files are needed.

Scale: one scan makes about two anchors per ``length`` bytes, once for the
copies of a text in a task.  Anchors that occur once are dropped by a map-side
combined count; equal contexts are one string.  Only contexts that differ
around an equal anchor are fetched and sorted.  Anchors with more contexts
than ``group_most`` are not gathered: their windows are counted by hash
instead (map-side combined), which gives the same result.  Texts are shuffled
twice, compressed.

Defined results: null text is empty; texts shorter than ``length`` bytes lose
nothing; equal texts of at least that length lose everything; null ids and
repeated rows are rows like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.minhash import mix
from quarry.session import store

LENGTH = 400
GRAM = 32
GROUP_MOST = 40_000
ROUND_ROWS = 20_000
BATCH_ROWS = 20_000


def sliding(x: np.ndarray, w: int, pick: np.ufunc, pad: int) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``w`` neighbours, in two passes."""
    n = len(x)
    rows = np.full(-(-n // w) * w, pad, dtype=x.dtype)
    rows[:n] = x
    rows = rows.reshape(-1, w)
    head = pick.accumulate(rows, axis=1).ravel()
    tail = pick.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(tail[:n - w + 1], head[w - 1:n])


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse."""
    if len(_powers.get("p", ())) <= n:
        m = max(1 << 16, 1 << (n + 1).bit_length())
        base = 0x9E3779B97F4A7C15
        for name, factor in (("p", base), ("q", pow(base, -1, 1 << 64))):
            ones = np.full(m, factor, dtype=np.uint64)
            ones[0] = 1
            _powers[name] = np.cumprod(ones)
    return _powers["p"], _powers["q"]


class Bytes:
    """Bytes of a text with the sums that hash any part of it."""

    def __init__(self, data: bytes):
        self.data = np.frombuffer(data, dtype=np.uint8)
        p, self.inverse = _power(len(data) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * p[:len(data)])))

    def hashes(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.sums[hi] - self.sums[lo]) * self.inverse[lo] + (hi - lo).astype(np.uint64))


def anchors(b: Bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, hashes and context hashes of a text's anchors."""
    n = len(b.data)
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    starts = np.arange(n - gram + 1)
    h = b.hashes(starts, starts + gram)
    w = length - gram + 1
    least = sliding(h, w, np.minimum, np.iinfo(np.uint64).max)
    edge = np.zeros(w - 1, dtype=np.uint64)
    at = np.flatnonzero(sliding(np.concatenate((edge, least, edge)), w, np.maximum, 0) == h)
    lo, hi = np.maximum(at + gram - length, 0), np.minimum(at + length, n)
    # contexts that count as equal are told by a digest of their bytes; the sums only choose anchors
    data = b.data.tobytes()
    digests = b"".join([hashlib.blake2b(data[x:y], digest_size=8).digest() for x, y in zip(lo.tolist(), hi.tolist())])
    context = mix(np.frombuffer(digests, "<u8") + (at - lo).astype(np.uint64))
    return at, h[at], context


def repeated_starts(contexts: list[bytes], lefts: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Rows of (string, start, end), start and end relative to the anchor: the
    runs covered by windows that another string has at the same place.

    ``order`` sorts the suffixes that begin in a column, ``common[i]`` is the
    common prefix of the i-th and the one before it."""
    n, first, last = len(contexts), gram - length, length
    width = last - first
    table = np.full((width, n), 256, dtype=np.uint16)  # 256: outside the document, equal to nothing
    for i, c in enumerate(contexts):
        lo = int(lefts[i]) - first
        table[lo:lo + len(c), i] = np.frombuffer(c, dtype=np.uint8)
    order, common = np.arange(n), np.zeros(n, dtype=np.int32)
    begun = np.full(n, -1, dtype=np.int64)  # start of the latest run, columns going left
    ended = np.full(n, -1, dtype=np.int64)
    out = []
    for column in range(width - 1, -1, -1):
        symbols = table[column, order]
        by = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[by]
        same = np.zeros(n, dtype=bool)
        same[1:] = (sorted_symbols[1:] == sorted_symbols[:-1]) & (sorted_symbols[1:] != 256)
        fresh = np.zeros(n, dtype=np.int32)
        to = np.flatnonzero(same)
        if len(to):
            # least common prefix between the two places in the former order
            spans = np.empty(2 * len(to), dtype=np.int64)
            spans[0::2], spans[1::2] = by[to - 1] + 1, by[to] + 1
            fresh[to] = np.minimum.reduceat(np.append(common, 0), spans)[0::2] + 1
        order, common = order[by], fresh
        start = column + first
        if start > 0:
            continue
        reach = np.maximum(common, np.append(common[1:], 0)) >= length
        hit = order[reach]
        gone = hit[(begun[hit] >= 0) & (begun[hit] > column + length)]
        if len(gone):
            out.append(np.stack([gone, begun[gone] + first, ended[gone] + first], axis=1))
            begun[gone] = -1
        fresh_run = hit[begun[hit] < 0]
        ended[fresh_run] = column + length
        begun[hit] = column
    left = np.flatnonzero(begun >= 0)
    out.append(np.stack([left, begun[left] + first, ended[left] + first], axis=1))
    return np.concatenate(out)


def squeeze(text) -> Column:
    """A text's UTF-8 bytes compressed for a shuffle (binary, null for null)."""
    @F.arrow_udf("binary")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in texts:
            yield pa.array([None if t is None else packer.compress(t.encode()) for t in batch.to_pylist()], pa.binary())
    return run(text)


def spread(data: bytes | None) -> bytes:
    return b"" if data is None else zstandard.ZstdDecompressor().decompress(data)


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def _anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        keys = np.repeat(np.array([r[0] for r in rows], dtype=object), [len(r[1]) for r in rows])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([r[2] for r in rows]).view(np.int64)), pa.array(np.concatenate([r[3] for r in rows]).view(np.int64)),
             pa.array(keys, pa.binary()), pa.array(np.concatenate([r[1] for r in rows]), pa.int64())], ["a", "c", "key", "pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, n, met = [], 0, set()
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text")):
                if key.as_py() in met:
                    continue
                met.add(key.as_py())
                rows.append((key.as_py(), *anchors(Bytes(text.as_py().encode()), length, gram)))
                n += len(rows[-1][1])
                if n >= BATCH_ROWS:
                    yield batch_of(rows)
                    rows, n = [], 0
        if rows:
            yield batch_of(rows)
    return texts.mapInArrow(run, "a bigint, c bigint, key binary, pos bigint")


def _contexts(texts: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """(a, c, left, context) of the wanted (a, c, key, pos)."""
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("pos", "a", "c")).alias("places"))
    one = texts.select("key", squeeze("text").alias("text")).groupBy("key").agg(F.first("text").alias("text"))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["a", "c", "left", "context"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for text, places in zip(batch.column("text"), batch.column("places")):
                data = spread(text.as_py())
                for x in places.as_py():
                    lo, hi = max(x["pos"] + gram - length, 0), min(x["pos"] + length, len(data))
                    rows.append((x["a"], x["c"], lo - x["pos"], data[lo:hi]))
                    if len(rows) >= BATCH_ROWS:
                        yield batch_of(rows)
                        rows = []
        if rows:
            yield batch_of(rows)
    return one.join(lists, "key").select("text", "places").mapInArrow(run, "a bigint, c bigint, left bigint, context binary")


def _runs_by_rounds(contexts: DataFrame, length: int, gram: int, round_rows: int) -> DataFrame:
    """(a, c, start, end) by column-wise insertion; strings of one anchor are
    in one collection, and a collection may hold those of many anchors."""
    dealt = contexts.repartition("a").sortWithinPartitions("a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def flush(rows):
            runs = repeated_starts([r[3] for r in rows], np.array([r[2] for r in rows]), length, gram)
            at = runs[:, 0]
            return pa.RecordBatch.from_arrays([
                pa.array(np.array([r[0] for r in rows], dtype=np.int64)[at]), pa.array(np.array([r[1] for r in rows], dtype=np.int64)[at]),
                pa.array(runs[:, 1], pa.int64()), pa.array(runs[:, 2], pa.int64())], ["a", "c", "start", "end"])

        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if len(held) >= round_rows and row[0] != held[-1][0]:
                    yield flush(held)
                    held = []
                held.append(row)
        if held:
            yield flush(held)
    return dealt.mapInArrow(run, "a bigint, c bigint, start bigint, end bigint")


def _runs_by_count(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """The same runs for anchors with very many contexts: every window is
    counted by its hash."""
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([r[i] for r in rows]), pa.int64()) for i in range(4)], ["a", "c", "start", "h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for a, c, left, context in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                starts = np.arange(0, min(len(context) - length, -left) + 1)
                h = Bytes(context).hashes(starts, starts + length).view(np.int64)
                rows.append((np.full(len(starts), a), np.full(len(starts), c), starts + left, h))
                if len(rows) >= 256:
                    yield batch_of(rows)
                    rows = []
        if rows:
            yield batch_of(rows)
    windows = contexts.mapInArrow(run, "a bigint, c bigint, start bigint, h bigint")
    twice = windows.groupBy("a", "start", "h").agg(F.min("c").alias("x"), F.max("c").alias("y")).filter("x <> y").select("a", "start", "h")
    return windows.join(twice, ["a", "start", "h"]).select("a", "c", "start", (F.col("start") + length).alias("end"))


def repeated_spans(df: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   group_most: int = GROUP_MOST, round_rows: int = ROUND_ROWS) -> DataFrame:
    """(key, spans): for texts with repeated strings, by the MD5 bytes of the
    text, the byte ranges array<struct<start, end>> that go (unordered, they
    may overlap)."""
    text = F.col(f"`{text_col}`")
    texts = df.filter(F.octet_length(text) >= length).select(_text_key(text).alias("key"), text.alias("text"))
    found = store(_anchor_rows(texts, length, gram), "anchors")
    often = store(found.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select("a"), "frequent-anchors")
    repeated = store(found.join(often, "a"), "repeated-anchors")
    place = F.struct("key", "pos")
    classes = repeated.groupBy("a", "c").agg(F.min(place).alias("one"), F.max(place).alias("last"))
    per_anchor = classes.groupBy("a").agg(F.count("*").alias("contexts"))
    classes = store(classes.join(per_anchor, "a").filter("contexts > 1 OR one <> last"), "contexts")
    wanted = classes.filter("contexts > 1").select("a", "c", "one.key", "one.pos", "contexts")
    few, many = wanted.filter(F.col("contexts") <= group_most), wanted.filter(F.col("contexts") > group_most)
    runs = _runs_by_rounds(_contexts(texts, few.drop("contexts"), length, gram), length, gram, round_rows)
    if not many.isEmpty():
        runs = runs.union(_runs_by_count(store(_contexts(texts, many.drop("contexts"), length, gram), "context-bytes"), length, gram))
    whole = classes.filter("one <> last").select("a", "c", F.lit(gram - length).cast("long").alias("start"), F.lit(length).cast("long").alias("end"))
    spans = repeated.join(runs.union(whole), ["a", "c"]).select(
        "key", F.struct(F.greatest(F.col("pos") + F.col("start"), F.lit(0)).alias("start"), (F.col("pos") + F.col("end")).alias("end")).alias("span"))
    copies = texts.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(
        "key", F.struct(F.lit(0).cast("long").alias("start"), F.lit(1 << 40).cast("long").alias("end")).alias("span"))
    return spans.union(copies).groupBy("key").agg(F.collect_set("span").alias("spans"))


def cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed runs and the bytes that stay."""
    runs: list[list[int]] = []
    for start, end in sorted(spans):
        end = min(end, len(data))
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    edges = [0, *[x for r in runs for x in r], len(data)]
    return [tuple(r) for r in runs], b"".join(data[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2))


def remove_repeats(df: DataFrame, text_col: str = "text", keep_text: bool = True, **options) -> DataFrame:
    """``df`` with ``removed`` (array<struct<start, end>>, maximal byte runs in
    order) and ``kept`` (binary, what stays); input columns of these names are
    replaced.  Without ``keep_text`` the text column itself is left out."""
    spans = repeated_spans(df, text_col, **options)
    kind = "text string, " if keep_text else ""

    @F.arrow_udf(f"struct<{kind}removed array<struct<start:bigint,end:bigint>>, kept binary>")
    def apply(texts: pa.Array, found: pa.Array) -> pa.Array:
        runs, kept, whole = [], [], []
        for t, s in zip(texts, found):
            data = spread(t.as_py())
            r, k = cut(data, [(x["start"], x["end"]) for x in s.as_py() or []])
            runs.append([{"start": a, "end": b} for a, b in r])
            kept.append(k)
            if keep_text:
                whole.append(data.decode() if t.is_valid else None)
        columns = {"removed": pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept": pa.array(kept, pa.binary())}
        if keep_text:
            columns = {"text": pa.array(whole, pa.string())} | columns
        return pa.StructArray.from_arrays(list(columns.values()), list(columns))

    text = F.col(f"`{text_col}`")
    names = [c for c in df.columns if c.lower() not in ("removed", "kept") and (keep_text or c != text_col)]
    others = F.struct(F.lit(0).alias("__"), *[F.col(f"`{c}`") for c in names if c != text_col])
    rows = df.select(others.alias("__row"), squeeze(text).alias("__text"), _text_key(text).alias("__key"))
    joined = rows.join(spans.select(F.col("key").alias("__key"), "spans"), "__key", "left").withColumn("__cut", apply("__text", "spans"))
    back = [F.col("__cut.text").alias(c) if c == text_col else F.col("__row")[c].alias(c) for c in names]
    return joined.select(*back, "__cut.removed", "__cut.kept")
