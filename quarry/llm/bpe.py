"""Byte-level BPE encoding and decoding.

A text is split by the tokenizer's pattern; each piece is a byte array whose
neighbours merge in rank order until no neighbouring pair has a rank.  Distinct
pieces are folded, not occurrences.

There are two forms with equal results.  ``encode_native`` runs the merges as
Spark higher-order functions over token ids with a literal rank map (a pair of
literal arrays with two possible places for a key, so a lookup costs two index
reads whatever the size of the vocabulary).  ``encode`` folds the same merges
in Arrow batches and keeps the distinct pieces of a task in a bounded cache;
the registered query uses it, because the native form needs about four times
the CPU that the query may use (figures in the README).  Decoding is native in
both: it concatenates the binary pieces of the ids.

Scale: ``encode`` is one scan without a shuffle.  ``encode_native`` counts
distinct pieces first (map-side combined) and holds the most frequent ones,
a fixed number, in a literal; all others are folded where they occur.

Defined results: a null or empty text has no ids and decodes to no bytes; null
ids, repeated rows and empty tables pass through row by row; an input column
``ids`` is replaced, others are carried along.
"""

from __future__ import annotations

import base64
import heapq
import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import bind

HOT_WORDS = 200_000
CACHE_PIECES = 250_000
SHORT, NO_RANK = 64, 1 << 60
#: Pieces longer than this many characters are not kept.
HOT_LENGTH = 64


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 token, space, rank)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def two_places(keys: list[int], sizes: tuple[int, int]) -> tuple[list[int], list[int]] | None:
    """Cuckoo placement: index of the key at each place of two tables (-1:
    none); key k may be at k % size of either.  None if it does not settle."""
    tables = ([-1] * sizes[0], [-1] * sizes[1])
    for n in range(len(keys)):
        item, side = n, 0
        for _ in range(500):
            place = keys[item] % sizes[side]
            item, tables[side][place] = tables[side][place], item
            if item < 0:
                break
            side = 1 - side
        else:
            return None
    return tables


class Places:
    """Two-place hash table as two Spark literals.  ``entries`` are the JSON
    values stored for the non-negative int ``keys``."""

    def __init__(self, keys: list[int], entries: list, kind: str):
        n = max(len(keys), 8)
        sizes = (n + n // 8 + 1, n + n // 8 + 8)
        while (found := two_places(keys, sizes)) is None:
            sizes = (sizes[0] + n // 4 + 2, sizes[1] + n // 4 + 11)
        self.sizes = sizes
        self.tables = [literal([entries[i] if i >= 0 else None for i in t], f"array<{kind}>") for t in found]

    def look(self, key: Column, match) -> Column:
        """``match(entry)`` of the first of a key's places where that is not
        null.  Literals are used directly: a lambda variable would copy them."""
        def at(side, k):
            return bind(F.get(self.tables[side], (k % self.sizes[side]).cast("int")), match)
        return bind(key, lambda k: F.coalesce(at(0, k), at(1, k)))


def literal(values: list, kind: str) -> Column:
    """A literal of JSON values; the optimizer folds it to one constant."""
    return F.from_json(F.lit(json.dumps(values, separators=(",", ":"))), kind)


class Vocabulary:
    """Literals made from a rank file: ids of bytes, merged ids of pairs."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        self.size = max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.of_byte = literal([ranks[bytes([b])] for b in range(256)], "array<int>")
        self.pairs = Places(list(pairs), [k * self.size + r for k, r in pairs.items()], "bigint")

    def fold(self, word: Column) -> Column:
        """array<int>: the ids of a piece.  State: the ids and, for each, the
        rank of its pair with the next one (null: none).  A step merges the
        first pair of least rank; only the two pairs beside it are looked up
        again (one lookup in the plan serves both)."""
        size = F.lit(self.size).cast("bigint")

        def ranks_of(lefts, rights):
            def rank(a, b):
                return bind(a * size + b, lambda key: self.pairs.look(key, lambda e: F.when(
                    (e >= key * size) & (e < (key + 1) * size), (e % size).cast("int"))))
            return F.zip_with(lefts, rights, rank)

        def start(ids):
            return F.struct(ids.alias("ids"), ranks_of(ids, F.slice(ids, F.lit(2), F.size(ids))).alias("ranks"))

        def merge(s):
            def put(best, i):  # i: place of the pair, from 1
                n = F.size(s["ids"])
                before, after = F.get(s["ids"], i - 2), F.get(s["ids"], i + 1)
                rest = F.greatest(n - i - 1, F.lit(0))
                ids = F.concat(F.slice(s["ids"], F.lit(1), i - 1), F.array(best), F.slice(s["ids"], i + 2, rest))
                new = ranks_of(F.array(before, best), F.array(best, after))
                ranks = F.concat(F.slice(s["ranks"], F.lit(1), F.greatest(i - 2, F.lit(0))),
                                 F.slice(new, F.when(i > 1, 1).otherwise(2), F.lit(2)), F.slice(s["ranks"], i + 2, rest))
                return F.struct(ids.alias("ids"), ranks.alias("ranks"))
            return bind(F.array_min(s["ranks"]), lambda best: F.when(best.isNull(), s).otherwise(
                bind(F.array_position(s["ranks"], best).cast("int"), lambda i: put(best, i))))

        def run(ids):
            return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(ids) - 1, F.lit(1))), start(ids), lambda s, _: merge(s), lambda s: s["ids"])
        return bind(self.byte_ids(word), run)

    def byte_ids(self, word: Column) -> Column:
        """Ids of the single bytes of a string."""
        digits = F.hex(F.encode(word, "UTF-8"))
        return bind(digits, lambda h: F.transform(F.sequence(F.lit(1), F.octet_length(word)), lambda i: F.get(
            self.of_byte, F.conv(F.substring(h, 2 * i - 1, F.lit(2)), 16, 10).cast("int"))))


def pieces(text: Column, pattern: str) -> Column:
    """array<string>: the matches of the tokenizer's pattern, whole text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + pattern), F.lit(0))


def hot_pieces(df: DataFrame, vocabulary: Vocabulary, pattern: str, text_col: str = "text",
               hot_words: int = HOT_WORDS) -> Places:
    """The ``hot_words`` pieces that most texts have, folded, as a literal.
    What reaches the driver has that fixed bound (and HOT_LENGTH a piece)."""
    each = df.select(F.explode(F.array_distinct(pieces(F.col(text_col), pattern))).alias("piece"))
    counted = each.filter(F.length("piece") <= HOT_LENGTH).groupBy("piece").count()
    top = counted.orderBy(F.desc("count"), "piece").limit(hot_words).select("piece")
    spread = top.repartition("piece")
    rows = spread.select("piece", place(F.col("piece")).alias("key"), F.array_join(
        vocabulary.fold(F.col("piece")).cast("array<string>"), ",").alias("ids")).collect()
    unique = {r.key: r for r in rows}  # of two pieces with one key the second is folded where it occurs
    return Places(list(unique), [{"p": r.piece, "i": [int(x) for x in r.ids.split(",")]} for r in unique.values()],
                  "struct<p:string,i:array<int>>")


def place(piece: Column) -> Column:
    """Non-negative hash of a piece."""
    return F.shiftrightunsigned(F.xxhash64(piece), 1)


def fold_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: merge the first pair of least rank until none is
    left.  Short pieces look at all pairs in each step.  In long ones
    neighbours are linked and pairs wait in a heap, dropped when a merge has
    changed them, so a piece of n bytes takes O(n log n)."""
    rank, n = ranks.get, len(piece)
    whole = rank(piece)
    if whole is not None:
        return [whole]
    if n <= SHORT:
        parts = [piece[i:i + 1] for i in range(n)]
        found = [rank(piece[i:i + 2], NO_RANK) for i in range(n - 1)]
        while found and (least := min(found)) < NO_RANK:
            i = found.index(least)
            parts[i] += parts.pop(i + 1)
            found.pop(i)
            if i < len(found):
                found[i] = rank(parts[i] + parts[i + 1], NO_RANK)
            if i:
                found[i - 1] = rank(parts[i - 1] + parts[i], NO_RANK)
        return [ranks[x] for x in parts]
    end = list(range(1, n + 1))  # end of the part that starts here
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    alive = bytearray(b"\1") * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        alive[end[i]] = 0
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        p = before[i]
        if p >= 0 and (r := ranks.get(piece[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]


class PieceCache(dict):
    """piece -> its ids as little-endian int32 bytes, for pieces met so far;
    emptied when it is full, which changes no result."""

    def __init__(self, ranks: dict[bytes, int], most: int):
        super().__init__()
        self.ranks, self.most = ranks, most

    def __missing__(self, piece: str) -> bytes:
        found = fold_bytes(piece.encode(), self.ranks)
        ids = struct.pack(f"<{len(found)}i", *found)
        if len(self) >= self.most:
            self.clear()
        if len(piece) <= HOT_LENGTH:
            self[piece] = ids
        return ids


_CACHES: dict[tuple, PieceCache] = {}


def worker_cache(key: tuple, ranks: dict[bytes, int], most: int) -> PieceCache:
    """The cache of this Python worker; tasks that follow reuse it."""
    if key not in _CACHES:
        _CACHES.clear()
        _CACHES[key] = PieceCache(ranks, most)
    return _CACHES[key]


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", cache_pieces: int = CACHE_PIECES) -> DataFrame:
    """``df`` with ``ids`` (array<int>): the ids of the whole text."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(path))

    @F.arrow_udf("array<int>")
    def ids_of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import regex

        split, cache = regex.compile(pattern).findall, worker_cache((path, cache_pieces), ranks.value, cache_pieces)
        for batch in texts:
            rows = [b"".join(map(cache.__getitem__, split(t))) if t else b"" for t in map(pa.StringScalar.as_py, batch)]
            ends = np.cumsum([0] + [len(r) // 4 for r in rows], dtype=np.int64)
            yield pa.LargeListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(rows), dtype="<i4"))).cast(pa.list_(pa.int32()))
    return df.withColumn("ids", ids_of(F.col(f"`{text_col}`")))


def encode_native(df: DataFrame, path: str, pattern: str, text_col: str = "text", hot_words: int = HOT_WORDS) -> DataFrame:
    """``df`` with ``ids`` (array<int>): the ids of the whole text, by
    higher-order functions alone."""
    vocabulary = Vocabulary(path)
    hot = hot_pieces(df, vocabulary, pattern, text_col, hot_words)

    def of_piece(x):
        return F.coalesce(hot.look(place(x), lambda e: F.when(e["p"] == x, e["i"])), vocabulary.fold(x))
    return df.withColumn("ids", F.flatten(F.transform(pieces(F.col(text_col), pattern), of_piece)))


def decode(ids: Column, path: str) -> Column:
    """binary: the pieces of the ids, concatenated."""
    by_id = {r: t.hex() for t, r in read_ranks(path).items()}
    table = literal([by_id.get(i) for i in range(max(by_id) + 1)], "array<string>")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))
