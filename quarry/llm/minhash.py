"""Near-duplicate documents by MinHash with sequential Bayesian verification.

A document is the set of its word shingles.  Equal sets are one node from the
start.  Nodes that share a band of signature rows are candidates; the number
of bands follows from the similarity and the chosen miss probability.
Candidates are compared inside a task: batches of signature rows are compared
one after another, and a pair is dropped as soon as the posterior probability
that it is similar falls below the miss probability; survivors are verified on
their whole sets.  Links found are joined to components.

Scale: a text is hashed once, and its sketch is stored beside it; copies are
collapsed by a map-side combined sum before anything else and are numbers from
then on; buckets become star edges (never all pairs); texts of candidates alone
are moved; a candidate group is cut into blocks of bounded rows and shingles,
and pairs of blocks go to tasks on their own, each giving back a spanning forest
only.  Candidate components of more than ``group_most`` sets are dealt bucket by
bucket instead; either way the pairs looked at are those that share a band, so
the way of dealing changes no result.  Nothing is capped.  A link is confirmed
on the shingles themselves, not on their hashes.

Defined results: null or empty texts, and texts of white space, have an empty
set, are linked with nothing and are their own component; with fewer words
than a shingle the whole sequence is the one shingle; repeated rows and equal
sets are linked; ``component_id`` is the least id that is not null in the
component; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import components
from quarry.operators.grouped import each_group
from quarry.session import store

SHINGLE = 5
PERCENT = 80
MISS = 1e-6
BATCH = 32
BLOCK_ROWS = 512
BLOCK_SHINGLES = 400_000
GROUP_MOST = 8192

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Words whose digests a worker keeps, and bytes of text split at once.
CACHE_WORDS, STEP_BYTES = 100_000, 1 << 20
_BLANK = re.compile(rb"[ \t-\r]")


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Digests(dict):
    """Word -> 16 bytes; emptied when it is full, which changes no result."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = hashlib.blake2b(word, digest_size=16).digest()
        if len(word) <= 64:
            self[word] = found
        return found


_digests = _Digests()


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, A-Z in lower case, about a megabyte at a time."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    start = 0
    while start < len(data):
        cut = _BLANK.search(data, start + STEP_BYTES)
        stop = cut.start() if cut else len(data)
        yield data[start:stop].split()
        start = stop + 1


def shingle_hashes(text: str | None, k: int) -> tuple[np.ndarray, bytes | None]:
    """Sorted distinct 64-bit hashes of the k-word shingles of a text, and 16
    bytes that name their set (null: an empty one).  Both rest on 128-bit
    digests of the words; the name also takes in a second hash of each shingle
    from the other half of the digests."""
    digests = b"".join(d for words in words_of(text) for d in map(_digests.__getitem__, words))
    halves = np.frombuffer(digests, dtype="<u8").reshape(-1, 2)
    n = len(halves)
    if not n:
        return np.empty(0, dtype=np.uint64), None
    width = min(k, n)

    def combined(words):
        out = np.full(n - width + 1, np.uint64(width), dtype=np.uint64)
        for j in range(width):
            out += mix(words[j:n - width + 1 + j] + np.uint64(j + 1))
            out = mix(out)
        return out
    found, first = np.unique(combined(halves[:, 0]), return_index=True)
    second = combined(halves[:, 1])[first]
    return found, hashlib.blake2b(found.tobytes() + mix(second ^ found).sum(dtype=np.uint64).tobytes(), digest_size=16).digest()


def shingle_set(text: str | None, k: int) -> np.ndarray:
    return shingle_hashes(text, k)[0]


def similar(a: str, b: str, k: int, percent: int) -> bool:
    """The similarity test on the shingles themselves: words are numbered, and
    the shingles as word numbers, so that equal numbers are equal shingles."""
    number: dict[bytes, int] = {}
    sides = [np.array([number.setdefault(w, len(number)) for ws in words_of(t) for w in ws], np.int64) for t in (a, b)]
    widths = [min(k, len(x)) for x in sides]
    if not all(widths):
        return False
    if widths[0] != widths[1]:
        return False
    codes = [x[:len(x) - widths[0] + 1] for x in sides]
    for j in range(1, widths[0]):
        joined = np.concatenate([c * len(number) + x[j:len(x) - widths[0] + 1 + j] for c, x in zip(codes, sides)])
        ranks = np.unique(joined, return_inverse=True)[1]
        codes = [ranks[:len(codes[0])], ranks[len(codes[0]):]]
    one, two = (np.unique(c) for c in codes)
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


class Plan:
    """Bands, rows and pruning limits for a similarity and miss probability."""

    def __init__(self, percent: int, miss: float, rows: int | None = None, seed: int = 7):
        t = percent / 100
        self.percent, self.rows = percent, rows or (8 if percent >= 85 else 6)
        self.bands = math.ceil(math.log(miss) / math.log1p(-t ** self.rows)) if t < 1 else 1
        self.n = self.bands * self.rows
        rng = np.random.Generator(np.random.PCG64(seed))
        self.mul = (rng.integers(0, 1 << 32, self.n, dtype=np.uint32) | np.uint32(1))[:, None]
        self.xor = rng.integers(0, 1 << 32, self.n, dtype=np.uint32)[:, None]
        self.stops = [min(s + BATCH, self.n) for s in range(0, self.n, BATCH)]
        self.least = [self._least(n, t, miss) for n in self.stops]

    @staticmethod
    def _least(n: int, t: float, miss: float) -> int:
        """Fewest equal rows of n with P(similarity >= t) >= miss, prior uniform:
        the posterior is Beta(m + 1, n - m + 1), its tail a binomial sum."""
        total = 0.0
        for m in range(n + 1):
            total += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if total >= miss:
                return m
        return n

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
        out = np.full(self.n, 0xFFFFFFFF, dtype=np.uint32)
        for s in range(0, len(x), 512):
            np.minimum(out, ((x[None, s:s + 512] ^ self.xor) * self.mul).min(axis=1), out=out)
        return out

    def band_keys(self, signature: np.ndarray) -> np.ndarray:
        rows = signature.reshape(self.bands, self.rows).astype(np.uint64)
        out = np.arange(1, self.bands + 1, dtype=np.uint64) * _BASE
        for j in range(self.rows):
            out = mix(out + rows[:, j])
        return out.view(np.int64)


def _sketches(df: DataFrame, id_col: str, text_col: str, k: int, plan: Plan, row: Column) -> DataFrame:
    """``(id, text, row, n, key, bands)`` of every row."""
    @F.arrow_udf("struct<n:bigint,key:binary,bands:array<bigint>>")
    def sketch(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            n, keys, bands = [], [], []
            for t in batch:
                s, key = shingle_hashes(t.as_py(), k)
                n.append(len(s))
                keys.append(key)
                bands.append(plan.band_keys(plan.signature(s)) if key else None)
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["n", "key", "bands"])
            pa.default_memory_pool().release_unused()
    text = F.col(f"`{text_col}`")
    return df.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), row.alias("row"), sketch(text).alias("s")).select("id", "text", "row", "s.*")


def verify_group(keys: list, sides: np.ndarray, texts: list[str], k: int, plan: Plan) -> list[tuple]:
    """Spanning forest of the verified links among rows (all of one side) or
    between the rows of side 0 and side 1.  Only pairs that share a band are
    looked at, however the rows came together."""
    n = len(keys)
    sets = [shingle_set(t, k) for t in texts]
    signatures = np.stack([plan.signature(s) for s in sets])
    bands = np.stack([plan.band_keys(s) for s in signatures])
    sizes = np.array([len(s) for s in sets])
    found = []
    two = bool(sides.any() and not sides.all())
    label = np.arange(n)
    for i in range(n):
        if two and sides[i]:
            continue
        rest = np.flatnonzero(sides == 1) if two else np.arange(i + 1, n)
        rest = rest[label[rest] != label[i]]
        rest = rest[100 * np.minimum(sizes[rest], sizes[i]) >= plan.percent * np.maximum(sizes[rest], sizes[i])]
        rest = rest[(bands[rest] == bands[i]).any(axis=1)]
        equal, start = np.zeros(len(rest), dtype=np.int64), 0
        for stop, least in zip(plan.stops, plan.least):
            if not len(rest):
                break
            equal += (signatures[rest, start:stop] == signatures[i, start:stop]).sum(axis=1)
            keep = equal >= least
            rest, equal, start = rest[keep], equal[keep], stop
        for j in rest[np.argsort(-equal, kind="stable")]:
            if label[i] == label[j]:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= plan.percent * (sizes[i] + sizes[j] - both) and similar(texts[i], texts[j], k, plan.percent):
                label[label == label[j]] = label[i]
                found.append((keys[i], keys[j]))
    return found


def _links(sketches: DataFrame, nodes: DataFrame, k: int, plan: Plan, block_rows: int, block_shingles: int, group_most: int) -> DataFrame:
    """Verified links (a, b) between nodes, enough to connect all that are
    similar.  ``nodes``: node (a number), key, n, bands."""
    banded = nodes.select("node", F.explode("bands").alias("band"))
    shared = store(banded.groupBy("band").agg(F.min("node").alias("first"), F.max("node").alias("last"))
                   .filter("first <> last").select("band", "first"), "buckets")
    members = store(banded.join(shared, "band"), "members")
    groups = components(members.select(F.col("node").alias("a"), F.col("first").alias("b")))
    groups = store(groups, "groups")
    count = groups.groupBy("root").agg(F.count("*").alias("m"))
    counted = groups.join(count, "root")
    small = counted.filter(F.col("m") <= group_most).select("node", F.concat(F.lit("g"), F.col("root").cast("string")).alias("group"))
    large = members.join(counted.filter(F.col("m") > group_most).select("node"), "node").select(
        "node", F.concat(F.lit("b"), F.col("band").cast("string")).alias("group"))
    grouped = small.union(large).join(nodes.select("node", "n"), "node")
    blocks = grouped.groupBy("group").agg(F.greatest(
        F.ceil(F.count("*") / block_rows), F.ceil(F.sum("n") / block_shingles)).cast("int").alias("blocks"))
    placed = grouped.select("node", "group").join(blocks, "group").withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # a row goes to every pair of blocks that has its own; side 1 is the higher block of two
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = placed.withColumn("other", other).select(
        "node", "group", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"))
    # texts of candidates only, one for each set
    wanted = groups.select("node").join(nodes.select("node", "key"), "node")
    texts = sketches.select("key", "text").join(wanted, "key").groupBy("node").agg(F.first("text").alias("text"))

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if table.num_rows > 1:
            pairs = verify_group(table["node"].to_pylist(), np.array(table["side"].to_pylist()), table["text"].to_pylist(), k, plan)
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])
    return each_group(paired.join(texts, "node"), ["group", "lo", "hi"], "a long, b long", work)


def _classes(df: DataFrame, id_col: str, text_col: str, row: Column, shingle: int = SHINGLE, percent: int = PERCENT, miss: float = MISS,
             rows: int | None = None, block_rows: int = BLOCK_ROWS, block_shingles: int = BLOCK_SHINGLES,
             group_most: int = GROUP_MOST) -> tuple[DataFrame, DataFrame]:
    """The stored sketches ``(place, id, text, row, n, key, bands)`` and the
    least id ``(key, component)`` of each set's component."""
    plan = Plan(percent, miss, rows)
    sketches = _sketches(df, id_col, text_col, shingle, plan, row)
    sketches = store(sketches.withColumn("place", F.monotonically_increasing_id()), "sketches")
    nodes = sketches.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    nodes = store(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    roots = components(_links(sketches, nodes, shingle, plan, block_rows, block_shingles, group_most))
    linked = roots.join(nodes.select("node", "least"), "node")
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    named = nodes.select("key", "node", "least").join(roots.join(least, "root").select("node", "component"), "node", "left")
    return sketches, named.select("key", F.coalesce("component", "least").alias("component"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``df``: its id, n_shingles (long), component_id
    (least id of the rows it is linked with, itself included), kept (its id is
    the component's) and set_key (binary, equal for equal sets).  Options:
    shingle, percent, miss, rows, block_rows, block_shingles, group_most."""
    sketches, named = _classes(df, id_col, text_col, F.lit(True), **options)
    out = sketches.select("id", "n", "key").join(named, "key", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"), F.col("key").alias("set_key"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` with one row of each component: that of its least
    id (one of them if it is repeated).  Rows with an empty set all stay."""
    sketches, named = _classes(df, id_col, text_col, F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text_col]), **options)
    # one place for each component, found on narrow rows; a row whose set is empty is its own
    narrow = sketches.select("key", "id", "place").join(named, "key", "left")
    chosen = narrow.filter("key IS NOT NULL AND id <=> component").groupBy("key").agg(F.min("place").alias("place")).select("place")
    chosen = chosen.union(narrow.filter("key IS NULL").select("place"))
    kept = sketches.select("place", "text", "row").join(chosen, "place", "left_semi")
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in df.columns])
