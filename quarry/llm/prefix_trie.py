"""Prefix trie of conversations by range minima over sorted common prefixes.

Conversations are sequences of turns, a turn a 256-bit digest of its role and
text.  Distinct sequences are sorted; neighbours share a prefix of known length
(LCP).  A prefix of depth d of the sequence at place i is a candidate node: its
members are the places around i that no LCP below d parts from i.  A sparse
table of range minima lets every candidate find its left and its right end on
its own, by binary search; of equal candidates the one at the left end stays.
Counts, leaves, children and saved code points of a node then follow from
prefix sums over its interval, so no tree is ever walked.

Scale: equal sequences are one row with a count (combined before the shuffle),
so a conversation that a third of the ids repeat is one sequence.  Sorted
sequences are cut into parts of bounded size.  A node whose interval touches
the border of its part is open: parts give what they hold of it, at most a node
for each turn of their first and last sequence, these are summed by Spark, and
each part gets back the sums of its own open nodes.  No other node leaves its
part.  The digest of a node's ids is fed from strings of bounded length, made
side by side from sorted ids; only that last hash runs through in order.  A
task holds the digests of one conversation at least, 40 bytes a turn.

Defined results: rows without a conversation id are left out; turns are ordered
by turn, null first, ties by role and then by digest; a null role or text is
empty; repeated rows are repeated turns; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.grouped import each_group
from quarry.session import store

#: Ids below c that are rebuilt on one base conversation, and turns shared at most.
BASE, SHARED = 100, 6
#: Sequences of a part, ids of a string that is hashed, most parts.
PART_ROWS, HASH_IDS, MOST_PARTS = 8192, 1 << 16, 1 << 17
NO_IDS = hashlib.sha256(b"").hexdigest()
SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
ROW = ("part long, kind int, place long, seq array<struct<turn:binary,chars:long>>, n long, low long, ends string, depth int, side int, "
       "n_convs long, n_children long, n_leaves long, saved_tokens long")
OPEN = "key binary, part long, side int, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


# ---------------------------------------------------------------- sequences

def sequences(turns: DataFrame) -> DataFrame:
    """``(conv_id, seq)``: the turns of each conversation in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "UTF-8"), 256))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn"), role.alias("role"), digest.alias("digest"), F.length(text).cast("long").alias("chars")).alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return ordered.select("conv_id", F.transform("ts", lambda t: F.struct(t["digest"].alias("turn"), t["chars"].alias("chars"))).alias("seq"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """``(conv_id, seq)``: conversation c begins with the first h turns of
    conversation c - c % 100, h = crc32(c) % 6, and goes on with its own turns
    after its first h."""
    own = store(sequences(turns), "trie-sequences")
    heads = own.select(F.col("conv_id").alias("base"), F.slice("seq", 1, SHARED - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % SHARED).cast("int")
    rows = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE).join(heads, "base", "left").withColumn("h", h)
    first = F.slice(F.coalesce("head", F.array().cast(own.schema["seq"].dataType)), F.lit(1), F.col("h"))
    rest = F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq") - F.col("h"), F.lit(0)))
    return rows.select("conv_id", F.concat(first, rest).alias("seq"))


def ends(rows: DataFrame) -> DataFrame:
    """``(key, ends)``: the digest of the ascending ids of each ``key``."""
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()),
                                               pa.array([",".join(map(str, ids))])], ["key", "first", "ids"])
        for batch in batches:
            for k, i in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (k != key or len(ids) >= HASH_IDS):
                    yield out()
                    ids = []
                key = k
                ids.append(i)
        if ids:
            yield out()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends"])
        for batch in batches:
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k != key:
                    if state:
                        yield out()
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if state:
            yield out()
    cut = rows.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    cut = cut.mapInArrow(strings, "key binary, first long, ids string")
    return cut.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest, "key binary, ends string")


# ---------------------------------------------------------------- one part

def sparse(values: np.ndarray) -> list[np.ndarray]:
    """Level k, place i: the least of ``values[i:i + 2**k]``."""
    levels = [values]
    while len(levels[-1]) > 1 << (len(levels) - 1):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    return levels


def extents(levels: list[np.ndarray], place: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of the sequences that share ``depth`` turns with
    the one at ``place``; value i of the first level is the LCP of i - 1 and i."""
    n = len(levels[0])
    left, right = place.copy(), place.copy()
    for k in range(len(levels) - 1, -1, -1):
        step, level = 1 << k, levels[k]
        to = left - step
        at = np.clip(to + 1, 0, len(level) - 1)
        left = np.where((to >= 0) & (level[at] >= depth), to, left)
        to = right + step
        at = np.clip(right + 1, 0, len(level) - 1)
        right = np.where((to < n) & (level[at] >= depth), to, right)
    return left, right


def least(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least value in each range, ends included, by two overlapping spans."""
    k = np.frexp((right - left + 1).astype(float))[1] - 1
    out = np.empty(len(left), np.int64)
    for level in np.unique(k):
        on = k == level
        out[on] = np.minimum(levels[level][left[on]], levels[level][right[on] - (1 << int(level)) + 1])
    return out


class Part:
    """The sorted sequences of a part, and its neighbours' nearest ones."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("kind", "ascending"), ("place", "ascending")])
        kind = table["kind"].to_numpy()
        own = table.filter(pa.array(kind == 0))
        self.m, self.part = own.num_rows, table["part"][0].as_py()
        seq = own["seq"].combine_chunks()
        flat = seq.flatten()
        self.size = np.diff(seq.offsets.to_numpy())
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        before, after = ([t["turn"] for t in x[0].as_py()] if len(x := table["seq"].filter(pa.array(kind == k))) else None for k in (-1, 1))
        self.turns = flat.field("turn")
        code = self.turns.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        lcp = np.full(self.m + 1, -1, np.int64)
        for i in range(1, self.m):
            a, b = self.start[i - 1], self.start[i]
            k = min(self.size[i - 1], self.size[i])
            differ = np.flatnonzero(code[a:a + k] != code[b:b + k])
            lcp[i] = differ[0] if len(differ) else k
        for at, i, other in ((0, 0, before), (self.m, self.m - 1, after)):
            if other is not None:
                mine = self.prefix(i, min(int(self.size[i]), len(other)))
                lcp[at] = next((k for k, (x, y) in enumerate(zip(mine, other)) if x != y), len(mine))
        self.lcp = lcp
        self.chars = np.concatenate([[0], np.cumsum(flat.field("chars").to_numpy(zero_copy_only=False))])
        n = own["n"].to_numpy()
        total = self.chars[self.start[1:]] - self.chars[self.start[:-1]]
        fresh = self.chars[self.start[1:]] - self.chars[self.start[:-1] + np.maximum(lcp[:-1], 0)]

        def sums(values):
            return np.concatenate([[0], np.cumsum(values)])
        self.n, self.said, self.fresh, self.leaf = sums(n), sums(n * total), sums(fresh), sums(lcp[1:] < self.size)
        self.levels, self.low = sparse(lcp[:-1]), sparse(own["low"].to_numpy())
        self.ends = own["ends"].to_pylist()
        self.parted = np.sort(lcp[1:-1] * (self.m + 1) + np.arange(1, self.m))  # (LCP, place)
        self.merged = {(r["side"], r["depth"]): r for r in table.filter(pa.array(kind == 2)).drop_columns(["seq"]).to_pylist()}

    def prefix(self, i: int, k: int) -> list[bytes]:
        return self.turns.slice(self.start[i], k).to_pylist()

    def measure(self, left: np.ndarray, right: np.ndarray, depth: np.ndarray) -> dict[str, np.ndarray]:
        """What this part holds of the nodes with these intervals: members,
        children and texts count where they begin, so parts add up."""
        begins = self.lcp[left] < depth  # no earlier member, here or in a part before
        upto = self.start[left] + np.maximum(depth - 1, 0)
        above = self.chars[upto] - self.chars[self.start[left]]
        n = self.n[right + 1] - self.n[left]
        inner = np.searchsorted(self.parted, depth * (self.m + 1) + right, "right") - np.searchsorted(self.parted, depth * (self.m + 1) + left, "right")
        first = np.where(begins, self.size[left] > depth, self.lcp[left] == depth)
        whole = self.chars[self.start[left + 1]] - self.chars[upto]
        texts = self.fresh[right + 1] - self.fresh[left + 1] + np.where(begins, whole, self.fresh[left + 1] - self.fresh[left])
        return {"conv_id": least(self.low, left, right), "n_convs": n, "n_children": inner + first,
                "n_leaves": self.leaf[right + 1] - self.leaf[left], "saved_tokens": self.said[right + 1] - self.said[left] - n * above - texts}

    def open_nodes(self) -> Iterator[pa.RecordBatch]:
        """The part's share of nodes that go on beyond its borders."""
        rows = [(0, 0, d) for d in range(self.lcp[0] + 1)] + [(1, self.m - 1, d) for d in range(self.lcp[self.m] + 1)]
        if not rows:
            return
        side, place, depth = (np.array(c, np.int64) for c in zip(*rows))
        left, right = extents(self.levels, place, depth)
        once = (side == 0) | (left > 0) | (self.lcp[0] < depth)  # a node over the whole part is told once
        found = {k: v[once] for k, v in self.measure(left, right, depth).items()}
        keys = []
        for s, i in ((0, 0), (1, self.m - 1)):
            digest = hashlib.sha256()
            keys.append([digest.digest()])
            for t in self.prefix(i, int(max(self.lcp[0 if s == 0 else self.m], 0))):
                digest.update(t)
                keys[-1].append(digest.digest())
        side, depth = side[once], depth[once]
        yield pa.RecordBatch.from_arrays(
            [pa.array([keys[s][d] for s, d in zip(side, depth)], pa.binary()), pa.array(np.full(len(side), self.part), pa.int64()),
             pa.array(side, pa.int32()), pa.array(depth, pa.int32()), *[pa.array(found[k], pa.int64()) for k in ("conv_id", *SUMS)]],
            ["key", "part", "side", "depth", "conv_id", *SUMS])

    def across(self, left: np.ndarray, right: np.ndarray, depth: np.ndarray, found: dict[str, np.ndarray], names: tuple[str, ...]) -> None:
        """Open nodes get the sums over all parts."""
        by_left, by_right = (left == 0) & (self.lcp[0] >= depth), (right == self.m - 1) & (self.lcp[self.m] >= depth)
        for i in np.flatnonzero(by_left | by_right):
            whole = self.merged[0 if by_left[i] else 1, int(depth[i])]
            for k in names:
                found[k][i] = whole["low" if k == "conv_id" else k]

    def nodes(self) -> Iterator[pa.RecordBatch]:
        """The nodes whose first member is in this part."""
        place = np.repeat(np.arange(self.m), self.size + 1)
        depth = np.arange(len(place)) - np.repeat(self.start[:-1] + np.arange(self.m), self.size + 1)
        left, right = extents(self.levels, place, depth)
        first = (left == place) & (self.lcp[place] < depth)
        left, right, depth = left[first], right[first], depth[first]
        if not len(left):
            return
        found = self.measure(left, right, depth)
        self.across(left, right, depth, found, ("conv_id", *SUMS))
        up = np.maximum(depth - 1, 0)
        up_left, up_right = extents(self.levels, left, up)
        parent = {"conv_id": least(self.low, up_left, up_right)}
        self.across(up_left, up_right, up, parent, ("conv_id",))
        told = [self.ends[i] if here else NO_IDS for i, here in zip(left.tolist(), (self.size[left] == depth).tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found["conv_id"], pa.int64()), pa.array(depth, pa.int64()), pa.array(parent["conv_id"], pa.int64(), mask=depth == 0),
             *[pa.array(found[k], pa.int64()) for k in SUMS], pa.array(told)],
            ["conv_id", "depth", "parent_conv_id", *SUMS, "ends_sha256"])


# ---------------------------------------------------------------- all parts

def _rows(df: DataFrame, kind: int, **columns) -> DataFrame:
    """``df`` with the columns of ``ROW``, those not given null."""
    given = {"kind": F.lit(kind), **columns}
    out = []
    for field in ROW.split(", "):
        name, of = field.split(" ", 1)
        value = given.get(name, F.col(name) if name in df.columns else F.lit(None))
        out.append(value.cast(of).alias(name))
    return df.select(*out)


def trie(sequences_: DataFrame) -> DataFrame:
    """The nodes (``NODE``) of the trie of ``(conv_id, seq)``."""
    key = F.unhex(F.sha2(F.encode(F.array_join(F.transform("seq", lambda t: F.hex(t["turn"])), ""), "UTF-8"), 256))
    rows = store(sequences_.select("conv_id", "seq", key.alias("key")), "trie-rows")
    distinct = rows.groupBy("key", "seq").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"))
    distinct = store(distinct.join(ends(rows), "key").drop("key"), "trie-distinct")
    parts = max(1, min(-(-distinct.count() // PART_ROWS), MOST_PARTS))
    cut = distinct.repartitionByRange(parts, "seq").sortWithinPartitions("seq")
    cut = store(cut.select(F.spark_partition_id().cast("long").alias("part"), F.monotonically_increasing_id().alias("place"), "*"), "trie-sorted")
    borders = store(cut.groupBy("part").agg(F.min_by("seq", "place").alias("first"), F.max_by("seq", "place").alias("last")), "trie-borders")
    beside = Window.orderBy("part")  # a row for each part that holds something
    near = borders.select("part", F.lag("last").over(beside).alias("before"), F.lead("first").over(beside).alias("after"))
    near = store(near, "trie-near")
    own = _rows(cut, 0)
    for kind, name in ((-1, "before"), (1, "after")):
        own = own.unionByName(_rows(near.where(F.col(name).isNotNull()).withColumn("seq", F.col(name)), kind))
    shares = store(each_group(own, ["part"], OPEN, lambda t: Part(t).open_nodes()), "trie-open")
    merged = shares.groupBy("key").agg(F.min("conv_id").alias("low"), *[F.sum(c).alias(c) for c in SUMS])
    back = shares.select("key", "part", "side", "depth").join(merged, "key")
    return each_group(own.unionByName(_rows(back, 2)), ["part"], NODE, lambda t: Part(t).nodes())


def nodes(turns: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of ``(conv_id, turn, role, text)``."""
    return trie(rebuilt(turns.select("conv_id", "turn", "role", "text")))
