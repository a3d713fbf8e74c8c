"""The conversation trie against SQL (whole query) and a plain walk."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from conftest import SF_ORACLE

from quarry.llm import prefix_trie
from quarry.llm.queries import SQL, W

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = {}
    ends = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        seq = tuple(own.get(base, [])[:h] + ts[h:])
        ends.setdefault(seq, []).append(c)
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    out = []
    for node, cs in members.items():
        below = [x for x in members if x[:len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(kids),
                    sum(not any(y[:-1] == x for y in members if y) for x in below),
                    sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x),
                    hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, n):
    """Few different turns, so that prefixes branch, repeat and run deep."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-120, 420), n):
        for turn in range(rng.choice([0, 1, 1, 3, 8, 20])):
            rows.append((c, rng.choice([turn, None]) if turn == 0 else turn, rng.choice(["u", None, "a"]) if turn % 3 else "u",
                         rng.choice(["x", "yy", "", None, "é😀"]) if turn > 2 else "same"))
    return rows


@pytest.mark.parametrize("part_rows", [8192, 3])
def test_nodes_by_a_plain_walk(spark, monkeypatch, part_rows):
    monkeypatch.setattr(prefix_trie, "PART_ROWS", part_rows)
    monkeypatch.setattr(prefix_trie, "HASH_IDS", 2)
    rows = conversations(part_rows, 90) + [(None, 1, "u", "x")]
    rows = [r for n, r in enumerate(rows) if (r[0], r[1]) not in {(x[0], x[1]) for x in rows[:n]}]
    got = prefix_trie.nodes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_hot_conversation_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PART_ROWS", 4)
    rows = [(100 * c, t, "u", f"turn {t}") for c in range(60) for t in range(4)]
    rows += [(100 * c + 7, t, "u", "turn 0" if t == 0 else f"{c} {t}") for c in range(30) for t in range(3)]
    got = prefix_trie.nodes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_query_at_the_oracle_scale(spark):
    duckdb = pytest.importorskip("duckdb")
    from tools.oracle_check import digest
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_ORACLE}/conversations.parquet'")
    rel = con.sql(SQL["op11_prefix_trie"])
    df = W["op11_prefix_trie"](spark, SF_ORACLE)
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]


def test_odd_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.nodes(empty).collect() == []
    assert prefix_trie.nodes(spark.createDataFrame([(None, 1, "u", "x")], SCHEMA)).collect() == []
    # 1 has h = crc32("1") % 6 turns cut and no base: turnless, yet a member of the root
    h = zlib.crc32(b"1") % 6
    assert h > 0
    got = prefix_trie.nodes(spark.createDataFrame([(1, 1, "u", "x", 5, "n")], SCHEMA + ", n long, key string")).collect()
    assert [tuple(r) for r in got] == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]
    long = [(0, t, "u", "w" * 9) for t in range(3000)] + [(0, 5, "u", "w" * 9)] * 2
    nodes = prefix_trie.nodes(spark.createDataFrame(long, SCHEMA)).collect()
    assert sorted(r.depth for r in nodes) == list(range(3003))


def test_extents_and_least_values():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 33):
        lcp = rng.integers(0, 4, n)
        levels = prefix_trie.sparse(lcp)
        place, depth = np.repeat(np.arange(n), 5), np.tile(np.arange(5), n)
        left, right = prefix_trie.extents(levels, place, depth)
        for p, d, a, b in zip(place, depth, left, right):
            lo, hi = p, p
            while lo > 0 and lcp[lo] >= d:
                lo -= 1
            while hi < n - 1 and lcp[hi + 1] >= d:
                hi += 1
            assert (a, b) == (lo, hi)
        assert (prefix_trie.least(levels, left, right) == [lcp[a:b + 1].min() for a, b in zip(left, right)]).all()
