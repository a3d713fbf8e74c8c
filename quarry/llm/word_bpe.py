"""BPE with word ends: encoding and decoding.

A word is cut into parts, whose boundaries are held with a contiguous array of
the merge ranks of neighbouring parts.  The array is scanned for its minimum,
the boundary between that pair is deleted, and the ranks of the two pairs
beside it are looked up again, until no pair has a rank.  The arrays of many
words lie one below another as rows of a matrix, and each step serves all of
them.  Scanning is quadratic in the length of a word, so it is used up to
``SHORT`` parts; in longer words (rows of signs, scripts without blanks) parts
are linked and waiting pairs lie in a heap, which gives the same merges in
O(n log n).

The library's own normalizer and splitter prepare a text, so case folding,
character classes and Unicode versions are theirs (runs of printable ASCII, for
which these are plain, need no call).  They never join across white space, so
they run once for each distinct run of other characters.  A worker keeps the
ids of runs and of words it has met, in caches of bounded size.  Special tokens
are found in the text as it is and stay whole, as the library does by default.

Scale: one scan without a shuffle; a task holds one Arrow batch, its caches and
the runs of about two megabytes of text.

Defined results: a null or empty text, and one of white space, has no ids and
decodes to the empty text; null ids in a list decode to nothing; null keys,
repeated rows and empty tables pass through row by row; input columns ``ids``
and ``decoded`` are replaced, others are carried along.
"""

from __future__ import annotations

import heapq
import json
import re
import string
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORT = 64
CACHE = 150_000
#: Words and runs longer than this many characters are not kept.
KEPT_LENGTH = 48
#: Characters of text whose runs are held at once, and words merged at once.
STEP_CHARS, STEP_WORDS = 1 << 21, 2048
NO_RANK = 1 << 30
PRINTABLE = re.compile(r"[!-~]+").fullmatch
#: Matches of the file's splitter in printable ASCII in lower case; a line end
#: parts runs.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|\n|[^a-z0-9\n]+").findall
#: Characters that Python's split takes for white space and the file does not.
SEPARATORS = re.compile("[\x1c-\x1f]").search
#: ASCII characters that the splitter parts from letters before them, each a match of its own at the end of a run.
SIGNS = frozenset(map(chr, range(33, 127))) - frozenset(string.ascii_letters)
BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class Vocabulary:
    """What the merges need of a tokenizer file.  A merge's number is its rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ids, self.end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.of_id = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.rank = {pair: n for n, pair in enumerate(merges)}
        self.merged = np.array([self.ids[a + b] for a, b in merges], np.int32)
        self.base = max(self.ids.values()) + 2
        keys = np.array([self.ids[a] * self.base + self.ids[b] for a, b in merges], np.int64)
        self.number = np.argsort(keys).astype(np.int32)
        self.keys = keys[self.number]
        signs = [t for t in self.ids if len(t) == 1]
        self.inner = np.full(max(map(ord, signs)) + 1, -1, np.int32)
        self.last = self.inner.copy()
        for t in signs:
            self.inner[ord(t)], self.last[ord(t)] = self.ids[t], self.ids[t + self.end]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; a place without a part has id -1."""
        key = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (right >= 0), self.number[at], NO_RANK)

    def merge(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words as little-endian int32 bytes."""
        out, short = {}, []
        for w in words:
            if len(w) <= SHORT:
                short.append(w)
            else:
                out[w] = np.array([self.ids[p] for p in linked(w + self.end, len(w), self.rank)], "<i4").tobytes()
        short.sort(key=len)
        for s in range(0, len(short), STEP_WORDS):
            part = short[s:s + STEP_WORDS]
            out.update(zip(part, self.scanned(part)))
        return out

    def scanned(self, words: list[str]) -> list[bytes]:
        """Row r of ``ids`` holds the parts of a word and of ``ranks`` those of
        its neighbouring pairs; a step merges the first pair of least rank of
        each row, and rows without one leave."""
        size = np.array([len(w) for w in words])
        code = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        ids = np.full((len(words), size.max()), -1, np.int32)
        ids[np.arange(size.max()) < size[:, None]] = self.inner[code]
        ids[np.arange(len(words)), size - 1] = self.last[code[np.cumsum(size) - 1]]
        ranks = np.full(ids.shape, NO_RANK, np.int32)
        ranks[:, :-1] = self.ranks(ids[:, :-1], ids[:, 1:])
        row, out = np.arange(len(words)), [b""] * len(words)
        while len(row):
            at = ranks.argmin(1)
            least = ranks[np.arange(len(row)), at]
            done = least == NO_RANK
            for r, n, line in zip(row[done].tolist(), (ids[done] >= 0).sum(1).tolist(), ids[done]):
                out[r] = line[:n].tobytes()
            if done.all():
                break
            left = ~done
            ids, ranks, row, at = ids[left], ranks[left], row[left], at[left]
            lines, cols = np.arange(len(row)), np.arange(ids.shape[1] - 1)
            ids[lines, at] = self.merged[least[left]]
            after = cols + (cols > at[:, None])
            ids = np.take_along_axis(ids, after, 1)
            ranks = np.take_along_axis(ranks, after + (cols == at[:, None]), 1)
            wide = ids.shape[1]
            right = np.where(at + 1 < wide, ids[lines, np.minimum(at + 1, wide - 1)], -1)
            ranks[lines, at] = self.ranks(ids[lines, at], right)
            some = np.flatnonzero(at)
            ranks[some, at[some] - 1] = self.ranks(ids[some, at[some] - 1], ids[some, at[some]])
        return out


def linked(word: str, n: int, rank: dict) -> list[str]:
    """The same merges for a long word: each part knows its end and the part
    before it; a pair in the heap counts only while both its parts are as they
    were."""
    end, before = [*range(1, n), len(word)], [*range(-1, n - 1)]
    heap = []

    def wait(i: int) -> None:
        stop = end[i]
        if stop < len(word) and (r := rank.get((word[i:stop], word[stop:end[stop]]))) is not None:
            heap.append((r, i, stop, end[stop]))

    for i in range(n - 1):
        wait(i)
    heapq.heapify(heap)
    gone = bytearray(n)
    while heap:
        _, i, cut, stop = heapq.heappop(heap)
        if gone[i] or end[i] != cut or end[cut] != stop:
            continue
        gone[cut], end[i] = 1, stop
        if stop < len(word):
            before[stop] = i
        for at in (i, before[i]):
            if at >= 0:
                size = len(heap)
                wait(at)
                if len(heap) > size:
                    heapq.heappush(heap, heap.pop())
    return [word[i:end[i]] for i in range(n) if not gone[i]]


class Kept:
    """Bytes by key in two generations of about ``most`` each: when the
    younger is full, the older goes.  That changes no result."""

    def __init__(self, most: int):
        self.most, self.now, self.older = most, {}, {}

    def fill(self, keys: set[str], make) -> dict[str, bytes]:
        """Answers for at least ``keys``; ``make`` finds those not kept."""
        if len(self.now) > self.most:
            self.now, self.older = {}, {k: v for k, v in self.now.items() if len(k) <= KEPT_LENGTH}
        missing = keys - self.now.keys()
        known = missing & self.older.keys()
        self.now.update((k, self.older[k]) for k in known)
        if missing := missing - known:
            self.now.update(make(list(missing)))
        return self.now

    def forget_long(self, keys: set[str]) -> None:
        for k in [k for k in keys if len(k) > KEPT_LENGTH]:
            self.now.pop(k, None)


class Encoder:
    """Ids of texts as little-endian int32 bytes."""

    def __init__(self, path: str, most: int):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.vocabulary = vocabulary(path)
        self.normal = library.normalizer.normalize_str
        self.split = library.pre_tokenizer.pre_tokenize_str
        names = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.words, self.runs = Kept(most), Kept(most)

    def words_of(self, runs: list[str]) -> list[list[str]]:
        """The words of each run, as the file normalizes and splits it."""
        plain, other = [], []
        out: list[list[str]] = [[]] * len(runs)
        for n, r in enumerate(runs):
            if not r.isascii():
                other.append(n)
            elif r.isalpha():  # letters only: one word
                out[n] = [r.lower()]
            elif r[:-1].isalpha() and r[-1] in SIGNS:  # letters and one sign
                out[n] = [r[:-1].lower(), r[-1]]
            else:
                (plain if PRINTABLE(r) else other).append(n)
                out[n] = []
        for n in other:
            out[n] = []
        at = iter(plain)
        to = out[next(at)] if plain else None
        for w in ASCII_WORDS("\n".join([runs[n] for n in plain]).lower()):
            if w == "\n":
                to = out[next(at)]
            else:
                to.append(w)
        text = self.normal("\n".join([runs[n] for n in other]))  # line ends become blanks
        ends = np.cumsum([len(x) + 1 for x in text.split(" ")])
        found = self.split(text) if other else []
        for (w, _), place in zip(found, np.searchsorted(ends, [a for _, (a, _) in found], "right").tolist()):
            out[other[place]].append(w)
        return out

    def learn(self, runs: list[str]) -> Iterator[tuple[str, bytes]]:
        split = self.words_of(runs)
        distinct = {w for ws in split for w in ws}
        of = self.words.fill(distinct, self.vocabulary.merge)
        for r, ws in zip(runs, split):
            yield r, of[ws[0]] if len(ws) == 1 else b"".join([of[w] for w in ws])
        self.words.forget_long(distinct)

    def pieces(self, text: str) -> Iterator[tuple[list[str], bytes]]:
        """(runs, ids): runs of a part of the text, or the id of a special token."""
        for n, plain in enumerate(self.special.split(text) if self.special else [text]):
            if n % 2:
                yield [], np.array([self.vocabulary.special[plain]], "<i4").tobytes()
                continue
            start = 0
            while start < len(plain):
                cut = BLANK.search(plain, start + STEP_CHARS)
                part = plain[start:cut.start()] if cut else plain[start:]
                start += len(part) + bool(cut)
                yield ([x for x in BLANK.split(part) if x] if SEPARATORS(part) else part.split()), b""

    def encode_all(self, texts: Iterable[str | None]) -> list[bytes]:
        out: list[list[bytes]] = []
        waiting, chars = [], 0

        def flush():
            distinct = set().union(*[r for _, r, _ in waiting])
            of = self.runs.fill(distinct, self.learn)
            for n, runs, ids in waiting:
                out[n].append(ids or b"".join(map(of.__getitem__, runs)))
            self.runs.forget_long(distinct)
            waiting.clear()
        for n, t in enumerate(texts):
            out.append([])
            for runs, ids in self.pieces(t or ""):
                waiting.append((n, runs, ids))
                chars += sum(map(len, runs))
                if chars >= STEP_CHARS:
                    flush()
                    chars = 0
        flush()
        return [b"".join(x) for x in out]


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=1)
def encoder(path: str, most: int) -> Encoder:
    """The encoder of this Python worker; tasks that follow reuse it."""
    return Encoder(path, most)


def spelled(ids: Iterable[int | None], of_id: dict[int, str]) -> str:
    """The tokens of ids, special ones included, one blank between them, as the
    library's decode gives without a decoder in the file; ids that the file has
    not, and nulls, are left out."""
    return " ".join([t for t in map(of_id.get, ids) if t is not None])


def encode(df: DataFrame, path: str, text_col: str = "text", cache: int = CACHE) -> DataFrame:
    """``df`` with ``ids`` (array<int>): the ids of the whole text.  The file at
    ``path`` is read where tasks run."""
    @F.arrow_udf("array<int>")
    def ids_of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = encoder(path, cache)
        for batch in texts:
            rows = of.encode_all(map(pa.StringScalar.as_py, batch))
            ends = np.cumsum([0] + [len(r) // 4 for r in rows], dtype=np.int64)
            yield pa.LargeListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(rows), dtype="<i4"))).cast(pa.list_(pa.int32()))
    return df.withColumn("ids", ids_of(F.col(f"`{text_col}`")))


def decode(ids: Column, path: str) -> Column:
    """string: the text that ids stand for (see ``spelled``)."""
    @F.arrow_udf("string")
    def text_of(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in lists:
            yield pa.array([spelled(row.as_py() or [], vocabulary(path).of_id) for row in batch], pa.string())
    return text_of(ids)


def round_trip(df: DataFrame, path: str, text_col: str = "text", cache: int = CACHE) -> DataFrame:
    """``df`` with ``ids`` (binary: the ids as little-endian unsigned 32-bit
    integers) and ``decoded`` (string: the text that these ids stand for), in
    one Python stage with one vocabulary a worker."""
    @F.arrow_udf("struct<ids:binary,decoded:string>")
    def both(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = encoder(path, cache)
        for batch in texts:
            rows = of.encode_all(map(pa.StringScalar.as_py, batch))
            back = [spelled(np.frombuffer(r, "<u4").tolist(), of.vocabulary.of_id) for r in rows]
            yield pa.StructArray.from_arrays([pa.array(rows, pa.binary()), pa.array(back, pa.string())], ["ids", "decoded"])
    out = df.withColumn("ids", both(F.col(f"`{text_col}`")))
    return out.withColumn("decoded", F.col("ids.decoded")).withColumn("ids", F.col("ids.ids"))
