"""Token-id files with an adaptive context-mixing range coder.

Documents are encoded, an end id is appended to each, and the ids are written
in order of the document id.  A file is a sequence of segments; a segment
holds whole documents, their index, and their ids in blocks.  Every block is
coded on its own (all models start afresh) and has a checksum, so a damaged
block is found and does not touch the others.

A block is cut into streams that run in step: round t codes place t of every
stream by array operations, and all streams learn from it together.  The
order-2 model predicts the id that followed the last two ids before, the
order-1 model the id that followed the last one, each with a count of how often
it was right in a row; the order-0 model has the counts of the ids that neither
predicted.  An id is coded as "as order 2 says", "as order 1 says", by order 0,
or, if order 0 has not met it, by its number.  Frequencies of these four are
mixed from the counts of the two predictors' present confidence and those of
the whole block; the weight of either moves to the one that foretold better.
A range coder turns frequencies into 16-bit words of each stream; carries are
added when the block is done.  All of it is integer arithmetic.

Texts are cut before every blank or line end that a character follows, where no
match of the pattern goes on; the tokenizers library encodes each distinct run once per
worker: a run's matches of the pattern are given to its merges, which are what
is left to do of its work.

Files are the rows of a Parquet folder (Spark's commit protocol, any store
that Spark can write): part number, place in the part, ids before it in the
part, document ids and token counts, and the segment's bytes (layout at
``pack``).  Reading is a scan; only one number per part is summed for the
documents' starts.

Defined results: a null or empty text has the end id only; null ids come
first; repeated rows are written as often as they occur, equal ids in order of
a hash of their text; an empty table gives files without segments and an empty
result; ids must be from 0 to 2**18 - 2.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.word_bpe import SIGNS, Kept

END_ID = 2
BLOCK_IDS = SEGMENT_IDS = 1 << 20
LANES, LANE_IDS = 4096, 256  # most streams of a block; ids of a stream at least, if there are so many
BROADCAST_PARTS = 1_000_000  # 16 bytes each
MAGIC = b"QTK2"
MOST_ID = (1 << 18) - 2

LEVELS = 4  # confidence of a predictor: 0 to 3
SYMBOLS = 4  # as order 2 says, as order 1 says, by order 0, by number
HASH1, HASH2 = 16, 18  # bits of the predictors' tables
TOTAL_BITS = 16  # frequencies sum to 2**16
TOP, WORD = 46, 16
LEAST = 1 << TOP
STEP, MOST = 24, 1 << 20  # added to a count; sum at which counts are halved

STEP_BYTES = 1 << 23  # of text whose runs are looked up at once
#: Patterns no match of which goes on over a blank or line end that a character follows.
CUT_AT_BLANKS = frozenset([r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"])
CUT = re.compile(r" (?=\S)").split
#: (line end, letters, sign): matches one after another.  All from U+00C0 to U+024F but two are letters in any version of Unicode.
WORD_RUN = re.compile(r"(\n(?! )|)( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([" + re.escape("".join(sorted(SIGNS))) + r"]?)").fullmatch


class _Model:
    """Predictors and counts of a block, shared by its streams."""

    def __init__(self, top: int):
        self.next1, self.next2 = np.zeros(1 << HASH1, np.int32), np.zeros(1 << HASH2, np.int32)  # id * LEVELS + confidence
        self.by_trust, self.block = np.ones((LEVELS * LEVELS, SYMBOLS), np.int64), np.ones(SYMBOLS, np.int64)
        self.weight = np.full((LEVELS * LEVELS, 1), 8, np.int64)  # sixteenths of by_trust
        self.tally = np.zeros(LEVELS * LEVELS * SYMBOLS, np.int64)
        self.bits = max(1, top.bit_length())
        self.shifts = np.array([0, 0, TOTAL_BITS, self.bits])
        self.counts, self.counted = np.zeros(top + 1, np.int64), 0
        self.mix()
        self.rank()

    def _shares(self) -> tuple[np.ndarray, np.ndarray]:
        return (self.by_trust << TOTAL_BITS) // self.by_trust.sum(1, keepdims=True), (self.block << TOTAL_BITS) // self.block.sum()

    def mix(self) -> None:
        """Frequencies of the four symbols, after what was met since the last mix."""
        each, whole = self._shares()
        tally = self.tally.reshape(-1, SYMBOLS)
        if tally.any():
            self.weight = np.clip(self.weight + np.sign((tally * (each - whole)).sum(1, keepdims=True)), 1, 15)
            self.by_trust += tally * STEP
            self.block += tally.sum(0) * STEP
            while (full := self.by_trust.sum(1) > MOST).any():
                self.by_trust[full] = (self.by_trust[full] + 1) >> 1
            while self.block.sum() > MOST:
                self.block = (self.block + 1) >> 1
            each, whole = self._shares()
            self.tally[:] = 0
        mixed = each * self.weight + whole * (16 - self.weight)
        width = (mixed * ((1 << TOTAL_BITS) - SYMBOLS) >> (TOTAL_BITS + 4)) + 1
        width[:, 2] += (1 << TOTAL_BITS) - width.sum(1)
        ends = np.cumsum(width, axis=1)
        self.width, self.start = width.ravel(), (ends - width).ravel()
        self.ends = [np.ascontiguousarray(ends[:, i]) for i in range(SYMBOLS - 1)]

    def rank(self) -> None:
        """Order 0: places of the ids that were met; the others are coded by number."""
        total = int(self.counts.sum())
        width = (self.counts << TOTAL_BITS) // max(total, 1)
        if total:
            width[np.argmax(width)] += (1 << TOTAL_BITS) - int(width.sum())
        known = width > 0
        self.new = (~known).astype(np.int64)
        self.id_start = np.where(known, np.cumsum(width) - width, np.arange(len(width)))
        self.id_width = np.where(known, width, 1)
        self.id_shift = np.where(known, TOTAL_BITS, self.bits)
        self.slot = np.repeat(np.arange(len(width)), width) if total else np.zeros(1 << TOTAL_BITS, np.int64)

    def learn(self, t: int, ids: np.ndarray, literal: np.ndarray, x, cell, h1, h2, e1, e2, right1, right2) -> None:
        """After round t (from 1).  Where streams meet in a table's place, numpy
        keeps one of them, in coding as in decoding; a block's checksum of its
        ids would tell if not."""
        fresh = x * LEVELS
        self.next1[h1] = np.where(right1, e1 + ((e1 & 3) < 3), fresh)
        self.next2[h2] = np.where(right2, e2 + ((e2 & 3) < 3), fresh)
        self.tally += np.bincount(cell, minlength=len(self.tally))
        if t < 16 or t % 4 == 0:
            self.mix()
        if t & (t - 1) == 0 or t % 64 == 0:
            self.counts += np.bincount(ids[self.counted:t][literal[self.counted:t]], minlength=len(self.counts))
            self.counted = t
            self.rank()


def _hash1(b: np.ndarray) -> np.ndarray:
    return ((b * 2654435761) >> 9) & ((1 << HASH1) - 1)


def _hash2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a * 40503 + b * 2654435761) >> 7) & ((1 << HASH2) - 1)


def encode_block(block: np.ndarray, lanes: int = LANES) -> bytes:
    """Rounds, largest id and CRC-32 of the ids (unsigned little-endian 32-bit
    each), number of words of each stream (the same), then the streams' words.
    Stream k holds ids k * rounds and those after it."""
    n = len(block)
    if not n:
        return b""
    block = np.asarray(block, np.int64)
    top = int(block.max())
    if int(block.min()) < 0 or top > MOST_ID:
        raise ValueError(f"ids must be from 0 to {MOST_ID}")
    rounds = -(-n // max(1, min(lanes, n // LANE_IDS)))
    streams = -(-n // rounds)
    last = n - (streams - 1) * rounds  # ids of the last stream
    ids = np.zeros(streams * rounds, np.int64)
    ids[:n] = block
    ids = np.ascontiguousarray(ids.reshape(streams, rounds).T)
    before, before2 = np.zeros_like(ids), np.zeros_like(ids)
    before[1:], before2[2:] = ids[:-1], ids[:-2]
    hashes1, hashes2 = _hash1(before), _hash2(before2, before)
    model, literal = _Model(top), np.zeros(ids.shape, bool)
    stride = 3 * rounds + 8
    out, base = np.zeros(streams * stride, np.int32), np.arange(streams) * stride
    at, low, span = base.copy(), np.zeros(streams, np.int64), np.full(streams, 1 << (TOP + WORD), np.int64)
    for t in range(rounds):
        m = streams if t < last else streams - 1
        x, h1, h2, lo, sp, p = ids[t, :m], hashes1[t, :m], hashes2[t, :m], low[:m], span[:m], at[:m]
        e1, e2 = model.next1[h1], model.next2[h2]
        right1, right2 = (e1 >> 2) == x, (e2 >> 2) == x
        plain = ~(right1 | right2)
        symbols = np.where(right2, 0, np.where(right1, 1, model.new[x] + 2))
        cell = ((e2 & 3) * LEVELS + (e1 & 3)) * SYMBOLS + symbols
        r = sp >> TOTAL_BITS
        lo += model.start[cell] * r
        r *= model.width[cell]
        r >>= model.id_shift[x] * plain
        lo += model.id_start[x] * plain * r
        np.multiply(np.where(plain, model.id_width[x], 1), r, out=sp)
        literal[t, :m] = plain
        small = sp < LEAST
        out[p] = lo >> TOP  # stays if the stream moves on, else the next word takes its place
        p += small
        lo[:] = np.where(small, (lo & (LEAST - 1)) << WORD, lo)
        sp <<= small * WORD
        more = np.flatnonzero(sp < LEAST)
        while len(more):
            rest = lo[more]
            out[p[more]] = rest >> TOP
            p[more] += 1
            lo[more] = (rest & (LEAST - 1)) << WORD
            sp[more] <<= WORD
            more = more[sp[more] < LEAST]
        model.learn(t + 1, ids, literal, x, cell, h1, h2, e1, e2, right1, right2)
    low += 1 << 30  # whatever bits follow the two words, the value stays in the interval
    for _ in range(2):
        out[at] = low >> TOP
        at += 1
        low = (low & (LEAST - 1)) << WORD
    size = at - base
    words = out.reshape(streams, stride)[np.arange(stride) < size[:, None]]
    carry = np.flatnonzero(words >> WORD)
    while len(carry):  # never out of a stream, whose value is below 1
        over = words[carry] >> WORD
        words[carry] &= (1 << WORD) - 1
        carry -= 1
        words[carry] += over
        carry = carry[words[carry] >> WORD > 0]
    return struct.pack("<III", rounds, top, zlib.crc32(block.astype("<u4").tobytes())) + size.astype("<u4").tobytes() + words.astype("<u2").tobytes()


def decode_block(coded: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, np.int64)
    rounds, top, crc = struct.unpack_from("<III", coded)
    streams = -(-n // rounds)
    last = n - (streams - 1) * rounds
    size = np.frombuffer(coded, "<u4", streams, 12).astype(np.int64)
    words = np.concatenate([np.frombuffer(coded, "<u2", -1, 12 + 4 * streams).astype(np.int64), np.zeros(8, np.int64)])
    at, end = np.cumsum(size) - size, len(words) - 1
    code = words[at] << 46 | words[at + 1] << 30 | words[at + 2] << 14 | words[at + 3] >> 2
    words[:-1] = (words[:-1] & 3) << 14 | words[1:] >> 2  # those 62 bits end within a word
    at += 3
    span, ids = np.full(streams, 1 << (TOP + WORD), np.int64), np.zeros((rounds, streams), np.int64)
    model, literal = _Model(top), np.zeros(ids.shape, bool)
    a, b = np.zeros(streams, np.int64), np.zeros(streams, np.int64)
    for t in range(rounds):
        m = streams if t < last else streams - 1
        co, sp, p, h1, h2 = code[:m], span[:m], at[:m], _hash1(b[:m]), _hash2(a[:m], b[:m])
        e1, e2 = model.next1[h1], model.next2[h2]
        context = (e2 & 3) * LEVELS + (e1 & 3)
        r = sp >> TOTAL_BITS
        value = co // r
        not2, plain, by_number = [value >= ends[context] for ends in model.ends]
        symbols = not2.view(np.int8) + plain.view(np.int8) + by_number
        cell = context * SYMBOLS + symbols
        co -= model.start[cell] * r
        r *= model.width[cell]
        r >>= model.shifts[symbols]
        value = co // r
        x = np.where(by_number, np.minimum(value, top), model.slot[value & ((1 << TOTAL_BITS) - 1)])
        x = np.where(plain, x, np.where(not2, e1, e2) >> 2)
        co -= model.id_start[x] * plain * r
        np.multiply(np.where(plain, model.id_width[x], 1), r, out=sp)
        ids[t, :m], literal[t, :m] = x, plain
        small = sp < LEAST
        co[:] = np.where(small, co << WORD | words[p], co)
        p += small
        sp <<= small * WORD
        more = np.flatnonzero(sp < LEAST)
        while len(more):
            co[more] = co[more] << WORD | words[p[more]]
            p[more] += 1
            sp[more] <<= WORD
            more = more[sp[more] < LEAST]
        np.minimum(p, end, out=p)
        model.learn(t + 1, ids, literal, x, cell, h1, h2, e1, e2, (e1 >> 2) == x, (e2 >> 2) == x)
        a, b = b, ids[t]
    out = np.ascontiguousarray(ids.T).ravel()[:n]
    if zlib.crc32(out.astype("<u4").tobytes()) != crc:
        raise ValueError("the ids of a block do not fit their checksum")
    return out


def encode_blocks(blocks: list[np.ndarray], lanes: int = LANES) -> list[bytes]:
    """Code every block (int array) on its own, in up to ``lanes`` streams."""
    return [encode_block(b, lanes) for b in blocks]


def decode_blocks(coded: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The ids of blocks made by ``encode_blocks``."""
    return [decode_block(c, n) for c, n in zip(coded, lengths)]


def pack(lengths: list[int], coded: list[bytes]) -> bytes:
    """Segment: magic, number of blocks, then per block the number of ids, of
    bytes and the CRC-32 of the bytes (unsigned little-endian 32-bit), then
    the blocks' bytes."""
    head = [MAGIC, struct.pack("<I", len(coded))]
    head += [struct.pack("<III", n, len(c), zlib.crc32(c)) for n, c in zip(lengths, coded)]
    return b"".join(head + coded)


def unpack(segment: bytes) -> tuple[list[int], list[bytes]]:
    if segment[:4] != MAGIC:
        raise ValueError("not a token segment")
    count = struct.unpack_from("<I", segment, 4)[0]
    heads = [struct.unpack_from("<III", segment, 8 + 12 * i) for i in range(count)]
    lengths, coded, at = [], [], 8 + 12 * count
    for i, (n, size, crc) in enumerate(heads):
        part = segment[at:at + size]
        if len(part) != size or zlib.crc32(part) != crc:
            raise ValueError(f"block {i} of a token segment is damaged")
        lengths.append(n)
        coded.append(part)
        at += size
    return lengths, coded


def split_blocks(ids: np.ndarray, block_ids: int) -> list[np.ndarray]:
    return [ids[i:i + block_ids] for i in range(0, len(ids), block_ids)]


def _byte_signs() -> dict[int, str]:
    """Byte -> its sign in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class _Encoder:
    """Ids of texts by the tokenizers library, looked up by run.  ``cuts``: the
    pattern lets texts be cut at blanks and line ends; else runs are the pattern's matches."""

    def __init__(self, definition: str, pattern: str, most: int):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer, self.kept, self.kept_runs = Tokenizer.from_str(definition), Kept(most), Kept(most)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.cuts, self.split = pattern in CUT_AT_BLANKS, regex.compile(pattern).findall
        spec = json.loads(definition)
        before = spec.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        #: A match of the file's own pattern needs the library's merges only.
        self.merges = self.tokenizer.model.tokenize if self.cuts and plain and not spec.get("normalizer") else None
        self.byte_signs = _byte_signs()
        self.signs, self.line_ends = {"": b""} | dict(self.learn(list(SIGNS))), {"": b""} | dict(self.learn(["\n"]))

    def learn(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        for p in pieces:
            if self.merges:
                tokens = self.merges("\u0120" + p[1:] if p[0] == " " and p[1:].isalpha() and p.isascii() else
                                     p.encode().decode("latin-1").translate(self.byte_signs))
                ids = [t.id for t in tokens]
            else:
                ids = self.tokenizer.encode(p, add_special_tokens=False).ids
            yield p, struct.pack(f"<{len(ids)}I", *ids)

    def learn_runs(self, runs: list[str]) -> Iterator[tuple[str, bytes]]:
        split = [self.split(r) for r in runs] if self.cuts else [[r] for r in runs]
        distinct = {p for s in split for p in s}
        of = self.kept.fill(distinct, self.learn)
        for r, s in zip(runs, split):
            yield r, b"".join([of[p] for p in s])
        self.kept.forget_long(distinct)

    def look_up(self, runs: list[str]) -> list[bytes]:
        """Ids of runs; letters, after a line end or none, alone or before one
        sign, are matches as they are."""
        parts, words, others, match = [], set(), set(), WORD_RUN if self.cuts else lambda r: None
        for r in runs:
            if found := match(r):
                part = found.groups()
                words.add(part[1])
            else:
                part = None, r, ""
                others.add(r)
            parts.append(part)
        others.discard("")
        end_ids, signs = self.line_ends, self.signs
        of_run = self.kept_runs.fill(others, self.learn_runs)
        of = self.kept.fill(words, self.learn)
        out = [(of_run[r] if r else b"") if end is None else end_ids[end] + of[r] + signs[sign] if end or sign else of[r] for end, r, sign in parts]
        self.kept.forget_long(words)
        self.kept_runs.forget_long(others)
        return out

    def runs(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(distinct runs, numbers of each text's runs one after another, where each text's begin)."""
        if self.cuts:
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
            found, at = lists.flatten().dictionary_encode(), lists.offsets.to_numpy()
            at, number, runs = at - at[0], found.indices.to_numpy(), found.dictionary.to_pylist()
            astray = np.array([not r or r[0].isspace() and (r[0] != "\n" or r[1:2].isspace() or len(r) == 1) for r in runs])
            inner = astray[number]
            inner[at[:-1]] = False
            if inner.any():  # blanks or line ends that white space follows, or a line end after a blank
                rows = [CUT(t) for t in texts.to_pylist()]
        else:
            rows = [self.split(t) for t in texts.to_pylist()]
        if not self.cuts or inner.any():
            at = np.cumsum([0, *map(len, rows)])
            found = pa.array(chain.from_iterable(rows), pa.string()).dictionary_encode()
            number, runs = found.indices.to_numpy(), found.dictionary.to_pylist()
        if not self.cuts:
            return runs, number, at
        first, where = np.unique(number[at[:-1]], return_inverse=True)
        number = number.copy()
        number[at[:-1]] = len(runs) + where  # a text's first run has no blank before it
        return [r if r[:1] == "\n" else " " + r for r in runs] + [runs[i] for i in first.tolist()], number, at

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id; number of ids of each text)."""
        runs, number, at = self.runs(texts.fill_null(""))
        values = self.look_up(runs)
        values.append(np.array([end_id], dtype="<u4").tobytes())
        pool = np.frombuffer(b"".join(values), dtype="<u4")
        size = np.fromiter(map(len, values), np.int64, len(values)) // 4
        number = np.insert(number, at[1:], len(values) - 1)
        sizes = size[number]
        ends = np.cumsum(sizes)
        place = np.repeat(((np.cumsum(size) - size)[number] - (ends - sizes)).astype(np.int32), sizes)
        place += np.arange(len(place), dtype=np.int32)
        return pool[place], np.diff(ends[at[1:] + np.arange(len(texts))], prepend=0)


_WORKER: dict[tuple, _Encoder] = {}


def write(df: DataFrame, path: str, tokenizer: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
          end_id: int = END_ID, block_ids: int = BLOCK_IDS, lanes: int = LANES, segment_ids: int = SEGMENT_IDS,
          cache_pieces: int = 250_000) -> None:
    """Write the ids of all texts as token files under ``path``.

    ``tokenizer`` is a tokenizer file; ``pattern`` is its splitting pattern;
    about ``cache_pieces`` matches, and as many runs, are kept in each of two
    generations."""
    shared = df.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (tokenizer, pattern, cache_pieces)
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = _Encoder(shared.value, pattern, cache_pieces)
        part, before, place = TaskContext.get().partitionId(), 0, 0
        docs, counts, held, n_held = [], [], [], 0  # document ids, token counts, ids

        def flush() -> pa.RecordBatch:
            nonlocal before, place, docs, counts, held, n_held
            blocks = split_blocks(np.concatenate(held), block_ids)
            packed = pack([len(b) for b in blocks], encode_blocks(blocks, lanes))
            batch = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([place], pa.int64()), pa.array([before], pa.int64()),
                pa.array([docs], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())), pa.array([packed], pa.binary())],
                ["part", "place", "first", "doc_ids", "n_tokens", "segment"])
            before += n_held
            place += 1
            docs, counts, held, n_held = [], [], [], 0
            return batch

        for batch in batches:
            bytes_before = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            stop = 0
            while stop < len(batch):
                start = stop
                most = STEP_BYTES + (bytes_before[start - 1] if start else 0)
                stop = max(start + 1, int(np.searchsorted(bytes_before, most, "right")))
                ids, n = _WORKER[key].encode(batch.column(1).slice(start, stop - start), end_id)
                names, ends = batch.column(0).slice(start, stop - start).to_pylist(), np.cumsum(n)
                i = done = 0
                while i < len(n):  # a segment ends with the document that fills it
                    j = min(len(n), int(np.searchsorted(ends, done + segment_ids - n_held)) + 1)
                    docs += names[i:j]
                    counts += n[i:j].tolist()
                    held.append(ids[done:ends[j - 1]])
                    n_held += len(held[-1])
                    i, done = j, int(ends[j - 1])
                    if n_held >= segment_ids:
                        yield flush()
        if docs:
            yield flush()

    schema = "part int, place bigint, first bigint, doc_ids array<bigint>, n_tokens array<bigint>, segment binary"
    ordered.mapInArrow(run, schema).write.parquet(path)


def read(spark: SparkSession, path: str, lanes: int = LANES) -> DataFrame:
    """One row per document of token files: doc_id, start (ids of all
    documents before it), n_tokens and ids (binary: unsigned little-endian
    32-bit).  ``lanes`` may be given as to ``write``; a block tells its own."""
    files = spark.read.parquet(path)
    parts = files.groupBy("part").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    if parts.count() <= BROADCAST_PARTS:  # else the ids themselves are dealt out by part
        starts = F.broadcast(starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*[batch.column(c) for c in ("part", "first", "doc_ids", "n_tokens", "segment")]):
                part, first, docs, counts, segment = [x.as_py() for x in row]
                lengths, coded = unpack(segment)
                ids = np.concatenate(decode_blocks(coded, lengths)).astype("<u4")
                ends = np.cumsum([0, *counts])
                if ends[-1] != len(ids):
                    raise ValueError("a segment's index does not fit its ids")
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(docs), pa.int32()), pa.array(docs, pa.int64()), pa.array(first + ends[:-1], pa.int64()),
                    pa.array(counts, pa.int64()), pa.array([ids[i:j].tobytes() for i, j in zip(ends, ends[1:])], pa.binary())],
                    ["part", "doc_id", "at", "n_tokens", "ids"])

    docs = files.select("part", "first", "doc_ids", "n_tokens", "segment").mapInArrow(
        run, "part int, doc_id bigint, at bigint, n_tokens bigint, ids binary")
    return docs.join(starts, "part").select("doc_id", (F.col("__base") + F.col("at")).alias("start"), "n_tokens", "ids")
