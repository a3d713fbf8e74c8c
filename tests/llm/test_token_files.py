"""Token files: the coder against the entropy of its ids, runs against the library."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from quarry.llm import token_files

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SIGNS = ["a", "B", " ", "  ", "\n", "\t", " \n", "\x1c", "\x1f", " ", "　", "é", "漢", "1", "२", "'s", "'", "!", "…", "😀",
         "<|endoftext|>", "ll", "́", "\x85", "\r\n", "word,", " word", " x."]


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(TOKENIZER)
    out.encode_special_tokens = True
    return out


def encoder(pattern=public_tokenizers.PATTERN, most=1000):
    return token_files._Encoder(Path(TOKENIZER).read_text(encoding="utf-8"), pattern, most)


def test_ids_without_order_take_little_more_than_their_entropy():
    rng = np.random.default_rng(7)
    share = 1 / np.arange(1, 2001) ** 1.3
    share /= share.sum()
    ids = rng.permutation(50_000)[:2000][rng.choice(2000, 60_000, p=share)]
    coded = token_files.encode_blocks([ids])
    assert 8 * len(coded[0]) < 1.2 * len(ids) * -(share * np.log2(share)).sum()
    assert np.array_equal(token_files.decode_blocks(coded, [len(ids)])[0], ids)


@pytest.mark.parametrize("lanes", [1, 3, 4096])
def test_streams_of_uneven_length(lanes):
    rng = np.random.default_rng(lanes)
    for n in (1, 2, 255, 256, 511, 513, 2000, 5003):
        for ids in (rng.integers(0, 1 << 17, n), rng.integers(0, 2, n), rng.zipf(1.3, n) % 50_000):
            coded = token_files.encode_blocks([ids], lanes)
            assert np.array_equal(token_files.decode_blocks(coded, [n])[0], ids)


def test_ids_out_of_range_are_refused():
    for ids in ([-1, 3], [1 << 18]):
        with pytest.raises(ValueError, match="ids must be"):
            token_files.encode_blocks([np.array(ids)])


def test_wrong_ids_are_found():
    coded = bytearray(token_files.encode_blocks([np.arange(1000)])[0])
    coded[-200] ^= 255
    with pytest.raises(ValueError, match="checksum"):
        token_files.decode_blocks([bytes(coded)], [1000])


@pytest.mark.parametrize("most", [10, 1000])
@pytest.mark.parametrize("pattern", [public_tokenizers.PATTERN, public_tokenizers.PATTERN + "|\\s"])
def test_any_white_space_equals_the_library(library, pattern, most):
    rng, of = random.Random(11), encoder(pattern, most)
    texts = [None, "", *["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 12))) for _ in range(1500)]]
    for size in (1, 7, 400):
        for i in range(0, 300 if size == 1 else len(texts), size):
            some = texts[i:i + size]
            ids, counts = of.encode(pa.array(some, pa.string()), 2)
            assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [
                [*library.encode(t or "", add_special_tokens=False).ids, 2] for t in some]


def test_the_library_gets_a_match_once():
    of, calls = encoder(), []
    merges = of.merges
    of.merges = lambda piece: calls.append(piece) or merges(piece)
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}word" for i in range(100)]
    texts = pa.array([f" {a}, {b}. {a}.\nThe {b} {a}-{b}" for a in words for b in words[:20]])
    of.encode(texts, 2)
    assert len(calls) == len(set(calls)) < 2.1 * len(words)
    of.encode(texts, 2)
    assert len(calls) < 2.1 * len(words)
