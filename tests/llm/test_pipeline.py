"""The pipeline, stage by stage, against plain Python on its own input."""

import hashlib
import re

import pytest
import tiktoken
from conftest import SF_SMALL
from test_llm_results import near_by_brute_force, targets_by_hand

import corpus_pipeline
import public_tokenizers
from quarry.llm import bpe
from quarry.llm.textstats import STOP_WORDS
from quarry.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, docs, SF_SMALL).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return {k: v.collect() for k, v in out.items()}


def good(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, lines = {}, [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {i + k for v in seen.values() if len(v) > 1 for i in v for k in range(8)}
    if len(w) < 20 or 100 * len(covered) > 30 * len(w):
        return False
    stop = {v for x in STOP_WORDS for v in (x, x.capitalize(), x.upper())}
    chars = sum(map(len, w))
    return (2 <= chars / len(w) <= 12 and len(re.findall(r"[#*$%&|<>]", text)) <= 0.1 * len(w) and sum(x in stop for x in w) >= 0.03 * len(w)
            and sum(c.isupper() for c in text) <= 0.5 * chars and sum(a == b for a, b in zip(w, w[1:])) <= 0.3 * len(w)
            and len(lines) - len(set(lines)) <= 0.5 * len(lines))


def test_stages_are_the_dealt_ones(tables):
    assert list(tables)[1:] == ["quality_rules", "near_duplicates", "secret_scan", "mix_sources", "bpe"]


def test_quality_stage(tables):
    assert sorted(tables["quality_rules"]) == sorted(r for r in tables["documents"] if good(r.text))


def test_near_duplicate_stage(tables):
    rows = tables["quality_rules"]
    component = near_by_brute_force([(r.doc_id, r.text) for r in rows], 5, 80)
    assert sorted(tables["near_duplicates"]) == sorted(r for r in rows if component[r.doc_id][1] == r.doc_id)
    assert len(tables["near_duplicates"]) < len(rows)


def test_secret_stage(tables):
    after = {r.doc_id: r for r in tables["secret_scan"]}
    assert len(after) == len(tables["near_duplicates"])
    for r in tables["near_duplicates"]:
        clean = re.sub('(?<=token = ")[0-9a-f]{40}', "[SECRET]", r.text)
        assert after[r.doc_id].text == clean and after[r.doc_id].n_chars == len(clean)


def test_mixing_stage(tables):
    before = {r.doc_id: r for r in tables["secret_scan"]}
    sizes, taken, of_doc = {}, {}, {}
    for r in before.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    for r in tables["mix_sources"]:
        words, whole = r.text.split(), before[r.doc_id].text.split()
        taken[r.source] = taken.get(r.source, 0) + len(words)
        of_doc.setdefault(r.doc_id, []).append(len(words))
        assert r.text == before[r.doc_id].text or len(words) < len(whole)
        place = iter(whole)
        assert all(w in place for w in words)  # its own words, in order
    assert all(len(v) <= 2 for v in of_doc.values())
    for s, target in targets_by_hand(sizes).items():
        assert abs(taken[s] - target) <= 64


def test_token_stage(tables):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    expected = []
    for r in tables["mix_sources"]:
        ids = library.encode_ordinary(r.text)
        expected.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    assert sorted(tuple(r) for r in tables["bpe"]) == sorted(expected)


def test_run_gives_the_last_stage(spark, tables):
    assert sorted(map(str, corpus_pipeline.run(spark, SF_SMALL).collect())) == sorted(map(str, tables["bpe"]))
