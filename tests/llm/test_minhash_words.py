"""Words that defeat sums of powers, words of over 1,000 bytes, confirmed shingles."""

import random

import pytest

from quarry.llm import minhash


def thue_morse(n, flip):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


@pytest.mark.parametrize("size", [1024, 2048])
def test_complementary_words_are_not_linked(spark, size):
    one, two = thue_morse(size, 0), thue_morse(size, 1)
    rows = [(1, one), (2, two), (3, f"some words before {one}"), (4, f"some words before {two}"), (5, one.upper())]
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85).collect()}
    assert out == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}
    kept = minhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 3, 4]


def test_long_words_by_brute_force(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("ab") for _ in range(rng.choice([3, 1200, 2500]))) for _ in range(30)]
    rows = []
    for i in range(12):
        ws = [rng.choice(words) for _ in range(60)]
        rows.append((3 * i, " ".join(ws)))
        ws[5] = rng.choice(words)
        rows.append((3 * i + 1, "\n".join(ws)))
        rows.append((3 * i + 2, " ".join(ws[:40])))

    def shingles(t):
        w = t.split()
        return {tuple(w[j:j + 3]) for j in range(len(w) - 2)}
    sets = {i: shingles(t) for i, t in rows}
    least = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                low = min(least[i], least[j])
                least = {k: low if v in (least[i], least[j]) else v for k, v in least.items()}
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in
           minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85).collect()}
    assert out == {i: (len(s), least[i]) for i, s in sets.items()}


def test_similarity_of_real_shingles():
    rng = random.Random(9)
    for _ in range(200):
        a, b = (" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 12))) for _ in range(2))

        def shingles(t):
            w = t.split()
            return {tuple(w[j:j + 3]) for j in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()
        x, y = shingles(a), shingles(b)
        assert minhash.similar(a, b, 3, 50) == bool(x and y and 100 * len(x & y) >= 50 * len(x | y))


def test_long_texts_are_split_in_steps(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    whole = minhash.shingle_hashes(text, 5)
    monkeypatch.setattr(minhash, "STEP_BYTES", 100)
    assert (minhash.shingle_hashes(text, 5)[0] == whole[0]).all() and minhash.shingle_hashes(text, 5)[1] == whole[1]
