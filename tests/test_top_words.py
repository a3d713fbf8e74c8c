"""Topic words of the offline annotator: the most frequent, ties by word."""

import random
from collections import Counter

from quarry.operators.annotate import TOPIC_COUNT, _most_frequent


class Compared(str):
    """A word that counts how often it is compared."""
    times = 0

    def __lt__(self, other):
        Compared.times += 1
        return str.__lt__(self, other)
    __hash__ = str.__hash__


def test_most_frequent_words_as_a_full_sort_gives_them():
    rng = random.Random(3)
    for n in (0, 1, 3, 5, 6, 40, 400):
        counts = Counter(rng.choices(["word%d" % i for i in range(60)], k=n))
        assert _most_frequent(counts) == sorted(counts, key=lambda w: (-counts[w], w))[:TOPIC_COUNT]


def test_rare_words_are_not_put_in_order():
    """A page of many words that come once: those are not compared."""
    counts = Counter({Compared("once%d" % i): 1 for i in range(5000)})
    counts.update({Compared("often%d" % i): 9 for i in range(8)})
    assert _most_frequent(counts) == ["often%d" % i for i in range(TOPIC_COUNT)]
    assert Compared.times < 100
