"""Tree ensembles of Spark ML as column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_LINE = re.compile(r"(?P<word>If|Else|Predict:) ?(?:\(feature (?P<feature>\d+) (?P<op><=|>) (?P<limit>\S+)\)|(?P<value>\S+))")


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    """``feature <= limit`` goes left."""

    feature: int
    limit: float
    left: Leaf | Split
    right: Leaf | Split


def read_tree(description: str) -> Leaf | Split:
    """A tree from its ``toDebugString``."""
    found = [m for line in description.splitlines() if (m := _LINE.match(line.strip()))]
    place = 0

    def node():
        nonlocal place
        m = found[place]
        place += 1
        if m["word"] == "Predict:":
            return Leaf(float(m["value"]))
        left = node()
        place += 1  # the line of the other branch
        return Split(int(m["feature"]), float(m["limit"]), left, node())
    return node()


def value_of(tree: Leaf | Split, feature: Callable[[int], Column]) -> Column:
    if isinstance(tree, Leaf):
        return F.lit(tree.value)
    return F.when(feature(tree.feature) <= tree.limit, value_of(tree.left, feature)).otherwise(value_of(tree.right, feature))


def paths(tree: Leaf | Split, so_far: tuple = ()) -> list[tuple]:
    """Every path from the root to a node, as conditions (feature, is_above, limit)."""
    out = [so_far] if so_far else []
    if isinstance(tree, Split):
        out += paths(tree.left, (*so_far, (tree.feature, False, tree.limit)))
        out += paths(tree.right, (*so_far, (tree.feature, True, tree.limit)))
    return out
