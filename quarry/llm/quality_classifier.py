"""Quality classifier as a sparse ensemble of rules.

Trees grown on text statistics give rules: each path from a root is a
conjunction of conditions.  A lasso logistic regression over the rules keeps a
few of them with weights; the score is the logistic of their sum.  Everything
is compiled into Spark column expressions, so scoring is one projection over
one scan, without a user function or a shuffle.

Fitting uses at most ``most_rows`` labelled rows (a documented bound; the rows
with the least hash of their id, so reruns agree); statistics are computed for
those rows only.  Scores never use id, language, source or labels.

Defined results: a null or empty text has zero for every statistic and gets a
score like any other; null ids and repeated rows are scored row by row; rows
without a label (or with a null one) are not learned from; without any label
the score is 0.5, with one class only it is that class; an empty table gives
an empty result; columns written here replace those of the input.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.forest import paths, read_tree
from quarry.llm.textstats import share, with_stats
from quarry.session import store

MOST_ROWS = 20_000
STATISTICS = ("n_words", "word_chars", "n_distinct", "n_stop", "n_adjacent", "n_repeat_words", "n_lines", "n_dup_lines",
              "n_chars", "n_symbols", "n_upper", "n_digits")
#: Inputs of the trees: (numerator, denominator), both of STATISTICS.
RATIOS = (("word_chars", "n_words"), ("n_distinct", "n_words"), ("n_stop", "n_words"), ("n_adjacent", "n_words"),
          ("n_repeat_words", "n_words"), ("n_dup_lines", "n_lines"), ("n_words", "n_lines"), ("n_symbols", "n_words"),
          ("n_upper", "word_chars"), ("n_digits", "n_chars"))


class Rule(NamedTuple):
    """Weight of a conjunction of (feature, is_above, limit)."""

    conditions: tuple
    weight: float


class Model(NamedTuple):
    intercept: float
    rules: tuple[Rule, ...]


def _features(df: DataFrame, text_col: str) -> DataFrame:
    out = with_stats(df, STATISTICS, text_col)
    return out.withColumns({f"__f{i}": share(F.col(a), F.col(b)) for i, (a, b) in enumerate(RATIOS)})


def simplify(conditions: tuple) -> tuple:
    """One lower and one upper limit for each feature, in a fixed order."""
    limits: dict[tuple[int, bool], float] = {}
    for feature, above, limit in conditions:
        key = (feature, above)
        limits[key] = limit if key not in limits else (max if above else min)(limits[key], limit)
    return tuple(sorted((f, a, v) for (f, a), v in limits.items()))


def holds(conditions: tuple) -> Column:
    out = F.lit(True)
    for feature, above, limit in conditions:
        value = F.col(f"__f{feature}")
        out = out & ((value > limit) if above else (value <= limit))
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", text_col: str = "text",
        most_rows: int = MOST_ROWS, trees: int = 20, depth: int = 4, penalty: float = 0.002, seed: int = 5) -> Model:
    """A model of ``labels`` (id, 0/1) from the texts of ``docs``."""
    marked = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("double").alias("__label")).dropna()
    chosen = marked.orderBy(F.xxhash64("__id"), "__id", "__label").limit(most_rows)
    known = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("text")).join(chosen, "__id")
    rows = store(_features(known, "text").select("__id", "__label", *[f"__f{i}" for i in range(len(RATIOS))]), "labelled-statistics")
    rows = rows.coalesce(1).sortWithinPartitions(*rows.columns)  # at most most_rows labels: the order of rows decides bagging
    classes = [r[0] for r in rows.select("__label").distinct().collect()]
    if len(classes) < 2:
        return Model(0.0 if not classes else (20.0 if classes[0] > 0 else -20.0), ())
    ready = VectorAssembler(inputCols=[f"__f{i}" for i in range(len(RATIOS))], outputCol="features").transform(rows)
    forest = RandomForestClassifier(labelCol="__label", numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=5).fit(ready)
    found = {simplify(p) for t in forest.trees for p in paths(read_tree(t.toDebugString))}
    rules = sorted(found, key=lambda c: (len(c), c))
    tested = rows.select("__label", F.array(*[holds(r).cast("double") for r in rules]).alias("held"))
    from pyspark.ml.functions import array_to_vector
    tested = store(tested, "labelled-rules").select("__label", array_to_vector("held").alias("features"))
    lasso = LogisticRegression(labelCol="__label", elasticNetParam=1.0, regParam=penalty, maxIter=100, standardization=False).fit(tested)
    weights = lasso.coefficients.toArray()
    return Model(float(lasso.intercept), tuple(Rule(r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-9))


def score(df: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``df`` with the score (double, 0 to 1) of each text."""
    total = F.lit(model.intercept)
    for rule in model.rules:
        total = total + F.when(holds(rule.conditions), F.lit(rule.weight)).otherwise(F.lit(0.0))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != score_col]).alias("__row")
    ready = _features(df.select(row, F.col(f"`{text_col}`").alias("__text")), "__text")
    return ready.select("__row.*", (1.0 / (1.0 + F.exp(-total))).alias(score_col))
