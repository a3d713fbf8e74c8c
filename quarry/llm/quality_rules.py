"""Quality rules: a threshold table compiled into one Spark projection.

Each rule bounds one ratio of text statistics from below, above or both; a
document is kept if every rule holds.  All ratios are built-in expressions
over one scan: no user function, no shuffle, no second pass.

Defined results: null and empty texts have no words and fail ``n_words``;
null ids and repeated rows are judged one by one like any row; an empty table
gives an empty result; input columns with the names written here are replaced,
others are carried along.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import bind
from quarry.llm.textstats import STAT_COLUMNS, share, stats


class Rule(NamedTuple):
    """``low <= part / whole <= high`` (``whole`` None: the plain statistic)."""

    name: str
    part: str
    whole: str | None
    low: float | None
    high: float | None


#: Rules every caller gets: enough words, few of them in repeated windows.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: The threshold table.  Ratios do not depend on the length of the text, so
#: long documents are not treated differently from short ones.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 12.0),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.1),
    Rule("stop_word_share", "n_stop", "n_words", 0.03, None),
    Rule("upper_case_share", "n_upper", "word_chars", None, 0.5),
    Rule("adjacent_repeat_share", "n_adjacent", "n_words", None, 0.3),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", None, 0.5),
)


def base_failed(s: Column, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> Column:
    return (s["n_words"] < min_words) | (100 * s["n_repeat_words"] > max_repeat_percent * s["n_words"])


def broken(rule: Rule, s: Column) -> Column:
    """True if the rule does not hold for the statistics ``s`` (struct)."""
    value = s[rule.part].cast("double") if rule.whole is None else share(s[rule.part], s[rule.whole])
    out = F.lit(False)
    if rule.low is not None:
        out = out | (value < rule.low)
    if rule.high is not None:
        out = out | (value > rule.high)
    return out


def _used(rules) -> set[str]:
    return {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"} | {c for r in rules for c in (r.part, r.whole) if c}


def judge(text: Column, rules=RULES) -> Column:
    """struct of the statistics, ``base_failed``, ``broken_rules`` (names of
    the rules that do not hold) and ``kept``, as one expression: wherever the
    optimizer moves a use of it, a text is read once for it."""
    names = [n for n in STAT_COLUMNS if n in _used(rules)]

    def of(s):
        names_of = F.array(*[F.when(broken(r, s), F.lit(r.name)) for r in rules]) if rules else F.array().cast("array<string>")
        return bind(F.filter(names_of, lambda x: x.isNotNull()), lambda b: F.struct(
            *[s[n].alias(n) for n in names], base_failed(s).alias("base_failed"), b.alias("broken_rules"),
            (~base_failed(s) & (F.size(b) == 0)).alias("kept")))
    return bind(stats(text, names), of)


def apply_rules(df: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """``df`` with a column for each field of ``judge``."""
    written = {*_used(rules), "base_failed", "broken_rules", "kept", "__judged"} - {text_col}
    names = [f"`{c}`" for c in df.columns if c.lower() not in written]
    one = df.select(*names, judge(F.col(f"`{text_col}`"), rules).alias("__judged"))
    return one.select(*names, "__judged.*")


def keep_good(df: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """The rows whose text passes, with exactly the columns of ``df``."""
    return df.filter(judge(F.col(f"`{text_col}`"), rules)["kept"])
