"""Text statistics as Spark columns (no user functions).

A word is a maximal run of characters other than space and 0x09-0x0D; a line
is a piece between newlines.  Null text counts as empty.  Every statistic
reads the whole text in time linear in its length (one sort for documents in
which a window of words repeats).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import bind

SPACE_RUN = r"[\x20\x09-\x0D]+"
WINDOW = 8

# Frequent function words of English, French, German, Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "it", "that", "for", "with", "on", "are", "be", "this", "by", "was", "from",
    "de", "la", "le", "les", "et", "des", "en", "que", "un", "une", "du", "qui", "dans", "par", "pour", "sur", "est",
    "der", "die", "das", "und", "den", "von", "mit", "zu", "ist", "nicht", "ein", "eine", "als", "auf", "für",
    "el", "los", "las", "y", "a", "se", "del", "al", "con", "no", "su", "por", "una",
)


def words(text: Column) -> Column:
    """array<string> of the words of a text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def removed_by(text: Column, pattern: str) -> Column:
    """Characters of a text that lie in matches of ``pattern``."""
    t = F.coalesce(text, F.lit(""))
    return (F.length(t) - F.length(F.regexp_replace(t, pattern, ""))).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def line_stats(text: Column) -> Column:
    """struct(n_lines, n_dup_lines): lines with a word, and those among them
    that equal an earlier line."""
    return bind(lines_with_words(text), lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))


def _windows(w: Column) -> Column:
    def at(i):
        return F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
    return F.when(F.size(w) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), at)).otherwise(
        F.array().cast("array<bigint>"))


def _covered(w: Column, h: Column) -> Column:
    """Words in repeated windows: sort the window hashes with their places,
    keep neighbours whose words agree, and add up the union of the windows."""
    def same(a, b):
        return F.coalesce((a["h"] == b["h"])
                          & (F.slice(w, a["i"] + 1, WINDOW) == F.slice(w, b["i"] + 1, WINDOW)), F.lit(False))

    def starts(s):
        kept = F.filter(s, lambda x, k: same(x, F.get(s, k + 1)) | (F.when(k > 0, same(x, F.get(s, k - 1))).otherwise(False)))
        return F.sort_array(F.transform(kept, lambda x: x["i"]))

    def union(p):
        gaps = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return bind(placed, lambda s: bind(starts(s), union))


def repeated_words(w: Column) -> Column:
    """Words of array ``w`` inside 8-word windows found twice or more in it,
    the first occurrence included (long)."""
    return bind(_windows(w), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_covered(w, h)))


def share(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 where there is no whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")


def _word_stat(name: str, w: Column, stop: list[str]) -> Column:
    if name == "n_words":
        return F.size(w).cast("long")
    if name == "n_distinct":
        return F.size(F.array_distinct(w)).cast("long")
    if name == "word_chars":
        return F.length(F.array_join(w, "")).cast("long")
    if name == "n_stop":
        return F.size(F.filter(w, lambda x: x.isin(stop))).cast("long")
    if name == "n_adjacent":
        return F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1)))).cast("long")
    return repeated_words(w)


def _char_stat(name: str, t: Column) -> Column:
    if name == "n_chars":
        return F.length(t).cast("long")
    return removed_by(t, {"n_symbols": r"[#*$%&|<>]+", "n_upper": r"\p{Lu}+", "n_digits": "[0-9]+"}[name])


WORD_COLUMNS = ("n_words", "word_chars", "n_distinct", "n_stop", "n_adjacent", "n_repeat_words")
LINE_COLUMNS = ("n_lines", "n_dup_lines")
CHAR_COLUMNS = ("n_chars", "n_symbols", "n_upper", "n_digits")
#: All statistics that ``with_stats`` knows.
STAT_COLUMNS = WORD_COLUMNS + LINE_COLUMNS + CHAR_COLUMNS


def stats(text: Column, names=STAT_COLUMNS, stop_words=STOP_WORDS) -> Column:
    """struct<long ...> of the statistics ``names`` as one expression: words
    and lines are split once, wherever the optimizer puts it.

    n_stop counts a stop word in lower case, capitalised or in upper case;
    n_adjacent the words equal to the word before; n_upper upper-case letters."""
    unknown = set(names) - set(STAT_COLUMNS)
    if unknown:
        raise ValueError(f"unknown statistics: {sorted(unknown)}")
    stop = sorted({v for w in stop_words for v in (w, w.capitalize(), w.upper())})
    t = F.coalesce(text, F.lit(""))

    def fields(w, lines):
        return F.struct(*[(_word_stat(n, w, stop) if n in WORD_COLUMNS else lines[n] if n in LINE_COLUMNS else _char_stat(n, t)).alias(n)
                          for n in STAT_COLUMNS if n in names])

    def with_lines(w):
        return bind(line_stats(t), lambda x: fields(w, x)) if set(LINE_COLUMNS) & set(names) else fields(w, None)
    return bind(words(t), with_lines) if set(WORD_COLUMNS) & set(names) else with_lines(None)


def with_stats(df: DataFrame, names=STAT_COLUMNS, text_col: str = "text", stop_words=STOP_WORDS) -> DataFrame:
    """``df`` with a long column for each statistic of ``names``; input
    columns of these names (and ``__stats``) are replaced.  Catalyst keeps the
    two projections apart because the second one uses the costly struct
    several times; a filter on several of the columns would be pushed below
    them and repeat it, so filters use one expression over ``stats``."""
    own = {c.lower() for c in (*names, "__stats")} - {text_col.lower()}
    clean = df.select(*[f"`{c}`" for c in df.columns if c.lower() not in own])
    one = clean.select("*", stats(F.col(f"`{text_col}`"), names, stop_words).alias("__stats"))
    return one.select(*[f"`{c}`" for c in clean.columns], *[F.col("__stats")[n].alias(n) for n in STAT_COLUMNS if n in names])
