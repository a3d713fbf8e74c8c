"""Keyed de-duplication and keyed lookups.

Two phases.  The winning ordinal of each key is an aggregate on (key, ordinal)
alone, combined map-side, so a hot key holding a third of the rows is one row
per input partition before any shuffle.  Rows are then read for the winners
only, by a semi-join on key *and* ordinal: its hash spreads the rows of a hot
key over all tasks, and no task ever receives the whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.urls import url_key
from quarry.functions.text import strip

_AT = "_winner_at"


def _rows_at(df: DataFrame, keys: list[str], ord_col: str, winners: DataFrame) -> DataFrame:
    """One row of ``df`` for each (keys, ordinal) of ``winners``.  Key and
    ordinal are one struct, whose equality holds for nulls too; rows that share
    both are reduced on the partitioning of the join."""
    at = F.struct(*keys, ord_col).alias(_AT)
    return df.select("*", at).join(winners.select(at), _AT, "left_semi").dropDuplicates([_AT]).drop(_AT)


def first_wins(df: DataFrame, key: str | list[str], ord_col: str = "ord") -> DataFrame:
    """One row per key: the row with the smallest ``ord`` (first in input
    order).  Deterministic regardless of partitioning, unlike
    ``dropDuplicates``.  Rows keep all their columns; of rows that share key and
    ordinal, one stays.  ``df`` is evaluated twice, the first time for keys and
    ordinals only."""
    keys = [key] if isinstance(key, str) else list(key)
    winners = df.groupBy(*keys).agg(F.min(ord_col).alias(ord_col))
    rest = [c for c in df.columns if c not in keys]
    if rest == [ord_col]:
        return winners
    return _rows_at(df, keys, ord_col, winners).select(*keys, *rest)


def latest_matching(df: DataFrame, key: str, predicate: Column, ord_col: str = "ord") -> DataFrame:
    """For every key, the last row (largest ``ord``) that meets ``predicate``.
    Keys with no such row are absent, and rows without an ordinal never win."""
    matching = df.where(F.coalesce(predicate, F.lit(False)) & F.col(ord_col).isNotNull())
    winners = matching.groupBy(key).agg(F.max(ord_col).alias(ord_col))
    return _rows_at(matching, [key], ord_col, winners).select(key, *[c for c in df.columns if c != key])


def seen_keys(records: DataFrame, url_col: str = "url", key_col: str = "url_key") -> DataFrame:
    """Distinct URL keys of a record table; records without a URL are
    ignored.  Only the URL column is read.

    A stored URL counts both as it is and normalised: records written by
    this engine store the key itself (D2), and normalisation is not
    idempotent (``/a//`` -> ``/a/`` -> ``/a``), so re-normalising a stored
    key would make a rerun add it again; URLs stored by other writers are
    matched through their normalised form."""
    u = F.col(url_col)
    urls = records.select(u.alias("u")).where(F.col("u").isNotNull() & (F.col("u") != ""))
    both = F.array_distinct(F.array(F.col("u"), url_key(F.col("u"))))
    return urls.select(F.explode(both).alias(key_col)).distinct()


def url_list(lines: DataFrame, line_col: str = "line", ord_col: str = "ord") -> DataFrame:
    """URL-list semantics over ``(ord, line)``: strip each line, drop blank
    lines and ``#`` comments, keep the first occurrence of each exact line."""
    s = strip(F.col(line_col))
    kept = (lines.select(F.col(ord_col).alias("ord"), s.alias("url"))
                 .where((F.col("url") != "") & ~F.col("url").startswith("#")))
    return (kept.groupBy("url").agg(F.min("ord").alias("ord"))
                .select("ord", "url"))
