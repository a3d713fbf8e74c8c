"""Order-based limits: the first ``n`` rows (L1) and "rows until ``n``
succeeded" (L2).

Both reduce to one question: what is the ``n``-th smallest ordinal among
some rows?  Every row at or before that ordinal is kept.  The answer is found
without a global window or a global top-n (either would pull up to
partitions x n values into one task): distributed selection by histogram
refinement.  Each round is one aggregation returning at most ``BUCKETS``
(count, min, max) triples to the driver and narrows the candidate range to
the bucket holding the ``n``-th value; once that bucket holds at most
``FETCH_LIMIT`` values they are fetched and the answer is picked exactly.
The ordinal must be numeric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FETCH_LIMIT = 10_000
BUCKETS = 1024


def nth_smallest(df: DataFrame, ord_col: str, n: int, where: Column | None = None):
    """The ``n``-th smallest value of ``ord_col`` among rows meeting
    ``where`` (duplicates counted), or None when there are fewer rows."""
    if n <= 0:
        raise ValueError("n must be positive")
    keep = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    cur = (df.select(F.col(ord_col).alias("o"), keep.alias("_w"))
             .where(F.col("_w") & F.col("o").isNotNull()).select("o"))
    stats = cur.agg(F.min("o").alias("lo"), F.max("o").alias("hi"), F.count("*").alias("c")).first()
    if stats["c"] < n:
        return None
    lo, hi, cnt, need = stats["lo"], stats["hi"], stats["c"], n
    while cnt > FETCH_LIMIT and lo != hi:
        width = float(hi - lo) / BUCKETS
        b = F.least(F.floor((F.col("o") - F.lit(lo)) / F.lit(width)), F.lit(BUCKETS - 1)).cast("int")
        hist = sorted((r["b"], r["c"], r["lo"], r["hi"]) for r in
                      cur.groupBy(b.alias("b")).agg(F.count("*").alias("c"), F.min("o").alias("lo"),
                                                    F.max("o").alias("hi")).collect())
        seen = 0
        for bucket, c, blo, bhi in hist:
            if seen + c >= need:
                need -= seen
                cur = cur.where(b == F.lit(bucket))
                lo, hi, cnt = blo, bhi, c
                break
            seen += c
    if lo == hi:
        return lo
    values = sorted(r["o"] for r in cur.collect())   # at most FETCH_LIMIT values
    return values[need - 1]


def head_by_order(df: DataFrame, n: int | None, ord_col: str = "ord") -> DataFrame:
    """The first ``n`` rows in ``ord`` order (all rows when ``n`` is None)."""
    if n is None:
        return df
    cutoff = nth_smallest(df, ord_col, n)
    return df if cutoff is None else df.where(F.col(ord_col) <= F.lit(cutoff))


def until_successes(df: DataFrame, n: int | None, success: Column, ord_col: str = "ord") -> DataFrame:
    """Rows reached by a loop that stops once ``n`` rows have succeeded:
    every row up to and including the ``n``-th success.  Failures and skips
    do not count towards ``n``."""
    if n is None:
        return df
    cutoff = nth_smallest(df, ord_col, n, where=F.coalesce(success, F.lit(False)))
    return df if cutoff is None else df.where(F.col(ord_col) <= F.lit(cutoff))


def process_until_successes(candidates: DataFrame, n: int, process, success: Column,
                            ord_col: str = "ord", first_window: int | None = None):
    """Run an expensive ``process`` (model call) over ``candidates`` in
    ``ord`` order only as far as needed for ``n`` successes.

    Candidates are taken in growing windows (2n, then doubling); every window
    is processed once and materialised, and processing stops as soon as the
    processed prefix holds ``n`` successes.  Returns ``(rows, cutoff)``: the
    processed rows up to and including the ``n``-th success, and that
    ordinal (None when there are fewer successes).  The result equals
    processing everything and cutting at the ``n``-th success."""
    from quarry.session import materialize
    window = first_window or max(2 * n, 1)
    done, lo = None, None
    while True:
        rest = candidates if lo is None else candidates.where(F.col(ord_col) > F.lit(lo))
        hi = nth_smallest(rest, ord_col, window)
        part = rest if hi is None else rest.where(F.col(ord_col) <= F.lit(hi))
        out = materialize(process(part))
        done = out if done is None else done.unionByName(out)
        if hi is None or done.where(success).count() >= n:
            break
        lo, window = hi, window * 2
    cutoff = nth_smallest(done, ord_col, n, where=F.coalesce(success, F.lit(False)))
    rows = done if cutoff is None else done.where(F.col(ord_col) <= F.lit(cutoff))
    return rows, cutoff
