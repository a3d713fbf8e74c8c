"""Page sources: snapshots of fetched pages, keyed by URL key.

Live HTTP is replaced by a snapshot table (what each fetch returned), so a
scrape is a join of the URLs to fetch with the snapshot table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.urls import url_key
from quarry.operators.dedup import first_wins

SNAPSHOT_COLS = ["final_url", "http_status", "content_type", "html", "fetch_error"]


def page_snapshots(rows: DataFrame, url_col: str = "page_url", ord_col: str = "page_id") -> DataFrame:
    """One snapshot per URL key (the first by ``ord_col`` wins)."""
    keyed = rows.select(url_key(F.col(url_col)).alias("url"), F.col(ord_col), *SNAPSHOT_COLS)
    return first_wins(keyed, "url", ord_col)


def fetch(todo: DataFrame, rows: DataFrame, key_col: str = "url_key", url_col: str = "page_url",
          ord_col: str = "page_id") -> DataFrame:
    """Attach the snapshot of every URL to fetch; URLs without one keep null
    snapshot columns and ``snap_found = false``.  ``todo`` holds a key once;
    snapshots without an ordinal are none.

    ``rows`` are the snapshot rows as they come.  The winner of each key is
    found on (key, ordinal) alone, and only for keys to fetch, and is attached
    to ``todo``; pages are read last, by key and ordinal, so HTML crosses one
    exchange at most: that of this join, whose partitioning also serves the
    removal of rows that share key and ordinal."""
    keyed = rows.select(url_key(F.col(url_col)).alias(key_col), F.col(ord_col).alias("_ord"), *SNAPSHOT_COLS)
    winners = (keyed.select(key_col, "_ord").where("_ord IS NOT NULL").join(todo.select(key_col), key_col, "left_semi")
               .groupBy(key_col).agg(F.min("_ord").alias("_ord"), F.lit(True).alias("snap_found")))
    located = todo.join(winners, key_col, "left")
    found = located.where("snap_found").join(keyed, [key_col, "_ord"]).dropDuplicates([key_col, "_ord"])
    types = dict(keyed.dtypes)
    missing = located.where("snap_found IS NULL").select("*", *[F.lit(None).cast(types[c]).alias(c) for c in SNAPSHOT_COLS])
    return (found.select(*todo.columns, *SNAPSHOT_COLS, "snap_found")
            .unionByName(missing.select(*todo.columns, *SNAPSHOT_COLS, F.lit(False).alias("snap_found"))))
