"""URL-list files: one URL per line, ``#`` comments and blank lines allowed.

``read_url_lines`` gives ``(ord, line)``; the ordinal is the number of the
line over all files in path order, found without a global sort: lines are
numbered within their split, and the splits (a row each) are put in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import materialize


def read_url_lines(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))
    raw = materialize(raw)   # positions are read twice and must not change in between
    splits = raw.groupBy("file", "block").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)   # a row per split
    splits = splits.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return raw.join(splits, ["file", "block"]).select((F.col("before") + F.col("pos") - F.col("first")).alias("ord"), "line")
