"""The input tables: one Parquet dataset per name under a directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


#: Larger tables are never redistributed.
SPREAD_BYTES = 128 << 20


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy per-row work on a small table one partition per core.

    A Parquet file with a single row group is read by a single task; a table of
    up to ``SPREAD_BYTES`` whose scan yields fewer partitions than the
    session's parallelism is redistributed round-robin.  Larger tables stay as
    they are scanned, so no table that is costly to move is moved."""
    try:
        if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > SPREAD_BYTES:
            return df
        target = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. a Connect session)
        return df
    return df.repartition(target) if parts < target else df


def load(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Read ``{base_dir}/{name}.parquet``; the schema comes from the Parquet
    footer (no inference pass), and Catalyst prunes columns and pushes
    filters into the scan (through the round-robin spread as well)."""
    return spread(spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet"))


def files_of(spark: SparkSession, base_dir: str, name: str) -> tuple[str, str]:
    """Folder and file pattern of a table for a stream of its files: a table is
    one file under ``base_dir`` or a folder of part files."""
    path = f"{base_dir.rstrip('/')}/{name}.parquet"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return (path, "*.parquet") if fs.getFileStatus(p).isDirectory() else (base_dir, f"{name}.parquet")
