"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every quarry job relies on.  AQE re-plans joins and coalesces
# shuffle partitions at runtime; skew-join splitting handles hot keys.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # CPU-heavy per-row stages (HTML regex, model calls) follow shuffles;
    # let AQE keep small partitions so they still use every core.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, pass the cluster master and a
    shuffle partition count sized to the data (about 128-256 MB per task)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none (local tests) do we create one, once per
    session, and register it so ``DataFrame.checkpoint`` works too.
    """
    sc = spark.sparkContext
    existing = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if existing:
        return existing.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    found = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    return (found or conf_dir).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root}/quarry-{name}-{uuid.uuid4().hex[:12]}"


#: Spark's setting to remove the shuffle files of a query when it ends.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries run inside are removed when these end, not when
    the driver's garbage is collected: what a stage leaves is its stored table."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


def store(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back:
    the lineage ends there, executors may be lost afterwards, and every later
    reader prunes columns and filters in the scan."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Run an expensive or non-deterministic stage once (see ``store``)."""
    return store(df, "stage")


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable in every Python worker (what
    ``--py-files`` does at submit time): zip the package once per
    SparkContext and register it with ``addPyFile``."""
    sc = spark.sparkContext
    if getattr(sc, "_quarry_shipped", False):
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = tempfile.mkdtemp(prefix="quarry-pkg-")
    archive = shutil.make_archive(os.path.join(base, "quarry"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="quarry")
    sc.addPyFile(archive)
    sc._quarry_shipped = True
