"""Incremental ingestion with Structured Streaming.

Arriving page files are read with the file source; every micro-batch is
handled by ``foreachBatch`` with the batch operators: first-wins inside the
batch, anti join with the keys in the buckets of the target table that the
batch touches, append (see ``sources.keyed``).  The sink is at-least-once; a
replayed batch has its commit already, and one of another stream finds its keys
stored, so reruns and recovery after executor loss never duplicate a key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.urls import url_key
from quarry.operators.dedup import first_wins
from quarry.sources import keyed

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])


def page_stream(spark: SparkSession, source_dir: str, glob: str = "*.parquet",
                schema: T.StructType = PAGES, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(source_dir)


def _batch_name(checkpoint: str, epoch_id: int) -> str:
    """The commit of a micro-batch, named by stream and batch number."""
    return f"stream-{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}-{epoch_id:012d}"


def keyed_append_batch(target: str, key: str, prepare: Callable[[DataFrame], DataFrame], checkpoint: str,
                       ord_col: str = "ord"):
    """foreachBatch body: prepare -> first-wins per key -> anti join with
    the target's keys -> append."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        keyed.append(first_wins(prepare(batch), key, ord_col), key, target, name=_batch_name(checkpoint, epoch_id))

    return run


def run_available(stream: DataFrame, batch_fn, checkpoint: str) -> None:
    """Process everything available now, then stop."""
    q = (stream.writeStream.foreachBatch(batch_fn)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def ingest_pages(spark: SparkSession, source_dir: str, glob: str, target: str, checkpoint: str) -> None:
    """T1: page files -> (url_key, page_id) table without duplicate keys."""
    prepare = lambda b: b.select(url_key(F.col("url")).alias("url_key"), F.col("page_id").alias("ord"))
    run_available(page_stream(spark, source_dir, glob), keyed_append_batch(target, "url_key", prepare, checkpoint), checkpoint)


def dedup_stream(spark: SparkSession, source_dir: str, glob: str, target: str, checkpoint: str) -> None:
    """T2: streaming de-duplication by URL key.  The keys seen are state that
    grows for ever, so it is kept in RocksDB on the executors' disks (and in
    the checkpoint), not in their memory; use dropDuplicatesWithinWatermark
    when a horizon is acceptable."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    s = page_stream(spark, source_dir, glob).select(url_key(F.col("url")).alias("url_key"), "page_id")
    q = (s.dropDuplicates(["url_key"]).writeStream.format("parquet")
         .option("path", target).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    try:
        q.awaitTermination()
    finally:  # the session's own setting
        spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)


def scrape_stream(spark: SparkSession, source_dir: str, glob: str, target: str, checkpoint: str, *,
                  to_snapshot_rows: Callable[[DataFrame], DataFrame], min_chars: int, run_ts: str) -> None:
    """T3: each micro-batch of fetched pages becomes scrape records, appended
    to the raw table, kept by URL, unless the URL key is already there."""
    from quarry.operators.scrape import scrape_records
    from quarry.sources.pages import fetch

    def run(batch: DataFrame, epoch_id: int) -> None:
        rows, name = to_snapshot_rows(batch), _batch_name(checkpoint, epoch_id)
        if keyed.is_done(spark, target, name):
            return
        todo = rows.groupBy(url_key(F.col("page_url")).alias("url_key")).agg(F.min("page_id").alias("ord"))
        new = scrape_records(fetch(keyed.absent(todo, "url_key", target), rows), min_chars, run_ts)
        keyed.append(new, "url", target, name=name, known_new=True)

    run_available(page_stream(spark, source_dir, glob), run, checkpoint)


def ingest_stream(spark: SparkSession, source_dir: str, glob: str, base: str, checkpoint: str, *,
                  to_snapshot_rows: Callable[[DataFrame], DataFrame], min_chars: int, run_ts: str,
                  files_per_trigger: int | None = None, **models) -> None:
    """T3 in full: each micro-batch of fetched pages is scraped, analysed and
    indexed into the tables under ``base``, as one commit named by stream and
    batch number (see ``sources.commits``): a batch that is replayed, or cut
    between two tables, is stored once.  A key whose last stage is missing is
    taken up again when it comes again."""
    from quarry.plans.ingest import ingest_into
    from quarry.session import materialize

    def run(batch: DataFrame, epoch_id: int) -> None:
        rows = materialize(to_snapshot_rows(batch))
        keys = rows.groupBy(url_key(F.col("page_url")).alias("url_key")).agg(F.min("page_id").alias("ord"))
        ingest_into(batch.sparkSession, keys, rows, base, min_chars=min_chars, run_ts=run_ts,
                    commit=_batch_name(checkpoint, epoch_id), **models)

    run_available(page_stream(spark, source_dir, glob, files_per_trigger=files_per_trigger), run, checkpoint)
