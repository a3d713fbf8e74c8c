"""Groups of rows as a stream inside Arrow batches.

Rows are dealt out by key, sorted within their partition, and handed to a
Python function one group at a time: no call per group through Spark, and no
more than one group in memory.  Callers bound the size of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def group_tables(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal ``keys`` in a sorted stream."""
    held, held_key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = list(zip(*[batch.column(k).to_pylist() for k in keys]))
        start = 0
        for i in range(1, len(rows) + 1):
            if i < len(rows) and rows[i] == rows[start]:
                continue
            if held and rows[start] != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held_key = rows[start]
            held.append(batch.slice(start, i - start))
            start = i
    if held:
        yield pa.Table.from_batches(held)


def each_group(df: DataFrame, keys: list[str], schema: str, work: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``work(table)`` for the rows of each distinct ``keys`` (not null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in group_tables(batches, keys):
            yield from work(table)
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
