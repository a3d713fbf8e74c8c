"""JSON Lines source and sink.

Reads always use an explicit schema.  Under PERMISSIVE mode a malformed line
becomes a row whose fields are null and whose ``_corrupt_record`` holds the
text (quarantine instead of aborting the run); FAILFAST aborts like a strict
reader.  Blank lines are skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, *, mode: str = "PERMISSIVE") -> DataFrame:
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(full).option("mode", mode)
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def valid_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantined(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """UTF-8 JSON Lines, non-ASCII kept, null fields written explicitly."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


# What a record means when it leaves these fields out.
RECORD_DEFAULTS = {"status": "'ok'", "chars": "0", "topics": "array()"}


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """RAW or ENRICHED records: numbers may be written as text, and fields
    with a default may be left out.  Malformed lines are quarantined."""
    loose = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.IntegerType) else f.dataType)
                          for f in schema.fields])

    def typed(f: T.StructField):
        value = F.col(f.name).try_cast(f.dataType) if isinstance(f.dataType, T.IntegerType) else F.col(f.name)
        if f.name in RECORD_DEFAULTS:
            default = F.expr(RECORD_DEFAULTS[f.name]).cast(f.dataType)
            value = F.when(F.col(CORRUPT).isNull(), F.coalesce(value, default))
        return value.alias(f.name)
    return read_jsonl(spark, path, loose).select(*[typed(f) for f in schema.fields], CORRUPT)
