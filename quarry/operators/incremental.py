"""Incremental processing: skip what earlier runs already produced.

Anti/semi joins are left to Catalyst and AQE: the existing-key side is
broadcast only when its runtime size is under the broadcast threshold, and a
sort-merge join (with skew splitting) is used beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def only_new(candidates: DataFrame, existing_keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``candidates`` whose key is not in ``existing_keys``."""
    return candidates.join(existing_keys.select(key), on=key, how="left_anti")


def flag_existing(candidates: DataFrame, existing_keys: DataFrame, key: str,
                  flag: str = "exists") -> DataFrame:
    """Adds a boolean column telling whether the key is already present."""
    marks = existing_keys.select(key).distinct().withColumn(flag, F.lit(True))
    return (candidates.join(marks, on=key, how="left")
                      .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def append(prior: DataFrame, new: DataFrame) -> DataFrame:
    """UNION ALL of prior output and the new records, by column name."""
    return prior.unionByName(new, allowMissingColumns=True)
