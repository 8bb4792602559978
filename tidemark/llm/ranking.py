"""The first rows of every group, when a group may have rows from every task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def first_rows(df: DataFrame, keys: list[str], order: list, top: int, spread) -> DataFrame:
    """The first ``top`` rows of each group by ``order``, with their ``rank``.
    They are first sought among ``SALTS`` shares of a group (by ``spread``), then
    among what these leave, so one task sees a share of a large group only."""
    some = Window.partitionBy(*keys, "_salt").orderBy(*order)
    every = Window.partitionBy(*keys).orderBy(*order)
    df = df.withColumn("_salt", F.pmod(spread, F.lit(SALTS))).withColumn("rank", F.row_number().over(some))
    df = df.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(every))
    return df.where(F.col("rank") <= top).drop("_salt")
