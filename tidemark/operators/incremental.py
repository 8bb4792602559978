"""Aggregates kept up to date by changes.

``apply_deltas`` takes a stored aggregate, the rows it stands for and a batch of
changes, and gives the aggregate after the batch without reading the groups that the
batch does not touch: sums and counts move by signed differences of the before and
after images; the greatest value and the number of distinct values, which a removed
row may lower, are computed anew for the touched groups alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import apply as A


def images(rows: DataFrame, changes: DataFrame, keys: Sequence[str], ts_col: str = "ts", seq_col: str = "seq", op_col: str = "op") -> DataFrame:
    """The before images (``__sign`` -1: the stored row of each changed key) and the
    after images (+1: the latest change, unless a delete) of a batch."""
    latest = A.latest_per_key(changes, keys, [ts_col, seq_col])
    before = rows.join(latest.select(*keys), list(keys), "left_semi").withColumn("__sign", F.lit(-1))
    alive = latest.filter(F.coalesce(F.lower(F.col(op_col)), F.lit("u")) != "d")
    return before.unionByName(A.cast_like(alive, rows.schema).withColumn("__sign", F.lit(1)))


def aggregate(rows: DataFrame, group: Sequence[str], value: str, label: str) -> DataFrame:
    """The aggregate that is kept: rows, known values, their sum (an integer or exact
    decimal, so that differences are exact), greatest value, distinct labels."""
    return rows.groupBy(*group).agg(
        F.count("*").alias("n_rows"),
        F.count(value).alias("n_values"),
        F.coalesce(F.sum(value), F.lit(0)).alias("total"),
        F.max(value).alias("greatest"),
        F.count_distinct(label).alias("n_labels"),
    )


def apply_deltas(
    stored: DataFrame, rows: DataFrame, changes: DataFrame, keys: Sequence[str], group: Sequence[str], value: str, label: str, **order
) -> DataFrame:
    """``stored`` (``aggregate`` of ``rows``) after ``changes``; a group without rows
    goes.  A key that moves to another group changes both.  NULL groups are groups."""
    group = list(group)
    both = images(rows, changes, keys, **order)
    known = F.when(F.col(value).isNotNull(), F.col("__sign")).otherwise(0)
    deltas = both.groupBy(*group).agg(
        F.sum("__sign").alias("__rows"),
        F.sum(known).alias("__values"),
        F.coalesce(F.sum(F.col(value) * F.col("__sign")), F.lit(0)).alias("__total"),
    )
    touched = deltas.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)])
    same = None
    for i, g in enumerate(group):
        e = F.col(g).eqNullSafe(F.col(f"__g{i}"))
        same = e if same is None else same & e
    # What the touched groups hold now: their stored rows of unchanged keys, and the
    # after images.
    changed = changes.select(*keys).distinct()
    unchanged = rows.join(touched, same, "left_semi").join(changed, list(keys), "left_anti")
    now = unchanged.unionByName(both.filter("__sign = 1").drop("__sign"))
    fresh = now.groupBy(*group).agg(F.max(value).alias("greatest"), F.count_distinct(label).alias("n_labels"))
    moved = deltas.select(*group, F.col("__rows").alias("n_rows"), F.col("__values").alias("n_values"), F.col("__total").alias("total"), F.lit(1).alias("__touched"))
    summed = stored.select(*group, "n_rows", "n_values", "total", F.lit(0).alias("__touched")).unionByName(moved)
    summed = summed.groupBy(*group).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.sum("total").alias("total"), F.max("__touched").alias("__touched"))
    kept = stored.select(*group, "greatest", "n_labels").withColumn("__touched", F.lit(0)).unionByName(fresh.withColumn("__touched", F.lit(1)))
    latest = kept.groupBy(*group).agg(F.max(F.struct("__touched", "greatest", "n_labels")).alias("k"))
    out = summed.filter("n_rows > 0").select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], "n_rows", "n_values", "total")
    return latest.join(out, same).select(*group, "n_rows", "n_values", "total", F.col("k.greatest").alias("greatest"), F.col("k.n_labels").alias("n_labels"))
