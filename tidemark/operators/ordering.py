"""Order-dependent operators that stay distributed under skew.

``row_number() OVER (ORDER BY ...)`` without a partition, or ``RANK() OVER
(PARTITION BY g ...)`` where one group holds a large share of all rows, runs in
a single task.  The helpers here compute the same numbers from a range-
partitioned global sort:

1. ``repartitionByRange`` + ``sortWithinPartitions`` on (group, order): every
   task sorts a bounded slice, hot groups are spread over many tasks;
2. each row gets (partition id, position in partition) from
   ``monotonically_increasing_id``;
3. per (partition, group) row counts -- a table with at most
   ``partitions x groups-per-partition`` rows -- give each partition's offset
   inside its group (a running sum over that small table);
4. offset + local position = the exact position; ties get the minimum
   position of their (group, value) through an aggregate.

The sorted, numbered slice is materialised with ``checkpoint()`` (into the
shared ``spark.checkpoint.dir``) so that the counts and the rows come from the
very same numbering even if a task is re-run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

_LOCAL_BITS = 33
_LOCAL_MASK = (1 << _LOCAL_BITS) - 1


def _number_partitions(df: DataFrame, sort_cols: Sequence[Column], partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
    mid = F.monotonically_increasing_id()
    numbered = ranged.withColumn("__pid", F.shiftright(mid, _LOCAL_BITS)).withColumn("__local", mid.bitwiseAND(F.lit(_LOCAL_MASK)))
    return numbered.checkpoint(eager=True)


def global_index(df: DataFrame, order: Sequence[str], name: str = "row_index", partitions: int | None = None) -> DataFrame:
    """Exact 0-based position of each row in ``order`` (ties in arbitrary but
    fixed order) -- ``row_number() OVER (ORDER BY order) - 1`` without a
    single-task window."""
    numbered = _number_partitions(df, [F.col(c) for c in order], partitions)
    counts = numbered.groupBy("__pid").agg(F.count("*").alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: the running sum is over at most `partitions` rows.
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__offset"))
    out = numbered.join(F.broadcast(offsets), "__pid")
    return out.withColumn(name, (F.col("__offset") + F.col("__local")).cast("long")).drop("__pid", "__local", "__offset")


def group_rank(
    df: DataFrame,
    group: Sequence[str],
    order_col: str,
    descending: bool = True,
    name: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """SQL ``RANK() OVER (PARTITION BY group ORDER BY order_col [DESC])``,
    computed without putting a whole group in one task."""
    group = list(group)
    key = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_first()
    numbered = _number_partitions(df, [F.col(g) for g in group] + [key], partitions)
    per_part = numbered.groupBy("__pid", *group).agg(F.count("*").alias("__n"), F.min("__local").alias("__first"))
    w = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # per_part has one row per (partition, group) present in it; a group's rows
    # here are bounded by the number of partitions.
    offsets = per_part.select("__pid", *group, "__first", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__before"))
    positioned = _join_null_safe(numbered, offsets, ["__pid", *group]).withColumn(
        "__pos", F.col("__before") + F.col("__local") - F.col("__first")
    )
    firsts = positioned.groupBy(*group, order_col).agg(F.min("__pos").alias("__min_pos"))
    ranked = _join_null_safe(positioned, firsts, [*group, order_col])
    return ranked.withColumn(name, (F.col("__min_pos") + 1).cast("int")).drop("__pid", "__local", "__first", "__before", "__pos", "__min_pos")


def _join_null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Equi-join on ``cols`` where NULL matches NULL, keeping left's columns."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in cols], *[c for c in right.columns if c not in cols])
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"__r_{c}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond).drop(*[f"__r_{c}" for c in cols])


def prior_sum(
    df: DataFrame,
    key: Sequence[str],
    order_col: str,
    value_col: str,
    bucket: Column,
    sum_name: str = "prior_sum",
    count_name: str = "prior_count",
) -> DataFrame:
    """For each row: SUM and COUNT of ``value_col`` over rows with the same
    ``key`` and a strictly smaller ``order_col`` -- the correlated subquery
    ``(SELECT SUM(v) FROM t h WHERE h.key = t.key AND h.o < t.o)``.

    Two levels keep every task bounded even for a hot key: totals per
    (key, bucket) (``bucket`` must be monotone in ``order_col``, e.g. the
    month) give the sum of all earlier buckets; inside a bucket a running sum
    over pre-aggregated (key, bucket, order value) rows gives the rest."""
    key = list(key)
    b = df.withColumn("__bucket", bucket)
    per_value = b.groupBy(*key, "__bucket", order_col).agg(F.sum(value_col).alias("__v"), F.count("*").alias("__c"))
    w_in = Window.partitionBy(*key, "__bucket").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    in_bucket = per_value.select(
        *key,
        "__bucket",
        order_col,
        F.coalesce(F.sum("__v").over(w_in), F.lit(0)).alias("__in_v"),
        F.coalesce(F.sum("__c").over(w_in), F.lit(0)).alias("__in_c"),
    )
    per_bucket = b.groupBy(*key, "__bucket").agg(F.sum(value_col).alias("__bv"), F.count("*").alias("__bc"))
    w_b = Window.partitionBy(*key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = per_bucket.select(
        *key,
        "__bucket",
        F.coalesce(F.sum("__bv").over(w_b), F.lit(0)).alias("__pre_v"),
        F.coalesce(F.sum("__bc").over(w_b), F.lit(0)).alias("__pre_c"),
    )
    stats = in_bucket.join(before, [*key, "__bucket"]).select(
        *key,
        order_col,
        (F.col("__pre_v") + F.col("__in_v")).alias(sum_name),
        (F.col("__pre_c") + F.col("__in_c")).cast("long").alias(count_name),
    )
    return df.join(stats, [*key, order_col], "left")


def group_prefix_sum(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str = "prefix_sum",
    partitions: int | None = None,
) -> DataFrame:
    """Running sum of ``value`` within each group in ``order`` (inclusive):
    ``SUM(value) OVER (PARTITION BY group ORDER BY order ROWS UNBOUNDED
    PRECEDING)``, without holding a group in one task.  ``order`` must be a
    total order within the group.

    The group is cut into range-partition slices; each slice's total gives
    the offsets of later slices (a table of at most partitions x groups rows),
    and the running sum inside a slice is a window over that slice only."""
    group, order = list(group), list(order)
    numbered = _number_partitions(df, [F.col(c) for c in group + order], partitions)
    totals = numbered.groupBy("__pid", *group).agg(F.sum(value).alias("__t"))
    w = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__pid", *group, F.coalesce(F.sum("__t").over(w), F.lit(0)).alias("__before"))
    w_in = Window.partitionBy("__pid", *group).orderBy(*[F.col(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    local = numbered.withColumn("__run", F.sum(value).over(w_in))
    out = _join_null_safe(local, offsets, ["__pid", *group])
    return out.withColumn(name, F.col("__before") + F.col("__run")).drop("__pid", "__local", "__before", "__run")


SELECT_BUCKETS = 1024
SELECT_ROWS = 100_000  # rows of one group that a window may order


def first_n(df: DataFrame, group: Sequence[str], order_col: str, n: int, descending: bool = False, window_rows: int = SELECT_ROWS) -> DataFrame:
    """The first ``n`` rows of every group by an integer column, without ordering
    the groups: ``row_number() OVER (PARTITION BY group ORDER BY order_col) <= n``.

    The position of the n-th row is found by counting.  A group's range of values
    is cut into ``SELECT_BUCKETS`` equal steps and its rows are counted by step (a
    map-side aggregate); the step in which the count passes ``n`` is the new range,
    until at most ``window_rows`` rows of a group lie in it or it is one value.
    Rows before that range are taken as they are, only those in it are ordered.
    Equal values go by a hash of the row, and where more than ``window_rows`` rows
    have one value, that hash is what is counted by next.  NULLs in ``group`` are a
    group; a NULL value comes last, as the oldest of a descending order or the
    newest of an ascending one.  One small row for each group is all that the
    driver plans with; it is joined, not collected."""
    group = list(group)
    rows = df.withColumn("__tie", F.xxhash64(*df.columns))
    value = F.col(order_col).cast("long")
    lowest, highest = F.lit(-(1 << 63)).cast("long"), F.lit((1 << 63) - 1).cast("long")
    # ``__v`` ascends in the wanted order; a NULL is after all others.
    rows = rows.withColumn("__v", F.coalesce(F.bitwise_not(value) if descending else value, highest))
    cuts = rows.groupBy(*group).agg(F.count("*").alias("__rows"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    cuts = cuts.withColumn("__need", F.lit(n).cast("long")).withColumn("__by_tie", F.lit(False))
    cuts = cuts.withColumn("__value", F.col("__lo"))  # the one value, where ties are counted
    cuts = _kept(cuts)
    while True:
        open_cut = (F.col("__rows") > F.greatest(F.lit(window_rows), F.col("__need"))) & (F.col("__need") > 0)
        # One value of many rows: its ties are the range from now on.
        flat = open_cut & (F.col("__lo") == F.col("__hi")) & ~F.col("__by_tie")
        cuts = cuts.select(
            *group,
            "__rows",
            "__need",
            F.when(flat, F.col("__lo")).otherwise(F.col("__value")).alias("__value"),
            F.when(flat, lowest).otherwise(F.col("__lo")).alias("__lo"),
            F.when(flat, highest).otherwise(F.col("__hi")).alias("__hi"),
            (F.col("__by_tie") | flat).alias("__by_tie"),
        )
        wide = cuts.where(open_cut & (F.col("__lo") < F.col("__hi")))
        if not wide.take(1):
            break
        # A range that a long can't hold is cut in units of two.
        lo, hi, at = (F.when(F.col("__halved"), F.shiftright(c, 1)).otherwise(F.col(c)) for c in ("__lo", "__hi", "__at"))
        wide = wide.withColumn("__halved", F.shiftright("__hi", 1) - F.shiftright("__lo", 1) >= (1 << 61))
        step = F.floor((hi - lo) / SELECT_BUCKETS).cast("long") + 1
        inside = _join_null_safe(rows, wide, group).withColumn("__at", F.when(F.col("__by_tie"), F.col("__tie")).otherwise(F.col("__v")))
        inside = inside.where((~F.col("__by_tie") | (F.col("__v") == F.col("__value"))) & F.col("__at").between(F.col("__lo"), F.col("__hi")))
        counted = inside.groupBy(*group, F.floor((at - lo) / step).cast("long").alias("__step")).agg(
            F.count("*").alias("__c"), F.min("__at").alias("__first"), F.max("__at").alias("__last")
        )
        before = F.sum("__c").over(Window.partitionBy(*group).orderBy("__step").rowsBetween(Window.unboundedPreceding, -1))
        counted = _join_null_safe(counted.withColumn("__before", F.coalesce(before, F.lit(0))), wide.select(*group, "__need", "__value", "__by_tie"), group)
        hit = counted.where((F.col("__before") < F.col("__need")) & (F.col("__before") + F.col("__c") >= F.col("__need")))
        hit = hit.select(
            *group,
            F.col("__c").alias("__rows"),
            (F.col("__need") - F.col("__before")).alias("__need"),
            "__value",
            F.col("__first").alias("__lo"),
            F.col("__last").alias("__hi"),
            "__by_tie",
        )
        cuts = _kept(cuts.where(~(open_cut & (F.col("__lo") < F.col("__hi")))).unionByName(hit))
    at = F.when(F.col("__by_tie"), F.col("__tie")).otherwise(F.col("__v"))
    held = _join_null_safe(rows, cuts, group)
    same = ~F.col("__by_tie") | (F.col("__v") == F.col("__value"))
    sure = held.where((F.col("__by_tie") & (F.col("__v") < F.col("__value"))) | (same & (at < F.col("__lo"))) | (same & (at <= F.col("__hi")) & (F.col("__rows") <= F.col("__need"))))
    edge = held.where(same & at.between(F.col("__lo"), F.col("__hi")) & (F.col("__rows") > F.col("__need")))
    place = F.row_number().over(Window.partitionBy(*group).orderBy("__v", "__tie"))
    edge = edge.withColumn("__place", place).where(F.col("__place") <= F.col("__need"))
    return sure.select(*df.columns).unionByName(edge.select(*df.columns))


def _kept(small: DataFrame) -> DataFrame:
    """A small table, written, so that later steps read it and don't count again."""
    from tidemark.session import scratch_path

    path = scratch_path(small.sparkSession, "select")
    small.write.parquet(path)
    return small.sparkSession.read.parquet(path)
