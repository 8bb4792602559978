"""Monitoring aggregates, listings and alert-table rewrites (A1-A8, A14,
T1-T6, U3, M1-M5, M8-M10).

Everything is a grouped aggregate, a filter or a small top-k over tables
that grow with the pipelines' history; "today" and "now" are arguments, never
the wall clock, so results are reproducible.  Pivots take their value lists
from the caller when known (no extra distinct job), else Spark computes them
-- the list is the set of pipeline / destination / source names, i.e. config
cardinality.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# Fixed values (thresholds and limits of the monitors).
WAL_WARNING_MB = 3000
WAL_ERROR_MB = 6000
LAG_WARNING_BYTES = 1 * 1024**3
LAG_ERROR_BYTES = 5 * 1024**3
COST_RETENTION_DAYS = 60
ALERT_RETENTION_DAYS = 30
UNIT_FACTORS_MB = {"TB": 1024.0 * 1024.0, "GB": 1024.0, "MB": 1.0, "kB": 1.0 / 1024, "bytes": 1.0 / (1024 * 1024), "B": 1.0 / (1024 * 1024)}


def status_summary(df: DataFrame, status_col: str, known: Sequence[str]) -> DataFrame:
    """A1: count per status, known statuses present with 0, plus a ``total``
    row.  The known list is a literal table; the counts are one aggregate."""
    spark = df.sparkSession
    counts = df.groupBy(F.col(status_col).alias("status")).agg(F.count("*").alias("n"))
    known_df = spark.createDataFrame([(s,) for s in known], "status string")
    filled = known_df.join(counts, "status", "full_outer").select("status", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    total = filled.agg(F.sum("n").cast("long").alias("n")).select(F.lit("total").alias("status"), "n")
    return filled.unionByName(total)


def day_totals(df: DataFrame, ts_col: str, value_col: str, today: str) -> DataFrame:
    """A2: totals of today and yesterday in one pass."""
    d = F.to_date(F.col(ts_col))
    t = F.lit(today).cast("date")
    return df.filter((d == t) | (d == F.date_sub(t, 1))).agg(
        F.coalesce(F.sum(F.when(d == t, F.col(value_col))), F.lit(0)).cast("long").alias("total_today"),
        F.coalesce(F.sum(F.when(d == F.date_sub(t, 1), F.col(value_col))), F.lit(0)).cast("long").alias("total_yesterday"),
    )


def date_spine(spark: SparkSession, start: str, days: int) -> DataFrame:
    """``days + 1`` consecutive dates from ``start``."""
    return spark.range(days + 1).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("day"))


OTHER = "other"
MAX_NAMES = 50


def pivot_names(df: DataFrame, name_col: str, value_col: str, max_names: int = MAX_NAMES) -> list[str]:
    """The columns of an open pivot: the names that the data holds, alphabetically.
    Of more than ``max_names`` the largest by summed size (ties by name) have columns
    and the rest share one named ``other``.  One aggregate; at most ``max_names`` + 1
    rows reach the driver.  A NULL name is in ``other``."""
    sums = df.groupBy(name_col).agg(F.sum(F.abs(value_col)).alias("__s"))
    known = sums.filter(F.col(name_col).isNotNull() & (F.col(name_col) != OTHER))
    rows = known.orderBy(F.col("__s").desc_nulls_last(), F.col(name_col)).limit(max_names + 1).collect()
    names = sorted(r[name_col] for r in rows[:max_names])
    rest = len(rows) > max_names or bool(sums.filter(F.col(name_col).isNull() | (F.col(name_col) == OTHER)).take(1))
    return names + [OTHER] * rest


def _named(name_col: str, names: Sequence[str]) -> Column:
    plain = [n for n in names if n != OTHER]
    return F.when(F.col(name_col).isin(plain), F.col(name_col)).otherwise(OTHER) if OTHER in names else F.col(name_col)


def daily_pivot(
    df: DataFrame,
    ts_col: str,
    name_col: str,
    value_col: str,
    start: str,
    days: int,
    names: Sequence[str] | None = None,
    agg: str = "sum",
) -> DataFrame:
    """A3/A4: per day and name, pivoted to one column per name, with every day
    of the range present and missing cells 0.  Without ``names`` there is a column
    for whatever the range holds (``pivot_names``)."""
    spark = df.sparkSession
    d = F.to_date(F.col(ts_col))
    ranged = df.filter(d >= F.lit(start).cast("date")).withColumn("day", d)
    names = list(names) if names is not None else pivot_names(ranged, name_col, value_col)
    spine = date_spine(spark, start, days)
    if not names:
        return spine
    pivoted = ranged.withColumn("__name", _named(name_col, names)).groupBy("day").pivot("__name", names)
    pivoted = pivoted.agg(F.sum(value_col)) if agg == "sum" else pivoted.agg(F.avg(value_col))
    return spine.join(pivoted, "day", "left").fillna(0)


def hourly_avg_pivot(df: DataFrame, ts_col: str, name_col: str, value_col: str, since: str, names: Sequence[str] | None = None) -> DataFrame:
    """A5: hourly mean per name, pivoted; hours without data are absent.  Without
    ``names`` there is a column for whatever the range holds (``pivot_names``)."""
    ranged = df.filter(F.col(ts_col) >= F.lit(since).cast("timestamp_ntz")).withColumn("hour", F.date_trunc("hour", F.col(ts_col)).cast("timestamp_ntz"))
    names = list(names) if names is not None else pivot_names(ranged, name_col, value_col)
    if not names:
        return ranged.select("hour").distinct()
    return ranged.withColumn("__name", _named(name_col, names)).groupBy("hour").pivot("__name", names).agg(F.avg(value_col))


def unhealthy(tables: DataFrame, writes: DataFrame, now: str, ok: Column, minutes: int = 60) -> DataFrame:
    """Of all ``tables``, those whose last successful write is older than
    ``minutes``, or that never had one."""
    last = writes.groupBy("table_name").agg(F.max(F.when(ok, F.col("created_at"))).alias("last_seen"))
    cutoff = F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    seen = tables.select("table_name").distinct().join(last, "table_name", "left")
    return seen.filter(F.col("last_seen").isNull() | (F.col("last_seen") < cutoff))


def calendar_compare(df: DataFrame, ts_col: str, value_col: str, today: str) -> DataFrame:
    """This week / previous week (weeks start Monday) and this month /
    previous month totals in one pass."""
    d = F.to_date(F.col(ts_col))
    t = F.lit(today).cast("date")
    week = F.date_trunc("week", t).cast("date")
    month = F.trunc(t, "month")
    prev_week = F.date_sub(week, 7)
    prev_month = F.add_months(month, -1)

    def s(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col(value_col))), F.lit(0.0))

    return df.filter(d >= prev_month).agg(
        F.round(s((d >= week) & (d <= t)), 6).alias("this_week"),
        F.round(s((d >= prev_week) & (d < week)), 6).alias("previous_week"),
        F.round(s((d >= month) & (d <= t)), 6).alias("this_month"),
        F.round(s((d >= prev_month) & (d < month)), 6).alias("previous_month"),
    )


def top_n(df: DataFrame, group_col: str, value_col: str, n: int, name: str = "total") -> DataFrame:
    """The ``n`` largest groups by summed value (ties by name) -- a
    distributed TakeOrdered over the aggregate."""
    return (
        df.groupBy(group_col)
        .agg(F.sum(value_col).alias(name))
        .orderBy(F.col(name).desc(), F.col(group_col).asc())
        .limit(n)
    )


def page_newest(df: DataFrame, ts_col: str, id_col: str, offset: int, limit: int, where: Column | None = None) -> DataFrame:
    """A page of the newest rows (newest first, ties by id)."""
    if where is not None:
        df = df.filter(where)
    return df.orderBy(F.col(ts_col).desc(), F.col(id_col).desc()).offset(offset).limit(limit)


def size_text_to_mb(text: Column) -> Column:
    """M1: '640 MB' / '1.5 GB' / '12 kB' / '300 bytes' / '2 TB' -> MB
    (every unit counted; unparsable text -> 0)."""
    t = F.trim(text)
    number = F.regexp_extract(t, r"^([0-9]+(?:\.[0-9]+)?)\s*", 1).try_cast("double")
    unit = F.regexp_extract(t, r"^[0-9.]+\s*([A-Za-z]+)$", 1)
    factor = F.lit(None).cast("double")
    for u, f in UNIT_FACTORS_MB.items():
        factor = F.when(unit == u, F.lit(f)).otherwise(factor)
    return F.coalesce(number * factor, F.lit(0.0))


def wal_threshold_label(mb: Column, warning: float = WAL_WARNING_MB, error: float = WAL_ERROR_MB) -> Column:
    return F.when(mb >= error, "ERROR").when(mb >= warning, "WARNING")


def lag_class(size_bytes: Column) -> Column:
    """M2: replication-lag class."""
    return F.when(size_bytes > LAG_ERROR_BYTES, "ERROR").when(size_bytes > LAG_WARNING_BYTES, "WARNING").otherwise("OK")


def retention(df: DataFrame, ts_col: str, now: str, days: int) -> DataFrame:
    """M4: keep rows newer than ``now - days``."""
    cutoff = F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    return df.filter(F.col(ts_col) >= cutoff)


def prune_days(spark: SparkSession, path: str, day_col: str, ts_col: str, cutoff: str) -> dict:
    """M4 on a table laid out by day (``<path>/<day_col>=yyyy-MM-dd``): days before
    the cutoff's are dropped as whole folders, only the cutoff's own day is written
    anew (by dynamic partition overwrite, from a copy of what stays), later days keep
    their files.  Rows without a day stay.  Returns what was done: the folders
    dropped, and whether the boundary day was rewritten."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    boundary = cutoff[:10]
    days = [st.getPath() for st in fs.listStatus(root) if st.isDirectory() and st.getPath().getName().startswith(f"{day_col}=")]
    dropped, rewritten = [], False
    for p in days:
        day = p.getName()[len(day_col) + 1 :]
        if day == boundary:
            rows = spark.read.parquet(p.toString())
            at = F.lit(cutoff).cast("timestamp_ntz")
            if rows.filter(F.col(ts_col) < at).limit(1).count():
                kept = scratch_path(spark, "retention")
                rows.filter((F.col(ts_col) >= at) | F.col(ts_col).isNull()).write.parquet(kept)
                staged = spark.read.schema(rows.schema).parquet(kept).withColumn(day_col, F.lit(day))
                staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day_col).parquet(path)
                rewritten = True
                if not staged.limit(1).count():  # an empty overwrite leaves the old files
                    fs.delete(p, True)
        elif day < boundary and day[:1].isdigit():
            fs.delete(p, True)
            dropped.append(day)
    return {"dropped": sorted(dropped), "rewritten": rewritten}


def pending_alerts(df: DataFrame, limit: int) -> DataFrame:
    """M5: alerts due for delivery: enough repeats or forced, and not yet
    sent, deleted or read."""
    due = (F.col("iteration_check") >= limit) | F.col("is_force_sent")
    return df.filter(due & ~F.col("is_sent") & ~F.col("is_deleted") & ~F.col("is_read"))


def bulk_flag(df: DataFrame, flag: str, where: Column) -> DataFrame:
    """M8: set ``flag`` on every row matching ``where`` (e.g. mark all active
    alerts read) -- a full-table rewrite, the table-format equivalent of
    ``UPDATE ... SET flag = true WHERE ...``."""
    return df.withColumn(flag, F.when(where, F.lit(True)).otherwise(F.col(flag)))


def latest_state(df: DataFrame, keys: Sequence[str], ts_col: str, value_cols: Sequence[str]) -> DataFrame:
    """Latest value(s) per key via ``max_by`` (a partial aggregate)."""
    packed = F.struct(*[F.col(c) for c in value_cols])
    return df.groupBy(*keys).agg(F.max(ts_col).alias(ts_col), F.max_by(packed, F.struct(F.col(ts_col), *[F.col(c) for c in value_cols])).alias("__v")).select(
        *keys, ts_col, *[F.col(f"__v.{c}").alias(c) for c in value_cols]
    )


def running_total(df: DataFrame, order_col: str, value_col: str, name: str) -> DataFrame:
    """Running total over a small, already aggregated series (e.g. days)."""
    w = Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(value_col).over(w))
