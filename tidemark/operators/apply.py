"""Applying change batches to target tables.

Design notes (scale):

* Latest-per-key is an *aggregate* (``max`` of a struct whose leading fields are
  the ordering columns), not a ``row_number`` window.  The aggregate is split
  into a map-side partial and a final step, so a key that holds a third of all
  changes is collapsed to one row per map task before the shuffle; a window
  would drag every version of that key into one task.
* Apply is ``target LEFT ANTI JOIN changed_keys`` + ``UNION`` of the surviving
  latest rows.  The anti side carries only key columns, the latest rows are
  already hash-partitioned by key by the aggregate, and AQE splits skewed
  anti-join partitions of the target.
* Nothing is collected; a result is a plan.  Writing a new snapshot version is
  left to ``write_snapshot`` which writes a new folder and never rewrites the
  one being read.
"""

from __future__ import annotations

from functools import reduce
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELETE_OPS = ("d",)


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    Remaining columns break ties, so the choice is deterministic even when two
    versions share every ordering value.  Equivalent to
    ``row_number() OVER (PARTITION BY keys ORDER BY order DESC, rest DESC) = 1``.
    """
    keys = list(keys)
    # A key column is constant within its group: it cannot order the rows.
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.select(*_cols(keys)).distinct()
    packed = F.struct(*_cols(order + rest))
    return (
        df.groupBy(*_cols(keys))
        .agg(F.max(packed).alias("__latest"))
        .select(*_cols(keys), *[F.col(f"__latest.{c}").alias(c) for c in order + rest])
        .select(*df.columns)
    )


def _key_match(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k]
        cond = c if cond is None else cond & c
    return cond


def cast_like(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: same names, same order, explicit casts.

    Uses ``try_cast`` so a value the target type cannot hold becomes NULL rather
    than failing the batch (the caller routes such rows to the dead-letter table
    when it needs to know)."""
    out = []
    for field in schema.fields:
        if field.name in df.columns:
            out.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
        else:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*out)


def _overlay(target: DataFrame, changes: DataFrame, keys: Sequence[str], keep_change: Column, drop_row: Column) -> DataFrame:
    """One full outer join of target and (at most one) change per key: a row
    takes the change's values where ``keep_change`` holds, the target's
    otherwise, and is dropped where ``drop_row`` holds.  ``changes`` carries a
    ``__c`` marker column; target columns are projected onto the target
    schema."""
    t = target.select(*[F.col(c).alias(c if c in keys else f"__t_{c}") for c in target.columns])
    c = changes
    for k in keys:
        c = c.withColumnRenamed(k, f"__k_{k}")
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    j = t.withColumn("__t", F.lit(True)).join(c, same, "full_outer")
    out = []
    for f in target.schema.fields:
        if f.name in keys:
            out.append(F.when(F.col("__t"), F.col(f.name)).otherwise(F.col(f"__k_{f.name}")).alias(f.name))
            continue
        new = F.col(f.name).try_cast(f.dataType) if f.name in changes.columns else F.lit(None).cast(f.dataType)
        out.append(F.when(keep_change, new).otherwise(F.col(f"__t_{f.name}")).alias(f.name))
    return j.filter(~drop_row).select(*out)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """K1: replace target rows whose key occurs in ``batch`` by the batch rows.

    ``order`` deduplicates the batch first (latest wins).  Without it a key
    present twice in the batch is inserted twice (the delete-then-insert
    behaviour); pass ``order`` to force one row per key.  ``null_safe`` lets
    NULL key values match each other.
    """
    keys = list(keys)
    if order:
        batch = latest_per_key(batch, keys, order)
    batch = cast_like(batch, target.schema)
    changed = batch.select(*keys).distinct()
    if null_safe:
        kept = target.join(changed, _key_match(target, changed, keys, True), "left_anti")
    else:
        kept = target.join(changed, keys, "left_anti")
    return kept.unionByName(batch)


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    ts_col: str = "ts",
    seq_col: str = "seq",
    op_col: str = "op",
    target_ts_col: str | None = None,
    on_delete: str = "delete",
    unique_target: bool = True,
) -> DataFrame:
    """K3: deduplicating merge of a change batch into ``target``.

    Latest change per key (by ``ts_col`` then ``seq_col``) decides: a delete
    removes the key, anything else replaces or inserts the row.  Delete codes
    are compared case-insensitively.  With ``target_ts_col`` a change not
    newer than the target's stored timestamp is ignored (late, out-of-order
    data).  ``on_delete='upsert'`` reproduces the older behaviour where a
    delete writes its before-image instead of removing the row.

    Plan: one aggregate over the changes (partial, map-side) and one full
    outer join with the target -- the change log is read and shuffled once.
    That needs unique target keys (true for any target this merge maintains);
    ``unique_target=False`` uses anti join + union instead, which removes
    every target row of a changed key.
    """
    keys = list(keys)
    latest = latest_per_key(changes, keys, [ts_col, seq_col])
    # A change without an operation is an update (S2's default).
    deletes = F.coalesce(F.lower(F.col(op_col)), F.lit("u")).isin(*DELETE_OPS)
    if not unique_target:
        if target_ts_col is not None:
            stored = target.select(*keys, F.col(target_ts_col).alias("__stored_ts"))
            latest = latest.join(stored, keys, "left").filter(F.col("__stored_ts").isNull() | (F.col(ts_col) > F.col("__stored_ts"))).drop("__stored_ts")
        survivors = latest if on_delete == "upsert" else latest.filter(~deletes)
        kept = target.join(latest.select(*keys), keys, "left_anti")
        return kept.unionByName(cast_like(survivors, target.schema))
    renamed = latest.select(
        *keys,
        *[F.col(c) for c in latest.columns if c not in keys],
        F.lit(True).alias("__c"),
        deletes.alias("__del"),
        F.col(ts_col).alias("__cts"),
    )
    present = F.col("__c").isNotNull()
    if target_ts_col is not None:
        stored = F.col(f"__t_{target_ts_col}") if target_ts_col not in keys else F.col(target_ts_col)
        present = present & (stored.isNull() | (F.col("__cts") > stored))
    if on_delete == "upsert":
        drop = F.lit(False)
    else:
        drop = present & F.col("__del")
    return _overlay(target, renamed, keys, present, drop)


def landing_rows(df: DataFrame, op_col: str, batch_ts: str, ts_name: str = "SYNC_TIMESTAMP") -> DataFrame:
    """K2: the landing-table shape: upper-case source columns, an OPERATION
    column normalised to ``d``/``u``/``c`` (everything else is an insert), and
    the batch's sync timestamp."""
    op = F.lower(F.col(op_col))
    normalised = F.when(op == "d", "d").when(op == "u", "u").otherwise("c")
    data = [F.col(c).alias(c.upper()) for c in df.columns if c != op_col]
    return df.select(
        *data,
        normalised.alias("OPERATION"),
        F.lit(batch_ts).cast("timestamp_ntz").alias(ts_name),
    )


def append_landing(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K2 sink: append-only Parquet, optionally partitioned (e.g. by table)."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def drop_all_null_rows(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """K6: drop rows whose columns (other than ``ignore``) are all NULL."""
    subset = [c for c in df.columns if c not in set(ignore)]
    return df.na.drop(how="all", subset=subset)


def type_default(data_type: T.DataType) -> Column:
    """The value a NOT NULL column falls back to when no default is declared."""
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.lit(0).cast(data_type)
    if isinstance(data_type, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.lit(0).cast(data_type)
    if isinstance(data_type, T.BooleanType):
        return F.lit(False)
    if isinstance(data_type, T.StringType):
        return F.lit("")
    if isinstance(data_type, T.DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(data_type)
    return F.lit(None).cast(data_type)


def coalesce_defaults(df: DataFrame, not_null: dict[str, str | None]) -> DataFrame:
    """K4: for each NOT NULL column, replace NULL by its declared default literal
    when that literal parses as the column type, else by the type default."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        if c in not_null:
            dt = types[c]
            literal = not_null[c]
            fallback = type_default(dt)
            if literal is not None:
                fallback = F.coalesce(F.lit(literal).try_cast(dt), fallback)
            out.append(F.coalesce(F.col(c), fallback).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def json_size(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Bytes of one row serialised as a JSON line (record + newline)."""
    cols = list(columns or df.columns)
    return F.octet_length(F.to_json(F.struct(*_cols(cols)))) + F.lit(1)


def size_bounded_batches(
    df: DataFrame,
    order: Sequence[str],
    limit_bytes: int = 3_500_000,
    group: Sequence[str] | None = None,
    payload: Sequence[str] | None = None,
) -> DataFrame:
    """K7 (exact): greedy split of each partition, in ``order``, into request
    batches whose JSON payload stays within ``limit_bytes``.

    Without ``group`` it runs where the data already is: rows are sorted inside
    their partition (no shuffle) and a fold walks each partition once, carrying
    only the running byte count across Arrow batches.  Output adds ``part_id``,
    ``batch_no`` and ``row_bytes``; (``part_id``, ``batch_no``) identifies a
    request.  A single row larger than the limit forms its own batch.

    With ``group`` the packing restarts at every group (requests never mix
    groups); (group, ``batch_no``) identifies a request and the result does not
    depend on the physical partitioning.  Only the group, ``order`` and the row
    sizes are shuffled (rows are found again by ``order``), a group is split over
    as many tasks as it needs, and the jumps from request to request are doubled
    across them (``operators/runs.py``).
    """
    import numpy as np
    import pandas as pd

    from tidemark.operators import runs

    payload = list(payload or df.columns)
    if group:
        keys = list(dict.fromkeys([*group, *order]))
        sized = df.select(*keys, json_size(df, payload).cast("long").alias("row_bytes"))
        packed = runs.greedy_runs(sized, list(group), list(order), runs.Rule("sum", limit_bytes), "row_bytes", run="batch_no", place="__place")
        return packed.withColumn("batch_no", F.col("batch_no") - 1).drop("__place")
    sized = df.withColumn("row_bytes", json_size(df, payload)).withColumn("part_id", F.spark_partition_id())
    sized = sized.sortWithinPartitions(*order)
    out_schema = T.StructType(sized.schema.fields + [T.StructField("batch_no", T.LongType(), False)])

    def fold(batches):
        batch_no, used = 0, 0
        for pdf in batches:
            assigned, batch_no, used = _pack(pdf["row_bytes"].to_numpy(dtype="int64"), batch_no, used)
            pdf = pdf.copy()
            pdf["batch_no"] = pd.Series(assigned, index=pdf.index, dtype="int64")
            yield pdf

    def _pack(sizes, batch_no, used):
        n = len(sizes)
        assigned = np.empty(n, dtype="int64")
        # Jump from batch boundary to batch boundary: with prefix sums the
        # last row that still fits is one binary search away, so the Python
        # loop runs once per request batch, not once per row.
        csum = np.concatenate(([0], np.cumsum(sizes)))
        i = 0
        while i < n:
            room = limit_bytes - used
            j = int(np.searchsorted(csum, csum[i] + room, side="right")) - 1  # rows i..j-1 fit
            if j <= i:
                if used > 0:  # current batch is full: open a new one
                    batch_no += 1
                    used = 0
                    continue
                j = i + 1  # a single oversized row forms its own batch
            assigned[i:j] = batch_no
            used += int(csum[j] - csum[i])
            i = j
        return assigned, batch_no, used

    return sized.mapInPandas(fold, schema=out_schema)


def approx_size_batches(
    df: DataFrame, partition: Sequence[str], order: Sequence[str], limit_bytes: int, payload: Sequence[str] | None = None
) -> DataFrame:
    """K7 (approximate, SQL-expressible): ``floor(running_bytes / limit)`` within
    each ``partition`` group; batches may exceed the limit by one row.  The
    running sum is the distributed grouped prefix sum (a large group is not
    held in one task)."""
    from tidemark.operators.ordering import group_prefix_sum

    sized = df.withColumn("row_bytes", json_size(df, payload))
    run = group_prefix_sum(sized, partition, order, "row_bytes", "__prefix")
    return run.withColumn("batch_no", F.floor((F.col("__prefix") - F.col("row_bytes")) / F.lit(limit_bytes)).cast("long")).drop("__prefix")


def write_snapshot(df: DataFrame, base_path: str, version: int) -> str:
    """Write version ``version`` of a target as a new folder (``v=<n>``).

    Built-in file tables are not row-level mutable; a new version is written
    next to the old one and readers switch by version number, so a replayed
    batch rewrites the same version and nothing half-written is ever read."""
    path = f"{base_path.rstrip('/')}/v={version}"
    df.write.mode("overwrite").parquet(path)
    return path


class TargetMissing(Exception):
    """The target of a write does not exist (or lacks columns)."""


def guard_target(spark, target: str, needed_columns: Sequence[str] = (), columns_of=None) -> None:
    """K9: check the target before writing -- a catalog table name or a
    storage path must exist and carry the columns about to be written
    (``columns_of``: how to read them, if not as plain Parquet).  The caller
    routes the batch to the dead-letter table on failure."""
    jvm = spark.sparkContext._jvm
    if "/" in target or ":" in target:
        p = jvm.org.apache.hadoop.fs.Path(target)
        exists = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
        columns = (columns_of or (lambda: spark.read.parquet(target).columns))() if exists else []
    else:
        exists = spark.catalog.tableExists(target)
        columns = spark.table(target).columns if exists else []
    if not exists:
        raise TargetMissing(f"target {target} does not exist")
    missing = [c for c in needed_columns if c not in columns]
    if missing:
        raise TargetMissing(f"target {target} lacks columns {missing}")


def resolve_key(
    explicit: Sequence[str] | None = None,
    envelope_key: Sequence[str] | None = None,
    target_key: Sequence[str] | None = None,
    columns: Sequence[str] = (),
) -> list[str]:
    """The key to apply by: explicit configuration, else the change
    envelope's key fields, else the target's primary key, else a column named
    ``id`` (or a single ``*_id`` column); otherwise an error -- never "the
    first column"."""
    for candidate in (explicit, envelope_key, target_key):
        if candidate:
            return list(candidate)
    if "id" in columns:
        return ["id"]
    ids = [c for c in columns if c.endswith("_id")]
    if len(ids) == 1:
        return ids
    raise ValueError("no key: configure one explicitly")


def merge_into_statement(
    target: str,
    source_view: str,
    keys: Sequence[str],
    columns: Sequence[str],
    op_col: str = "op",
    null_safe: bool = False,
    ts_col: str | None = None,
    target_ts_col: str | None = None,
) -> str:
    """K3 as Spark SQL ``MERGE INTO`` (for targets that support row-level
    operations): deletes remove, other changes (a change without an operation is an
    update) update or insert.  With ``target_ts_col`` a change that is not newer
    than the stored row is left out.  A table of keys only has nothing to update.
    The source view must already hold one row per key."""
    eq = "<=>" if null_safe else "="
    on = " AND ".join(f"t.`{k}` {eq} s.`{k}`" for k in keys)
    sets = ", ".join(f"`{c}` = s.`{c}`" for c in columns if c not in keys)
    cols = ", ".join(f"`{c}`" for c in columns)
    vals = ", ".join(f"s.`{c}`" for c in columns)
    deletes = f"coalesce(lower(s.`{op_col}`), 'u') = 'd'"
    newer = f" AND (t.`{target_ts_col}` IS NULL OR s.`{ts_col}` > t.`{target_ts_col}`)" if target_ts_col else ""
    clauses = [f"MERGE INTO {target} AS t USING {source_view} AS s ON {on}", f"WHEN MATCHED AND {deletes}{newer} THEN DELETE"]
    if sets:
        clauses.append(f"WHEN MATCHED{newer} THEN UPDATE SET {sets}")
    clauses.append(f"WHEN NOT MATCHED AND NOT ({deletes}) THEN INSERT ({cols}) VALUES ({vals})")
    return " ".join(clauses)


def merge_into(
    spark,
    target: str,
    changes: DataFrame,
    keys: Sequence[str],
    ts_col: str = "ts",
    seq_col: str = "seq",
    op_col: str = "op",
    columns: Sequence[str] | None = None,
    target_ts_col: str | None = None,
) -> bool:
    """Apply a change batch with ``MERGE INTO`` when the target table supports
    it; returns False (nothing written) when it does not, e.g. a plain
    Parquet table or view, in which case the caller uses ``apply_changes``,
    which gives the same rows.  The source is reduced to the latest change per
    key by the aggregate form of ``latest_per_key`` (no per-key window)."""
    from pyspark.errors import PySparkException

    latest = latest_per_key(changes, keys, [ts_col, seq_col])
    view = f"__merge_src_{abs(hash((target, tuple(keys)))) % 10**8}"
    latest.createOrReplaceTempView(view)
    cols = list(columns or [c for c in latest.columns if c not in (ts_col, seq_col, op_col) or c == target_ts_col])
    try:
        spark.sql(merge_into_statement(target, view, keys, cols, op_col, ts_col=ts_col, target_ts_col=target_ts_col)).collect()
        return True
    except PySparkException as e:
        # The target's format has no row-level operations.
        if "MERGE" in str(e).upper() and "SUPPORT" in str(e).upper():
            return False
        raise
