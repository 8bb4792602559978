"""SQL transform, lookups and set-style joins.

Lookups are plain DataFrame joins: Catalyst picks the strategy and AQE turns a
sort-merge join into a broadcast join when the lookup side is measured small
at runtime, by bytes; no size is guessed or counted here.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ordering as O

ALIAS_CLEAN = "[^a-z0-9_]"


def alias_name(name: str) -> str:
    """Catalog-safe name: lower case, anything outside [a-z0-9_] becomes '_'."""
    return re.sub(ALIAS_CLEAN, "_", name.lower())


def alias_column(name: Column, prefix: str = "") -> Column:
    """S8 as a column expression (for catalogs of names)."""
    return F.concat(F.lit(prefix), F.regexp_replace(F.lower(name), ALIAS_CLEAN, "_"))


def source_alias(name: str) -> str:
    return "pg_src_" + alias_name(name)


def destination_alias(name: str) -> str:
    return "pg_" + alias_name(name)


def run_transform(
    spark: SparkSession,
    batch: DataFrame,
    table_name: str,
    sql: str | None,
    side_inputs: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Run the branch's SQL over the batch, bound as a view named after the
    source table; side inputs are bound under their alias names.  No SQL means
    the batch passes through unchanged.  Binding is by view name -- the SQL
    text is never rewritten."""
    if not sql or not sql.strip():
        return batch
    # Bind and run in the batch's own session: inside ``foreachBatch`` that is
    # the streaming query's session, whose temp views the caller cannot see.
    session = batch.sparkSession
    batch.createOrReplaceTempView(table_name)
    for name, df in (side_inputs or {}).items():
        if df.sparkSession._jsparkSession.equals(session._jsparkSession):
            df.createOrReplaceTempView(name)
        else:
            df.createOrReplaceGlobalTempView(name)
            session.sql(f"CREATE OR REPLACE TEMP VIEW `{name}` AS SELECT * FROM global_temp.`{name}`")
    return session.sql(sql)


def lookup(
    batch: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | Column,
    how: str = "left",
) -> DataFrame:
    """Enrich a batch with a lookup table (broadcast or shuffled by its
    size in bytes, as Spark measures it)."""
    return batch.join(dim, on, how)


def key_semi(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key tuple occurs in ``keys`` (``(a, b) IN (SELECT ...)``)."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def key_anti(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key tuple does not occur in ``keys``."""
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")


def cooccurrence_edges(links: DataFrame, group: str, item: str, rows_per_task: int = 1000) -> DataFrame:
    """Pairs of items (a < b) sharing a group, with the number of groups
    they share.  Links with a NULL group or item pair with nothing.

    Distinct (group, item) links are joined with themselves on the group.  A
    group of n items is dealt over n / ``rows_per_task`` salts on one side and
    repeated under each salt on the other, so the pairs of a large group are
    made by many tasks and none holds a group in a row; pairs are pre-added
    before their shuffle."""
    one = links.select(F.col(group).alias("__g"), F.col(item).alias("__i")).dropna().distinct()
    sizes = one.groupBy("__g").agg((F.count("*") / F.lit(rows_per_task)).cast("int").alias("__last_salt"))
    sized = one.join(sizes, "__g")
    left = sized.select("__g", F.pmod(F.xxhash64("__i"), F.col("__last_salt") + 1).cast("int").alias("__salt"), F.col("__i").alias("source"))
    right = sized.select("__g", F.explode(F.sequence(F.lit(0), F.col("__last_salt"))).alias("__salt"), F.col("__i").alias("target"))
    pairs = left.join(right, ["__g", "__salt"]).filter(F.col("source") < F.col("target"))
    return pairs.groupBy("source", "target").agg(F.count("*").alias("shared_groups"))


def window_enriched(tx: DataFrame, emp: DataFrame) -> DataFrame:
    """Each transaction with its employee's total and maximum
    sale, the department's average, the employee's distinct categories and
    the sale's rank in the department.

    Inputs: ``tx(transaction_id, employee_id, amount, category)`` and
    ``emp(employee_id, employee_name, department)``.  Whole-partition window
    aggregates become grouped aggregates joined back (partial aggregation,
    no group held in one task); the department rank uses ``group_rank``."""
    # Per-employee figures need only the transactions; the department average
    # is rolled up from per-employee partial sums joined to the (smaller)
    # employee table.  The transaction x employee join happens once, for the
    # rank, instead of once per aggregate.
    per_emp = tx.groupBy("employee_id").agg(
        F.sum("amount").alias("staff_total"),
        F.max("amount").alias("staff_best"),
        F.count("amount").alias("__n"),
    )
    cats = tx.select("employee_id", "category").distinct().groupBy("employee_id").agg(
        F.count("category").alias("staff_kinds")
    )
    per_dept = (
        per_emp.join(emp.select("employee_id", "department"), "employee_id")
        .groupBy("department")
        .agg((F.sum("staff_total") / F.sum("__n")).alias("dept_avg"))
    )
    per_emp = per_emp.drop("__n")
    t = tx.join(emp, "employee_id")
    ranked = O.group_rank(t.select("transaction_id", "employee_id", "employee_name", "department", "amount"), ["department"], "amount", True, "group_place")
    return (
        ranked.join(per_emp, "employee_id")
        .join(cats, "employee_id", "left")
        .join(per_dept.withColumnRenamed("department", "__dept"), F.col("department").eqNullSafe(F.col("__dept")))
        .select(
            "transaction_id",
            "employee_name",
            F.col("amount").alias("price"),
            "staff_total",
            (F.col("amount") == F.col("staff_best")).alias("is_staff_best"),
            F.round("dept_avg", 2).alias("group_mean"),
            F.coalesce("staff_kinds", F.lit(0)).cast("long").alias("staff_kinds"),
            "group_place",
        )
    )


def fanout(events: DataFrame, branches: DataFrame, on: str = "table_name") -> DataFrame:
    """Route each event to every branch configured for its table."""
    return events.join(branches, on, "inner")


def unused(items: DataFrame, links: DataFrame, on: str) -> DataFrame:
    """Items no link refers to any more."""
    return items.join(links.select(on).distinct(), on, "left_anti")


def aggregate_upsert(
    spark: SparkSession,
    target: DataFrame,
    batch: DataFrame,
    history: DataFrame | None,
    table_name: str,
    sql: str,
    keys: Sequence[str],
    scope: str = "batch",
) -> DataFrame:
    """A branch whose SQL aggregates rows, upserted by the target
    key.  ``scope='batch'`` aggregates only the new batch (its result replaces
    the key's row); ``scope='full'`` recomputes the affected keys over the
    whole history (``history`` already including the batch), so the stored
    aggregate stays the aggregate of everything seen."""
    from tidemark.operators.apply import upsert

    keys = list(keys)
    if scope == "batch":
        return upsert(target, run_transform(spark, batch, table_name, sql), keys)
    if scope != "full":
        raise ValueError("scope must be 'batch' or 'full'")
    affected = batch.select(*keys).distinct()
    rows = history.join(affected, keys, "left_semi")
    return upsert(target, run_transform(spark, rows, table_name, sql), keys)
