"""Change logs and monitoring tables derived from the driver tables.

The driver tables hold no change log, so the queries derive one with Spark
expressions over the whole input tables (every row is used; nothing is
sampled).  ``plans/registry.py`` holds the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import apply
from tidemark.session import prepare
from tidemark.sources.tables import read_table

# Fixed values of the derived inputs (shared with the SQL twins).
SNAPSHOT_CUTOFF = "1998-01-01"  # orders before this date form the initial target
TODAY = "2024-01-30"  # "today" of the monitoring tables: the last day of events
EVENT_TABLES = 10  # events are spread over this many source tables by user id


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    prepare(spark)
    return [read_table(spark, sf_dir, n) for n in names]


def event_op() -> F.Column:
    et = F.col("event_type")
    return F.when(et == "error", "d").when(et == "signup", "c").otherwise("u")


def chg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log keyed by user: ``error`` events delete, ``signup`` inserts,
    everything else updates; ``event_id`` orders changes with equal ``ts``."""
    (ev,) = tables(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("k"),
        F.col("event_id").alias("seq"),
        "ts",
        event_op().alias("op"),
        "event_type",
        "value",
        "props",
    )


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def chg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log keyed by order: an insert per order at its order date, an
    update (price + 100) a day later for open orders, a delete two days later
    for low-priority orders."""
    (o,) = tables(spark, sf_dir, "orders")
    base = o.select(*ORDER_COLUMNS)
    v1 = base.select(*ORDER_COLUMNS, F.lit("c").alias("op"), F.lit(1).alias("seq"), F.col("o_orderdate").alias("ts"))
    v2 = base.filter(F.col("o_orderstatus") == "O").select(
        *[(F.col(c) + F.lit(100.0)).alias(c) if c == "o_totalprice" else F.col(c) for c in ORDER_COLUMNS],
        F.lit("u").alias("op"),
        F.lit(2).alias("seq"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("ts"),
    )
    v3 = base.filter(F.col("o_orderpriority") == "5-LOW").select(
        *ORDER_COLUMNS,
        F.lit("d").alias("op"),
        F.lit(3).alias("seq"),
        (F.col("o_orderdate") + F.expr("INTERVAL 2 DAY")).alias("ts"),
    )
    return v1.unionByName(v2).unionByName(v3)


def orders_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The initial target: orders as of the snapshot cutoff."""
    (o,) = tables(spark, sf_dir, "orders")
    return o.select(*ORDER_COLUMNS).filter(F.col("o_orderdate") < F.lit(SNAPSHOT_CUTOFF).cast("timestamp_ntz"))


def orders_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target at the cutoff: every earlier change applied."""
    early = chg_orders(spark, sf_dir).filter(F.col("ts") < F.lit(SNAPSHOT_CUTOFF).cast("timestamp_ntz"))
    return apply.latest_per_key(early, ["o_orderkey"], ["ts", "seq"]).filter(F.col("op") != "d").select(*ORDER_COLUMNS)


def orders_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes since the snapshot cutoff."""
    return chg_orders(spark, sf_dir).filter(F.col("ts") >= F.lit(SNAPSHOT_CUTOFF).cast("timestamp_ntz"))


def volume_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Throughput log: one record per event, pipeline = event type, source
    table = ``tbl_<user_id % 10>``, destination = user parity."""
    (ev,) = tables(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("log_id"),
        F.col("event_type").alias("pipeline_name"),
        F.concat(F.lit("tbl_"), (F.col("user_id") % EVENT_TABLES).cast("string")).alias("table_name"),
        F.when(F.col("user_id") % 2 == 0, F.lit("dest_even")).otherwise(F.lit("dest_odd")).alias("destination_name"),
        F.lit(1).cast("long").alias("record_count"),
        F.col("ts").alias("created_at"),
    )


def dlq_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters: every change, as failed, with a retry count and the first
    failure time; the queue is (source, table, destination)."""
    ch = chg_events(spark, sf_dir)
    return ch.select(
        F.col("seq").alias("msg_id"),
        F.lit(1).alias("source_id"),
        F.concat(
            F.when(F.col("k") % 2 == 0, F.lit("public.tbl_")).otherwise(F.lit("tbl_")), (F.col("k") % EVENT_TABLES).cast("string")
        ).alias("table_name"),
        (F.col("k") % 3 + 1).cast("int").alias("destination_id"),
        "k",
        "op",
        "value",
        (F.col("seq") % 12).cast("int").alias("retry_count"),
        F.col("ts").alias("first_failed_at"),
    )


def tag_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags on branches: every word of a part type is a tag of branch
    ``p_partkey % 50``."""
    (p,) = tables(spark, sf_dir, "part")
    words = p.select(
        (F.col("p_partkey") % 50).cast("long").alias("sync_id"),
        F.explode(F.split(F.lower(F.col("p_type")), " ")).alias("tag"),
    )
    return words.distinct()


def tag_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All known tags: words of part names and part types (the type words are
    the ones in use, name words mostly are not)."""
    (p,) = tables(spark, sf_dir, "part")
    name_words = p.select(F.explode(F.split(F.lower(F.col("p_name")), " ")).alias("tag"))
    type_words = p.select(F.explode(F.split(F.lower(F.col("p_type")), " ")).alias("tag"))
    return name_words.unionByName(type_words).distinct()


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table-sync branches: one per tagged sync id, with its pipeline,
    destination and source table."""
    syncs = tag_links(spark, sf_dir).select("sync_id").distinct()
    return syncs.select(
        "sync_id",
        (F.col("sync_id") % 5).alias("pipeline_id"),
        F.concat(F.lit("pipeline_"), (F.col("sync_id") % 5).cast("string")).alias("pipeline_name"),
        (F.col("sync_id") % 3 + 1).alias("destination_id"),
        F.concat(F.lit("dest_"), (F.col("sync_id") % 3 + 1).cast("string")).alias("destination_name"),
        F.concat(F.lit("tbl_"), (F.col("sync_id") % EVENT_TABLES).cast("string")).alias("table_name"),
    )
