"""Queries for SQL transforms, joins and tags: S8, J1-J15, W2-W4, A9-A11, A16."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import apply as A
from tidemark.operators import joins as J
from tidemark.operators import ordering as O
from tidemark.plans import derived as D
from tidemark.plans.registry import BRANCHES, CHG_EVENTS, CHG_ORDERS, TAG_LINKS, TAG_LIST, query, with_ctes


@query(
    "side_input_alias",
    """
SELECT n_name AS name,
       'pg_src_' || regexp_replace(lower(n_name), '[^a-z0-9_]', '_', 'g') AS source_alias,
       'pg_' || regexp_replace(lower(n_name), '[^a-z0-9_]', '_', 'g') AS destination_alias
FROM (SELECT n_name FROM nation UNION SELECT p_brand FROM part UNION SELECT c_mktsegment FROM customer)
""",
)
def side_input_alias(spark, sf_dir):
    """Catalog-safe alias names of side-input databases."""
    n, p, c = D.tables(spark, sf_dir, "nation", "part", "customer")
    names = n.select(F.col("n_name").alias("name")).union(p.select("p_brand")).union(c.select("c_mktsegment")).distinct()
    return names.select(
        "name",
        J.alias_column(F.col("name"), "pg_src_").alias("source_alias"),
        J.alias_column(F.col("name"), "pg_").alias("destination_alias"),
    )


_USER_SQL = """
SELECT e.user_id, e.event_type, count(*) AS n, round(sum(e.value), 2) AS total, max(c.c_mktsegment) AS segment
FROM tbl_events e
LEFT JOIN pg_src_shop_customer c ON c.c_custkey = e.user_id
WHERE e.value > 0
GROUP BY e.user_id, e.event_type
"""


@query(
    "transform_sql",
    """
SELECT e.user_id, e.event_type, count(*) AS n, round(sum(e.value), 2) AS total, max(c.c_mktsegment) AS segment
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
WHERE e.value > 0
GROUP BY e.user_id, e.event_type
""",
)
def transform_sql(spark, sf_dir):
    """User SQL over the batch (bound as ``tbl_events``) and a side input
    (bound as ``pg_src_shop_customer``)."""
    ev, cust = D.tables(spark, sf_dir, "events", "customer")
    return J.run_transform(spark, ev, "tbl_events", _USER_SQL, {J.source_alias("shop.customer"): cust})


@query("transform_passthrough", with_ctes(CHG_EVENTS) + "SELECT * FROM chg_events")
def transform_passthrough(spark, sf_dir):
    """A branch without SQL passes the batch through unchanged."""
    return J.run_transform(spark, D.chg_events(spark, sf_dir), "tbl_events", None)


@query(
    "enrich_inner",
    """
SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""",
)
def enrich_inner(spark, sf_dir):
    """Batch inner-joined to a source lookup table."""
    o, c = D.tables(spark, sf_dir, "orders", "customer")
    return J.lookup(o.select("o_orderkey", "o_custkey", "o_totalprice"), c.select("c_custkey", "c_name", "c_mktsegment"), o["o_custkey"] == c["c_custkey"], "inner").select(
        "o_orderkey", "o_totalprice", "c_name", "c_mktsegment"
    )


@query(
    "enrich_left",
    """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, s.s_name, s.s_nationkey
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
""",
)
def enrich_left(spark, sf_dir):
    """Left join to one lookup (the supplier table is tiny: its broadcast
    is issued only after a bounded row count proves it)."""
    li, s = D.tables(spark, sf_dir, "lineitem", "supplier")
    side = s.select("s_suppkey", "s_name", "s_nationkey")
    return J.lookup(li.select("l_orderkey", "l_linenumber", "l_suppkey"), side, li["l_suppkey"] == side["s_suppkey"], "left").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "s_name", "s_nationkey"
    )


@query(
    "enrich_multi_dim",
    """
SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice,
       p.p_name, p.p_brand, s.s_name, n.n_name, r.r_name, c.c_mktsegment
FROM lineitem l
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
WHERE l.l_extendedprice > 0 AND l.l_quantity > 5
""",
)
def enrich_multi_dim(spark, sf_dir):
    """Chained left joins to several dimensions (two of which -- orders,
    customer -- grow with the data and are joined by shuffle) plus a WHERE on
    the batch that Catalyst pushes into the scan."""
    li, p, s, n, r, o, c = D.tables(spark, sf_dir, "lineitem", "part", "supplier", "nation", "region", "orders", "customer")
    b = li.filter((F.col("l_extendedprice") > 0) & (F.col("l_quantity") > 5)).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey"
    )
    out = (
        b.join(p.select("p_partkey", "p_name", "p_brand"), b["l_partkey"] == p["p_partkey"], "left")
        .join(s.select("s_suppkey", "s_name", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(n.select("n_nationkey", "n_name", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(r.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(c.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"), "left")
    )
    return out.select("l_orderkey", "l_linenumber", "l_extendedprice", "p_name", "p_brand", "s_name", "n_name", "r_name", "c_mktsegment")


@query(
    "history_balance",
    """
WITH days AS (
  SELECT o_custkey, o_orderdate, sum(o_totalprice) AS day_total, count(*) AS day_count FROM orders GROUP BY ALL),
running AS (
  SELECT *, coalesce(sum(day_total) OVER earlier, 0) AS before_total, coalesce(sum(day_count) OVER earlier, 0) AS before_count
  FROM days
  WINDOW earlier AS (PARTITION BY o_custkey ORDER BY o_orderdate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS ordered_at, o_totalprice AS price,
       round(before_total, 2) AS spent_before, round(before_total + o_totalprice, 2) AS spent_with,
       CAST(before_count AS BIGINT) AS orders_before
FROM orders JOIN running USING (o_custkey, o_orderdate)
""",
)
def history_balance(spark, sf_dir):
    """Per order, the sum and count of the same customer's earlier orders
    (strictly earlier date) -- computed as a two-level prefix sum (per day, then
    within the day) instead of a correlated subquery."""
    (o,) = D.tables(spark, sf_dir, "orders")
    t = o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("ordered_at"),
        F.col("o_totalprice").alias("price"),
    )
    with_prior = O.prior_sum(t, ["customer_id"], "ordered_at", "price", F.date_trunc("day", "ordered_at"), "prev", "orders_before")
    prev = F.coalesce(F.col("prev"), F.lit(0.0))
    return with_prior.select(
        "order_id",
        "customer_id",
        "ordered_at",
        "price",
        F.round(prev, 2).alias("spent_before"),
        F.round(prev + F.col("price"), 2).alias("spent_with"),
        F.coalesce(F.col("orders_before"), F.lit(0)).cast("long").alias("orders_before"),
    )


@query(
    "window_enriched",
    """
WITH per_customer AS (
  SELECT o_custkey, sum(o_totalprice) AS total, max(o_totalprice) AS best, count(DISTINCT o_orderpriority) AS kinds
  FROM orders GROUP BY o_custkey),
per_segment AS (
  SELECT c_mktsegment, avg(o_totalprice) AS mean FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_mktsegment),
places AS (
  SELECT o_orderkey, rank() OVER (PARTITION BY c_mktsegment ORDER BY o_totalprice DESC) AS place
  FROM customer JOIN orders ON o_custkey = c_custkey)
SELECT o.o_orderkey AS transaction_id, c.c_name AS employee_name, o.o_totalprice AS price, round(t.total, 2) AS staff_total,
       o.o_totalprice = t.best AS is_staff_best, round(s.mean, 2) AS group_mean, t.kinds AS staff_kinds,
       CAST(p.place AS INTEGER) AS group_place
FROM orders o
JOIN per_customer t USING (o_custkey)
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN per_segment s ON s.c_mktsegment IS NOT DISTINCT FROM c.c_mktsegment
JOIN places p USING (o_orderkey)
""",
)
def window_enriched(spark, sf_dir):
    """Per-customer SUM/MAX, per-segment AVG, distinct priorities
    per customer and RANK within the segment."""
    o, c = D.tables(spark, sf_dir, "orders", "customer")
    tx = o.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("employee_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("category"),
    )
    emp = c.select(F.col("c_custkey").alias("employee_id"), F.col("c_name").alias("employee_name"), F.col("c_mktsegment").alias("department"))
    out = J.window_enriched(tx, emp)
    return out.withColumn("staff_total", F.round("staff_total", 2))


@query(
    "key_semi",
    """
SELECT o_orderkey, o_orderstatus FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""",
)
def key_semi(spark, sf_dir):
    """Rows whose key is in a key set (semi join)."""
    o, li = D.tables(spark, sf_dir, "orders", "lineitem")
    keys = li.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.key_semi(o.select("o_orderkey", "o_orderstatus"), keys, ["o_orderkey"])


@query(
    "key_anti",
    """
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE (l_orderkey, l_linenumber) NOT IN (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01')
""",
)
def key_anti(spark, sf_dir):
    """Rows whose (two-column) key tuple is not in a key set (anti join)."""
    (li,) = D.tables(spark, sf_dir, "lineitem")
    keys = li.filter(F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    return J.key_anti(li.select("l_orderkey", "l_linenumber", "l_shipdate"), keys, ["l_orderkey", "l_linenumber"])


@query(
    "cooccurrence_edges",
    with_ctes(TAG_LINKS)
    + """
SELECT a.tag AS source, b.tag AS target, count(*) AS shared_groups
FROM tag_links a JOIN tag_links b ON a.sync_id = b.sync_id AND a.tag < b.tag
GROUP BY a.tag, b.tag
""",
)
def cooccurrence_edges(spark, sf_dir):
    """Tag pairs sharing a branch, with the number of shared branches."""
    return J.cooccurrence_edges(D.tag_links(spark, sf_dir), "sync_id", "tag")


@query(
    "tag_usage_lineage",
    with_ctes(TAG_LINKS, BRANCHES)
    + """
SELECT l.tag, b.pipeline_name, b.destination_name,
       string_agg(DISTINCT b.table_name, ',' ORDER BY b.table_name) AS tables, count(*) AS n_branches
FROM tag_links l JOIN branches b ON l.sync_id = b.sync_id
GROUP BY l.tag, b.pipeline_name, b.destination_name
""",
)
def tag_usage_lineage(spark, sf_dir):
    """J10 + A11: where each tag is used, rolled up pipeline -> destination ->
    tables (the table list as sorted text)."""
    links, br = D.tag_links(spark, sf_dir), D.branches(spark, sf_dir)
    j = links.join(br, "sync_id")
    return j.groupBy("tag", "pipeline_name", "destination_name").agg(
        F.array_join(F.array_sort(F.collect_set("table_name")), ",").alias("tables"),
        F.count("*").alias("n_branches"),
    )


@query(
    "tag_usage_counts",
    with_ctes(TAG_LINKS, TAG_LIST)
    + """
SELECT t.tag, count(l.sync_id) AS usage_count
FROM tag_list t LEFT JOIN tag_links l ON l.tag = t.tag
GROUP BY t.tag
""",
)
def tag_usage_counts(spark, sf_dir):
    """Usage count per tag; unused tags count 0 (outer join)."""
    tl, links = D.tag_list(spark, sf_dir), D.tag_links(spark, sf_dir)
    return tl.join(links, "tag", "left").groupBy("tag").agg(F.count("sync_id").alias("usage_count"))


@query(
    "tag_usage_counts_filtered",
    with_ctes(TAG_LINKS, TAG_LIST, BRANCHES)
    + """
SELECT t.tag, count(l.sync_id) AS usage_count
FROM tag_list t JOIN tag_links l ON l.tag = t.tag JOIN branches b ON b.sync_id = l.sync_id
WHERE b.pipeline_id = 2 AND b.destination_id = 3
GROUP BY t.tag
""",
)
def tag_usage_counts_filtered(spark, sf_dir):
    """A9 with a pipeline and destination filter: the outer join becomes an
    inner join chain, so unused tags drop out."""
    tl, links, br = D.tag_list(spark, sf_dir), D.tag_links(spark, sf_dir), D.branches(spark, sf_dir)
    sel = br.filter((F.col("pipeline_id") == 2) & (F.col("destination_id") == 3)).select("sync_id")
    return tl.join(links, "tag").join(sel, "sync_id").groupBy("tag").agg(F.count("sync_id").alias("usage_count"))


@query(
    "tag_alphabet_groups",
    with_ctes(TAG_LINKS, TAG_LIST)
    + """
, counted AS (SELECT t.tag, count(l.sync_id) AS usage_count FROM tag_list t LEFT JOIN tag_links l ON l.tag = t.tag GROUP BY t.tag),
keyed AS (
  SELECT tag, usage_count,
         CASE WHEN tag = '' THEN '#'
              WHEN regexp_matches(upper(substr(tag, 1, 1)), '^[0-9]$') THEN upper(substr(tag, 1, 1))
              WHEN regexp_matches(upper(substr(tag, 1, 1)), '^[[:alpha:]]$') THEN upper(substr(tag, 1, 1))
              ELSE '#' END AS letter
  FROM counted)
SELECT letter, CASE WHEN regexp_matches(letter, '^[0-9]$') THEN 0 WHEN letter = '#' THEN 2 ELSE 1 END AS sort_rank,
       tag, usage_count, count(*) OVER (PARTITION BY letter) AS n_tags,
       CAST(sum(usage_count) OVER (PARTITION BY letter) AS BIGINT) AS usage_total
FROM keyed
""",
)
def tag_alphabet_groups(spark, sf_dir):
    """A10: tags grouped by upper-cased first character (digit, letter, else
    '#'); groups ordered digits, letters, '#'.  One row per tag with its
    group's figures, so no group has to fit in one row."""
    tl, links = D.tag_list(spark, sf_dir), D.tag_links(spark, sf_dir)
    counted = tl.join(links, "tag", "left").groupBy("tag").agg(F.count("sync_id").alias("usage_count"))
    first = F.upper(F.substring("tag", 1, 1))
    letter = F.when(F.col("tag") == "", "#").when(first.rlike("^[0-9]$"), first).when(first.rlike(r"^\p{L}$"), first).otherwise("#")
    keyed = counted.withColumn("letter", letter)
    rank = F.when(F.col("letter").rlike("^[0-9]$"), 0).when(F.col("letter") == "#", 2).otherwise(1)
    per_letter = keyed.groupBy("letter").agg(F.count("*").alias("n_tags"), F.sum("usage_count").alias("usage_total"))
    return keyed.join(per_letter, "letter").withColumn("sort_rank", rank)


@query(
    "route_fanout",
    with_ctes(TAG_LINKS, BRANCHES)
    + """
SELECT e.event_id, b.sync_id, b.destination_id, b.table_name
FROM events e JOIN branches b ON b.table_name = 'tbl_' || CAST(e.user_id % 10 AS VARCHAR)
""",
)
def route_fanout(spark, sf_dir):
    """Every event goes to every branch configured for its table."""
    (ev,) = D.tables(spark, sf_dir, "events")
    events = ev.select("event_id", F.concat(F.lit("tbl_"), (F.col("user_id") % D.EVENT_TABLES).cast("string")).alias("table_name"))
    routed = J.fanout(events, D.branches(spark, sf_dir).select("sync_id", "destination_id", "table_name"))
    return routed.select("event_id", "sync_id", "destination_id", "table_name")


@query(
    "unused_tags",
    with_ctes(TAG_LINKS, TAG_LIST) + "SELECT tag FROM tag_list WHERE tag NOT IN (SELECT tag FROM tag_links)",
)
def unused_tags(spark, sf_dir):
    """Tags no branch refers to any more."""
    return J.unused(D.tag_list(spark, sf_dir), D.tag_links(spark, sf_dir), "tag")


@query(
    "transform_aggregate_upsert",
    """
WITH agg_old AS (
  SELECT user_id, round(sum(value), 2) AS total_value, max(value) AS max_value,
         CAST((sum(CAST(round(value * 100) AS BIGINT)) * 200 + count(value)) // (2 * count(value)) AS DOUBLE) / 10000 AS avg_value,
         count(DISTINCT event_type) AS n_types
  FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY user_id),
agg_new AS (
  SELECT user_id, round(sum(value), 2) AS total_value, max(value) AS max_value,
         CAST((sum(CAST(round(value * 100) AS BIGINT)) * 200 + count(value)) // (2 * count(value)) AS DOUBLE) / 10000 AS avg_value,
         count(DISTINCT event_type) AS n_types
  FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY user_id)
SELECT * FROM agg_old o WHERE NOT EXISTS (SELECT 1 FROM agg_new n WHERE n.user_id = o.user_id)
UNION ALL SELECT * FROM agg_new
""",
)
def transform_aggregate_upsert(spark, sf_dir):
    """A branch whose SQL aggregates the batch (SUM/MAX/AVG/COUNT
    DISTINCT per user); its output replaces the target rows by the target key
    (batch scope: the aggregate covers only the new batch)."""
    (ev,) = D.tables(spark, sf_dir, "events")
    sql = """
      SELECT user_id, round(sum(value), 2) AS total_value, max(value) AS max_value,
             CAST((sum(CAST(round(value * 100) AS BIGINT)) * 200 + count(value)) div (2 * count(value)) AS DOUBLE) / 10000
               AS avg_value,
             count(DISTINCT event_type) AS n_types
      FROM tbl_events GROUP BY user_id"""
    cutoff = F.lit("2024-01-20").cast("timestamp_ntz")
    target = J.run_transform(spark, ev.filter(F.col("ts") < cutoff), "tbl_events", sql)
    # spark.sql resolves the view when called, so re-binding tbl_events to the
    # new batch below does not change ``target``.
    batch_out = J.run_transform(spark, ev.filter(F.col("ts") >= cutoff), "tbl_events", sql)
    return A.upsert(target, batch_out, ["user_id"])


@query(
    "transform_aggregate_full",
    """
WITH agg_all AS (
  SELECT user_id, round(sum(value), 2) AS total_value, max(value) AS max_value,
         CAST((sum(CAST(round(value * 100) AS BIGINT)) * 200 + count(value)) // (2 * count(value)) AS DOUBLE) / 10000 AS avg_value,
         count(DISTINCT event_type) AS n_types
  FROM events GROUP BY user_id),
agg_old AS (
  SELECT user_id, round(sum(value), 2) AS total_value, max(value) AS max_value,
         CAST((sum(CAST(round(value * 100) AS BIGINT)) * 200 + count(value)) // (2 * count(value)) AS DOUBLE) / 10000 AS avg_value,
         count(DISTINCT event_type) AS n_types
  FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY user_id),
touched AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-20')
SELECT * FROM agg_old o WHERE o.user_id NOT IN (SELECT user_id FROM touched)
UNION ALL SELECT a.* FROM agg_all a WHERE a.user_id IN (SELECT user_id FROM touched)
""",
)
def transform_aggregate_full(spark, sf_dir):
    """X7, scope='full': the same per-user aggregates, but a batch recomputes
    each affected user over the whole history instead of overwriting it with
    the batch-only figure."""
    (ev,) = D.tables(spark, sf_dir, "events")
    sql = """
      SELECT user_id, round(sum(value), 2) AS total_value, max(value) AS max_value,
             CAST((sum(CAST(round(value * 100) AS BIGINT)) * 200 + count(value)) div (2 * count(value)) AS DOUBLE) / 10000
               AS avg_value,
             count(DISTINCT event_type) AS n_types
      FROM tbl_events GROUP BY user_id"""
    cutoff = F.lit("2024-01-20").cast("timestamp_ntz")
    target = J.run_transform(spark, ev.filter(F.col("ts") < cutoff), "tbl_events", sql)
    return J.aggregate_upsert(spark, target, ev.filter(F.col("ts") >= cutoff), ev, "tbl_events", sql, ["user_id"], scope="full")


@query(
    "transform_aggregate_delta",
    with_ctes(CHG_ORDERS)
    + """
, final AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ts DESC, seq DESC) AS rn FROM chg_orders)
  WHERE rn = 1 AND op <> 'd')
SELECT o_custkey % 200 AS customer_group, count(*) AS n_rows,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) // count(o_totalprice) AS BIGINT) AS mean_cents,
       max(CAST(round(o_totalprice * 100) AS BIGINT)) AS greatest_cents, count(DISTINCT o_orderpriority) AS n_priorities
FROM final GROUP BY 1
""",
)
def transform_aggregate_delta(spark, sf_dir):
    """A16 kept up to date: the aggregate of all orders at the cutoff moves by the
    differences that later inserts, updates and deletes make; greatest values and
    distinct counts are computed anew for the touched groups only.  Equal to the
    aggregate of the final rows."""
    from tidemark.operators import incremental as I

    def grouped(df):
        cents = F.round(F.col("o_totalprice") * 100).cast("long")
        return df.withColumn("customer_group", F.col("o_custkey") % 200).withColumn("cents", cents)

    rows = grouped(D.orders_state(spark, sf_dir)).select("o_orderkey", "customer_group", "cents", "o_orderpriority")
    stored = I.aggregate(rows, ["customer_group"], "cents", "o_orderpriority")
    changes = grouped(D.orders_batch(spark, sf_dir))
    out = I.apply_deltas(stored, rows, changes, ["o_orderkey"], ["customer_group"], "cents", "o_orderpriority")
    return out.select(
        "customer_group",
        "n_rows",
        F.col("total").alias("total_cents"),
        F.expr("total div n_values").alias("mean_cents"),
        F.col("greatest").alias("greatest_cents"),
        F.col("n_labels").alias("n_priorities"),
    )
