"""Queries for catalogs and schema evolution: S9-S13, K8, E1-E7, A12, A13, U1, U2."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tidemark.operators import evolution as EV
from tidemark.plans import derived as D
from tidemark.plans.registry import BRANCHES, CHG_ORDERS, TAG_LINKS, query, with_ctes
from tidemark.sources import catalog as C

# Schemas of the source tables (as the source database reports
# them) and their declared keys.
SCHEMAS = {
    "orders": [
        ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "text"), ("o_totalprice", "double precision"),
        ("o_orderdate", "timestamp without time zone"), ("o_orderpriority", "text"),
    ],
    "customer": [("c_custkey", "bigint"), ("c_name", "text"), ("c_nationkey", "integer"), ("c_acctbal", "double precision"), ("c_mktsegment", "text")],
    "events": [
        ("event_id", "bigint"), ("ts", "timestamp without time zone"), ("user_id", "bigint"), ("event_type", "text"),
        ("value", "double precision"), ("props", "text"),
    ],
    "lineitem": [
        ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "integer"),
        ("l_quantity", "double precision"), ("l_extendedprice", "double precision"), ("l_discount", "double precision"),
        ("l_tax", "double precision"), ("l_returnflag", "text"), ("l_linestatus", "text"), ("l_shipdate", "timestamp without time zone"),
    ],
}
KEYS = {"orders": ["o_orderkey"], "customer": ["c_custkey"], "events": ["event_id"], "lineitem": ["l_orderkey", "l_linenumber"]}


def _q(s):
    return "NULL" if s is None else "'" + str(s).replace("'", "''") + "'"


def _catalog_values(tables=SCHEMAS, keys=KEYS):
    rows = []
    for t, cols in tables.items():
        for i, (c, ty) in enumerate(cols, start=1):
            k = c in keys.get(t, [])
            rows.append(f"('{t}', {i}, '{c}', '{ty}', {'TRUE' if k else 'FALSE'})")
    return ",\n    ".join(rows)


CATALOG_SQL = f"""
catalog AS (
  SELECT table_name, CAST(ordinal AS INTEGER) AS ordinal, column_name, data_type,
         CAST(NULL AS INTEGER) AS numeric_precision, CAST(NULL AS INTEGER) AS numeric_scale,
         NOT is_primary_key AS is_nullable, is_primary_key, FALSE AS has_default, CAST(NULL AS VARCHAR) AS default_value
  FROM (VALUES
    {_catalog_values()}) v(table_name, ordinal, column_name, data_type, is_primary_key))
"""


def _null_sql(tables=SCHEMAS):
    parts = []
    for t, cols in tables.items():
        for c, _ in cols:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM {t}")
    return "nulls AS (\n  " + "\n  UNION ALL ".join(parts) + ")"


def _sources(spark, sf_dir):
    names = list(SCHEMAS)
    dfs = D.tables(spark, sf_dir, *names)
    return dict(zip(names, dfs))


@query(
    "catalog_columns",
    with_ctes(CATALOG_SQL, _null_sql()) + "SELECT c.*, n.n_rows, n.n_nulls FROM catalog c LEFT JOIN nulls n USING (table_name, column_name)",
)
def catalog_columns(spark, sf_dir):
    """Column catalog of the source tables (types, key, nullability,
    defaults) with observed row and NULL counts (one pass per table)."""
    return C.profiled_catalog(spark, _sources(spark, sf_dir), KEYS)


@query(
    "key_uniqueness_profile",
    """
WITH k AS (
  SELECT 'orders' AS table_name, 'o_orderkey' AS key_columns, count(*) AS c FROM orders GROUP BY o_orderkey
  UNION ALL SELECT 'customer', 'c_custkey', count(*) FROM customer GROUP BY c_custkey
  UNION ALL SELECT 'events', 'event_id', count(*) FROM events GROUP BY event_id
  UNION ALL SELECT 'lineitem', 'l_orderkey,l_linenumber', count(*) FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT table_name, key_columns, CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_keys,
       count(*) FILTER (WHERE c > 1) AS n_duplicate_keys, CAST(COALESCE(sum(c) FILTER (WHERE c > 1), 0) AS BIGINT) AS rows_in_duplicates,
       count(*) FILTER (WHERE c > 1) = 0 AS is_unique
FROM k GROUP BY table_name, key_columns
""",
)
def key_uniqueness_profile(spark, sf_dir):
    """Verify the declared keys: duplicate keys and the rows in them
    (lineitem's (l_orderkey, l_linenumber) is not unique)."""
    out = None
    for name, df in _sources(spark, sf_dir).items():
        p = C.key_profile(df, name, KEYS[name])
        out = p if out is None else out.unionByName(p)
    return out


def _key_search_sql(max_width=3):
    """Distinct counts of every set of columns, the least unique ones kept."""
    counts = []
    for t, cols in SCHEMAS.items():
        names = [c for c, _ in cols]
        for width in range(1, max_width + 1):
            for some in combinations(names, width):
                counts.append(f"SELECT '{t}' AS table_name, '{','.join(some)}' AS key_columns, {width} AS width, "
                              f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(some)} FROM {t})) AS n")
    sizes = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in SCHEMAS)
    return f"""
WITH counts AS ({" UNION ALL ".join(counts)}),
sizes AS ({sizes}),
keys AS (SELECT table_name, key_columns, width, n_rows FROM counts JOIN sizes USING (table_name) WHERE n = n_rows
         QUALIFY width = min(width) OVER (PARTITION BY table_name))
SELECT s.table_name, k.key_columns, s.n_rows FROM sizes s LEFT JOIN keys k USING (table_name)
"""


@query("key_search", _key_search_sql())
def key_search(spark, sf_dir):
    """S10 fallback: the least sets of columns (up to three) that identify the rows
    of each table, found without a declared key; a table without any has one row
    that says so."""
    rows = []
    for name, df in _sources(spark, sf_dir).items():
        df = df.select(*[c for c, _ in SCHEMAS[name]])
        n = df.count()
        rows += [(name, ",".join(k), n) for k in C.least_keys(df)] or [(name, None, n)]
    return spark.createDataFrame(rows, "table_name string, key_columns string, n_rows long")


@query(
    "catalog_reconcile",
    """
WITH published AS (SELECT DISTINCT 'tbl_' || CAST(user_id % 12 AS VARCHAR) AS table_name FROM events),
tracked AS (SELECT DISTINCT 'tbl_' || CAST(c_nationkey % 14 AS VARCHAR) AS table_name,
                   CASE WHEN c_nationkey % 14 = 3 THEN NULL ELSE '{"columns": 5}' END AS schema_json FROM customer)
SELECT table_name, 'added' AS change FROM published WHERE table_name NOT IN (SELECT table_name FROM tracked)
UNION ALL SELECT DISTINCT table_name, 'removed' FROM tracked WHERE table_name NOT IN (SELECT table_name FROM published)
UNION ALL SELECT DISTINCT table_name, 'schema_missing' FROM tracked
  WHERE (schema_json IS NULL OR trim(schema_json) = '' OR schema_json = '{}') AND table_name IN (SELECT table_name FROM published)
""",
)
def catalog_reconcile(spark, sf_dir):
    """Published (source) tables vs tracked tables: added, removed and
    tracked-without-schema."""
    ev, cu = D.tables(spark, sf_dir, "events", "customer")
    published = ev.select(F.concat(F.lit("tbl_"), (F.col("user_id") % 12).cast("string")).alias("table_name"))
    k = F.col("c_nationkey") % 14
    tracked = cu.select(
        F.concat(F.lit("tbl_"), k.cast("string")).alias("table_name"),
        F.when(k == 3, F.lit(None)).otherwise(F.lit('{"columns": 5}')).alias("schema_json"),
    ).distinct()
    return C.reconcile(published, tracked)


@query(
    "catalog_listing",
    with_ctes(CATALOG_SQL)
    + """
, sizes AS (SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders
            UNION ALL SELECT 'customer', count(*) FROM customer
            UNION ALL SELECT 'events', count(*) FROM events
            UNION ALL SELECT 'lineitem', count(*) FROM lineitem)
SELECT c.table_name, string_agg(c.column_name, ',' ORDER BY c.ordinal) AS columns, count(*) AS n_columns, max(s.n_rows) AS n_rows
FROM catalog c JOIN sizes s USING (table_name) WHERE c.table_name ILIKE '%ER%' GROUP BY c.table_name
""",
)
def catalog_listing(spark, sf_dir):
    """Tables matching a case-insensitive filter, columns in order, with
    their row counts (the catalog is profiled over the data)."""
    return C.listing(C.profiled_catalog(spark, _sources(spark, sf_dir), KEYS), "ER")


_EXISTING_SQL = """
existing AS (
  SELECT 'public' AS schema_name, t AS table_name FROM (VALUES ('orders'), ('customer'), ('lineitem')) v(t)
  UNION ALL SELECT 'staging', 'events'
  UNION ALL SELECT DISTINCT CASE WHEN c_mktsegment < 'F' THEN 'staging' ELSE 'public' END, lower(c_mktsegment) FROM customer),
candidates AS (
  SELECT DISTINCT c_mktsegment AS candidate FROM customer
  UNION SELECT DISTINCT p_brand FROM part
  UNION SELECT upper(t) FROM (VALUES ('orders'), ('customer'), ('lineitem'), ('events')) v(t))
"""


@query(
    "target_table_check",
    with_ctes(_EXISTING_SQL)
    + """
, here AS (SELECT table_name FROM existing WHERE schema_name = 'public'),
elsewhere AS (SELECT lower(table_name) AS l, min(schema_name) AS other_schema FROM existing WHERE schema_name <> 'public' GROUP BY 1),
checked AS (
  SELECT c.candidate, regexp_matches(c.candidate, '^[A-Za-z_][A-Za-z0-9_]*$') AS valid_identifier,
         EXISTS (SELECT 1 FROM here h WHERE h.table_name = c.candidate OR h.table_name = lower(c.candidate)) AS exists
  FROM candidates c)
SELECT k.candidate, k.valid_identifier, k.exists, CASE WHEN NOT k.exists THEN e.other_schema END AS other_schema
FROM checked k LEFT JOIN elsewhere e ON e.l = lower(k.candidate)
""",
)
def target_table_check(spark, sf_dir):
    """S13 + J11: candidate target names: identifier check, existence in the
    target schema (exact or lower case), else the schema that has it."""
    cu, pa = D.tables(spark, sf_dir, "customer", "part")
    spark_ = cu.sparkSession
    fixed = spark_.createDataFrame([("public", "orders"), ("public", "customer"), ("public", "lineitem"), ("staging", "events")], "schema_name string, table_name string")
    seg = cu.select(F.when(F.col("c_mktsegment") < "F", "staging").otherwise("public").alias("schema_name"), F.lower("c_mktsegment").alias("table_name")).distinct()
    existing = fixed.unionByName(seg)
    names = spark_.createDataFrame([(n.upper(),) for n in ["orders", "customer", "lineitem", "events"]], "candidate string")
    candidates = cu.select(F.col("c_mktsegment").alias("candidate")).union(pa.select("p_brand")).union(names)
    return C.target_check(candidates, existing, "public")


def _typed_catalog(spark, sf_dir):
    from tidemark.plans.decode_queries import _decoded_orders

    src = _sources(spark, sf_dir)
    (emb,) = D.tables(spark, sf_dir, "embeddings")
    decoded = _decoded_orders(spark, sf_dir).drop("op", "seq")
    return C.profiled_catalog(spark, {"orders": src["orders"], "events": src["events"], "orders_decoded": decoded, "embeddings": emb}, KEYS)


_TYPED = {
    "orders": SCHEMAS["orders"],
    "events": SCHEMAS["events"],
    "orders_decoded": [
        ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "text"), ("o_totalprice", "numeric"), ("price_delta", "numeric"),
        ("o_orderdate", "date"), ("o_orderpriority", "text"), ("changed_at", "timestamp without time zone"),
    ],
    "embeddings": [("vec_id", "bigint"), ("embedding", "ARRAY"), ("label", "integer")],
}


def _typed_nulls_sql():
    parts = []
    for t in ("orders", "events"):
        for c, _ in SCHEMAS[t]:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM {t}")
    dec = {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "o_orderstatus": "o_orderstatus", "o_totalprice": "o_totalprice",
           "price_delta": "o_totalprice", "o_orderdate": "o_orderdate", "o_orderpriority": "o_orderpriority", "changed_at": "ts"}
    for c, src in dec.items():
        parts.append(f"SELECT 'orders_decoded', '{c}', count(*), count(*) - count({src}) FROM chg_orders")
    for c in ("vec_id", "embedding", "label"):
        parts.append(f"SELECT 'embeddings', '{c}', count(*), count(*) - count({c}) FROM embeddings")
    return "nulls AS (\n  " + "\n  UNION ALL ".join(parts) + ")"


@query(
    "catalog_type_map",
    f"""
WITH {CHG_ORDERS.strip()},
{_typed_nulls_sql()},
catalog AS (
  SELECT table_name, CAST(ordinal AS INTEGER) AS ordinal, column_name, data_type,
         CASE WHEN data_type = 'numeric' THEN 38 END AS numeric_precision, CASE WHEN data_type = 'numeric' THEN 2 END AS numeric_scale
  FROM (VALUES {_catalog_values(_TYPED, {})}) v(table_name, ordinal, column_name, data_type, k))
SELECT table_name, column_name, data_type,
       CASE WHEN data_type IN ('bigint', 'integer', 'smallint') THEN 'NUMBER(38,0)'
            WHEN data_type = 'numeric' THEN 'NUMBER(' || numeric_precision || ', ' || numeric_scale || ')'
            WHEN data_type IN ('double precision', 'real') THEN 'FLOAT'
            WHEN data_type = 'boolean' THEN 'BOOLEAN' WHEN data_type = 'date' THEN 'DATE'
            WHEN data_type = 'timestamp with time zone' THEN 'TIMESTAMP_TZ'
            WHEN data_type = 'timestamp without time zone' THEN 'TIMESTAMP_NTZ'
            WHEN data_type = 'ARRAY' THEN 'ARRAY' ELSE 'VARCHAR' END AS warehouse_type,
       CASE WHEN data_type = 'bigint' THEN 'bigint' WHEN data_type = 'integer' THEN 'int'
            WHEN data_type = 'numeric' THEN 'decimal(' || numeric_precision || ',' || numeric_scale || ')'
            WHEN data_type = 'double precision' THEN 'double' WHEN data_type = 'date' THEN 'date'
            WHEN data_type = 'timestamp without time zone' THEN 'timestamp_ntz'
            WHEN data_type = 'ARRAY' THEN 'array<string>' ELSE 'string' END AS spark_type,
       n.n_rows, n.n_nulls
FROM catalog LEFT JOIN nulls n USING (table_name, column_name)
""",
)
def catalog_type_map(spark, sf_dir):
    """Source types -> warehouse types (whole-token matching) and the
    Spark type a decoded column gets."""
    cat = _typed_catalog(spark, sf_dir)
    p, s = F.col("numeric_precision"), F.col("numeric_scale")
    return cat.select(
        "table_name",
        "column_name",
        "data_type",
        C.warehouse_type(F.col("data_type"), p, s).alias("warehouse_type"),
        C.spark_type_name(F.col("data_type"), p, s).alias("spark_type"),
        "n_rows",
        "n_nulls",
    )


# ------------------------------------------------------------------ evolution

EVOLVE_ADD = {"o_comment": ("string", "'n/a'"), "o_flag": ("boolean", None)}
EVOLVE_DROP = ["o_orderpriority"]
EVOLVE_RETYPE = {"o_totalprice": "decimal(12,2)", "o_custkey": "string"}


def _evolved_orders(spark, sf_dir):
    (o,) = D.tables(spark, sf_dir, "orders")
    return EV.evolve(o, EVOLVE_ADD, EVOLVE_DROP, EVOLVE_RETYPE)


def observed_catalog(spark, tables):
    """Catalog whose nullability is what the data shows (any NULL present)."""
    cat = C.catalog_of(spark, tables)
    prof = None
    for name, df in tables.items():
        p = C.null_profile(name, df)
        prof = p if prof is None else prof.unionByName(p)
    return cat.drop("is_nullable").join(prof, ["table_name", "column_name"], "left").withColumn("is_nullable", F.col("n_nulls") > 0)


def _versions(spark, sf_dir):
    (o,) = D.tables(spark, sf_dir, "orders")
    v1 = observed_catalog(spark, {"orders": o})
    v2 = observed_catalog(spark, {"orders": _evolved_orders(spark, sf_dir)})
    return v1, v2


_V1_SQL = """
v1 AS (
  SELECT 'orders' AS table_name, c AS column_name, t AS data_type, n AS n_nulls FROM (VALUES
    ('o_orderkey', 'bigint', (SELECT count(*) - count(o_orderkey) FROM orders)),
    ('o_custkey', 'bigint', (SELECT count(*) - count(o_custkey) FROM orders)),
    ('o_orderstatus', 'text', (SELECT count(*) - count(o_orderstatus) FROM orders)),
    ('o_totalprice', 'double precision', (SELECT count(*) - count(o_totalprice) FROM orders)),
    ('o_orderdate', 'timestamp without time zone', (SELECT count(*) - count(o_orderdate) FROM orders)),
    ('o_orderpriority', 'text', (SELECT count(*) - count(o_orderpriority) FROM orders))) x(c, t, n)),
v2 AS (
  SELECT 'orders' AS table_name, c AS column_name, t AS data_type, n AS n_nulls FROM (VALUES
    ('o_orderkey', 'bigint', (SELECT count(*) - count(o_orderkey) FROM orders)),
    ('o_custkey', 'text', (SELECT count(*) - count(o_custkey) FROM orders)),
    ('o_orderstatus', 'text', (SELECT count(*) - count(o_orderstatus) FROM orders)),
    ('o_totalprice', 'numeric', (SELECT count(*) - count(TRY_CAST(o_totalprice AS DECIMAL(12,2))) FROM orders)),
    ('o_orderdate', 'timestamp without time zone', (SELECT count(*) - count(o_orderdate) FROM orders)),
    ('o_comment', 'text', 0),
    ('o_flag', 'boolean', (SELECT count(*) FROM orders))) x(c, t, n))
"""


@query(
    "schema_diff",
    with_ctes(_V1_SQL)
    + """
SELECT COALESCE(v1.table_name, v2.table_name) AS table_name, COALESCE(v1.column_name, v2.column_name) AS column_name,
       CASE WHEN v1.data_type IS NULL THEN 'added' WHEN v2.data_type IS NULL THEN 'dropped'
            WHEN v1.data_type <> v2.data_type THEN 'type_changed'
            WHEN (v1.n_nulls > 0) <> (v2.n_nulls > 0) THEN 'nullability_changed' ELSE 'unchanged' END AS change,
       v1.data_type AS old_data_type, v2.data_type AS new_data_type
FROM v1 FULL OUTER JOIN v2 ON v1.table_name = v2.table_name AND v1.column_name = v2.column_name
""",
)
def schema_diff(spark, sf_dir):
    """Per-column diff of the orders table before and after an
    evolution (added, dropped, retyped; nullability as observed in the data)."""
    v1, v2 = _versions(spark, sf_dir)
    return EV.diff(v1, v2)


_CU_EV_SQL = """
cu1 AS (SELECT 'customer' AS table_name, c AS column_name, t AS data_type FROM (VALUES
    ('c_custkey', 'bigint'), ('c_name', 'text'), ('c_nationkey', 'integer'), ('c_acctbal', 'double precision'), ('c_mktsegment', 'text')) x(c, t)),
cu2 AS (SELECT * FROM cu1 WHERE column_name <> 'c_acctbal'),
ev1 AS (SELECT 'events' AS table_name, c AS column_name, t AS data_type FROM (VALUES
    ('event_id', 'bigint'), ('ts', 'timestamp without time zone'), ('user_id', 'bigint'), ('event_type', 'text'),
    ('value', 'double precision'), ('props', 'text')) x(c, t)),
ev2 AS (SELECT table_name, column_name, CASE WHEN column_name = 'props' THEN 'bytea' ELSE data_type END AS data_type FROM ev1),
diffs AS (
  SELECT COALESCE(v1.table_name, v2.table_name) AS table_name,
         CASE WHEN v1.data_type IS NULL THEN 'added' WHEN v2.data_type IS NULL THEN 'dropped'
              WHEN v1.data_type <> v2.data_type THEN 'type_changed'
              WHEN (v1.n_nulls > 0) <> (v2.n_nulls > 0) THEN 'nullability_changed' ELSE 'unchanged' END AS change
  FROM v1 FULL OUTER JOIN v2 ON v1.table_name = v2.table_name AND v1.column_name = v2.column_name
  UNION ALL
  SELECT 'customer', CASE WHEN b.column_name IS NULL THEN 'dropped' ELSE 'unchanged' END
  FROM cu1 a LEFT JOIN cu2 b ON a.column_name = b.column_name WHERE EXISTS (SELECT 1 FROM customer)
  UNION ALL
  SELECT 'events', CASE WHEN a.data_type <> b.data_type THEN 'type_changed' ELSE 'unchanged' END
  FROM ev1 a JOIN ev2 b ON a.column_name = b.column_name WHERE EXISTS (SELECT 1 FROM events))
"""


@query(
    "schema_change_label",
    with_ctes(_V1_SQL, _CU_EV_SQL)
    + """
SELECT table_name,
       CASE WHEN bool_or(change = 'added') THEN 'NEW COLUMN' WHEN bool_or(change = 'dropped') THEN 'DROP COLUMN' ELSE 'CHANGES TYPE' END AS changes_type,
       count(*) FILTER (WHERE change <> 'unchanged') AS n_changed_columns
FROM diffs GROUP BY table_name HAVING count(*) FILTER (WHERE change <> 'unchanged') > 0
""",
)
def schema_change_label(spark, sf_dir):
    """E1 summary label per table (precedence NEW COLUMN > DROP COLUMN >
    CHANGES TYPE; unchanged tables have no row)."""
    v1, v2 = _versions(spark, sf_dir)
    # One profile per table; the evolved catalog is derived from the first.
    cu_cat, ev_cat, li_cat = (
        observed_catalog(spark, {t: df}) for t, df in zip(("customer", "events", "lineitem"), D.tables(spark, sf_dir, "customer", "events", "lineitem"))
    )
    diffs = [
        EV.diff(v1, v2),
        EV.diff(cu_cat, cu_cat.filter(F.col("column_name") != "c_acctbal")),
        EV.diff(ev_cat, ev_cat.withColumn("data_type", F.when(F.col("column_name") == "props", "bytea").otherwise(F.col("data_type")))),
        EV.diff(li_cat, li_cat),
    ]
    allc = diffs[0]
    for d in diffs[1:]:
        allc = allc.unionByName(d)
    return EV.change_label(allc)


def schema_history(spark, sf_dir):
    """Schema snapshots per table: one per day on which the table saw an
    event (the first is the initial load)."""
    (ev,) = D.tables(spark, sf_dir, "events")
    snaps = ev.groupBy(F.concat(F.lit("tbl_"), (F.col("user_id") % 10).cast("string")).alias("table_name"), F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("created_at"), F.min("event_id").alias("snapshot_id")
    )
    return snaps.withColumn("changes_type", F.lit("CHANGES TYPE"))


HISTORY_SQL = """
history AS (
  SELECT table_name, created_at, snapshot_id,
         CAST(row_number() OVER (PARTITION BY table_name ORDER BY created_at, snapshot_id) AS INTEGER) AS version_schema
  FROM (SELECT 'tbl_' || CAST(user_id % 10 AS VARCHAR) AS table_name, CAST(ts AS DATE) AS day,
               min(ts) AS created_at, min(event_id) AS snapshot_id
        FROM events GROUP BY 1, 2))
"""


@query(
    "schema_current_version",
    with_ctes(HISTORY_SQL)
    + """
, tabs AS (SELECT DISTINCT 'tbl_' || CAST(user_id % 12 AS VARCHAR) AS table_name FROM events)
SELECT t.table_name, COALESCE(max(h.version_schema), 0) AS current_version, COALESCE(max(h.version_schema), 0) + 1 AS next_version
FROM tabs t LEFT JOIN history h ON h.table_name = t.table_name GROUP BY t.table_name
""",
)
def schema_current_version(spark, sf_dir):
    """Current version per published table (0 if never recorded)."""
    (ev,) = D.tables(spark, sf_dir, "events")
    tabs = ev.select(F.concat(F.lit("tbl_"), (F.col("user_id") % 12).cast("string")).alias("table_name"))
    hist = EV.snapshot_log(schema_history(spark, sf_dir), "table_name", "created_at").withColumn("version_schema", F.col("version_schema").cast("int"))
    return EV.current_version(tabs, hist)


_DUP_SQL = """
, dup AS (
  SELECT table_name, version_schema, created_at, snapshot_id AS history_id FROM history
  UNION ALL
  SELECT table_name, version_schema, created_at + INTERVAL 1 HOUR, snapshot_id + 1000000000 FROM history WHERE day(created_at) % 2 = 0)
"""


@query(
    "schema_history_dedup",
    with_ctes(HISTORY_SQL)
    + _DUP_SQL
    + """
SELECT table_name, version_schema, created_at, history_id FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, version_schema ORDER BY created_at, history_id) AS rn FROM dup)
WHERE rn = 1
""",
)
def schema_history_dedup(spark, sf_dir):
    """A history table with duplicated (table, version) rows -- here a
    replayed write an hour later on even days -- reduced to the oldest row."""
    hist = EV.snapshot_log(schema_history(spark, sf_dir), "table_name", "created_at").select(
        "table_name", F.col("version_schema").cast("int").alias("version_schema"), "created_at", F.col("snapshot_id").alias("history_id")
    )
    replay = hist.filter(F.dayofmonth("created_at") % 2 == 0).select(
        "table_name", "version_schema", (F.col("created_at") + F.expr("INTERVAL 1 HOUR")).alias("created_at"), (F.col("history_id") + F.lit(1_000_000_000)).alias("history_id")
    )
    return EV.dedup_versions(hist.unionByName(replay))


@query(
    "evolve_target",
    """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(TRY_CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS o_totalprice, o_orderdate,
       'n/a' AS o_comment, CAST(NULL AS BOOLEAN) AS o_flag
FROM orders
""",
)
def evolve_target(spark, sf_dir):
    """The target's rows after the evolution (column added with its
    literal default, one without a literal default, a dropped column, two
    retyped columns)."""
    out = _evolved_orders(spark, sf_dir)
    return out.withColumn("o_totalprice", F.col("o_totalprice").cast("string"))


_DEFAULT_TESTS = [
    "nextval('id_seq'::regclass)", "'n/a'::character varying", "'x'::text", "'quoted'", "0", "-1.5", "true", "FALSE",
    "now()", "CURRENT_TIMESTAMP", "current_date", "'{}'::jsonb", "'[]'::json", "gen_random_uuid()", "",
]


@query(
    "default_literals",
    """
WITH d AS (
  SELECT DISTINCT CASE c_nationkey % 15 """
    + " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(_DEFAULT_TESTS))
    + """ END AS default_value FROM customer),
p AS (
  SELECT default_value,
    CASE WHEN default_value IS NULL OR trim(default_value) = '' THEN NULL
         WHEN contains(lower(default_value), 'nextval') THEN NULL
         WHEN regexp_matches(trim(default_value), '^''([^'']*)''::[A-Za-z0-9_\\s]+') THEN '''' || regexp_extract(trim(default_value), '^''([^'']*)''', 1) || ''''
         WHEN starts_with(trim(default_value), '''') AND ends_with(trim(default_value), '''') THEN trim(default_value)
         WHEN TRY_CAST(trim(default_value) AS DOUBLE) IS NOT NULL THEN trim(default_value)
         WHEN lower(trim(default_value)) IN ('true', 'false') THEN upper(trim(default_value))
         WHEN contains(lower(default_value), 'current_timestamp') THEN 'CURRENT_TIMESTAMP()'
         WHEN contains(lower(default_value), 'current_date') THEN 'CURRENT_DATE()'
         WHEN contains(lower(default_value), 'now()') THEN 'CURRENT_TIMESTAMP()' END AS parsed
  FROM d)
SELECT default_value, parsed,
       COALESCE((starts_with(parsed, '''') AND ends_with(parsed, '''')) OR upper(parsed) IN ('TRUE', 'FALSE') OR TRY_CAST(parsed AS DOUBLE) IS NOT NULL, FALSE) AS is_literal
FROM p
""",
)
def default_literals(spark, sf_dir):
    """E5: source default expressions -> warehouse literal/expression, and
    whether the result is a plain literal."""
    (cu,) = D.tables(spark, sf_dir, "customer")
    arr = F.array(*[F.lit(v) for v in _DEFAULT_TESTS])
    d = cu.select(F.element_at(arr, (F.col("c_nationkey") % 15 + 1).cast("int")).alias("default_value")).distinct()
    parsed = EV.parse_default(F.col("default_value"))
    return d.select("default_value", parsed.alias("parsed")).withColumn("is_literal", F.coalesce(EV.is_literal(F.col("parsed")), F.lit(False)))


@query(
    "refresh_candidates",
    with_ctes(HISTORY_SQL, TAG_LINKS, BRANCHES)
    + """
, changed AS (SELECT DISTINCT table_name FROM history WHERE version_schema > 1 AND created_at >= TIMESTAMP '2024-01-28')
SELECT DISTINCT b.pipeline_id FROM branches b
WHERE b.table_name IN (SELECT table_name FROM changed) AND b.pipeline_id % 2 = 0
""",
)
def refresh_candidates(spark, sf_dir):
    """Running pipelines (even ids run) with a branch on a table whose
    schema changed in the last days."""
    hist = EV.snapshot_log(schema_history(spark, sf_dir), "table_name", "created_at")
    changed = hist.filter((F.col("version_schema") > 1) & (F.col("created_at") >= F.lit("2024-01-28").cast("timestamp_ntz")))
    br = D.branches(spark, sf_dir)
    pipelines = br.select("pipeline_id").distinct().withColumn("status", F.when(F.col("pipeline_id") % 2 == 0, "START").otherwise("PAUSE"))
    return EV.refresh_candidates(changed, br, pipelines)
