"""Schema evolution over catalogs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import envelope as EV

ATTRS = ["data_type", "numeric_precision", "numeric_scale", "is_nullable", "default_value"]


def diff(old: DataFrame, new: DataFrame, keys=("table_name",)) -> DataFrame:
    """Per column of two catalog versions: added, dropped,
    type_changed, nullability_changed, default_changed or unchanged
    (attributes compared NULL-safely)."""
    keys = list(keys)
    o = old.select(*keys, "column_name", *[F.col(a).alias(f"old_{a}") for a in ATTRS])
    n = new.select(*keys, "column_name", *[F.col(a).alias(f"new_{a}") for a in ATTRS])
    j = o.join(n, [*keys, "column_name"], "full_outer")

    def changed(a: str) -> Column:
        return ~F.col(f"old_{a}").eqNullSafe(F.col(f"new_{a}"))

    type_changed = changed("data_type") | changed("numeric_precision") | changed("numeric_scale")
    change = (
        F.when(F.col("old_data_type").isNull(), "added")
        .when(F.col("new_data_type").isNull(), "dropped")
        .when(type_changed, "type_changed")
        .when(changed("is_nullable"), "nullability_changed")
        .when(changed("default_value"), "default_changed")
        .otherwise("unchanged")
    )
    return j.select(*keys, "column_name", change.alias("change"), "old_data_type", "new_data_type")


def change_label(column_diff: DataFrame, keys=("table_name",)) -> DataFrame:
    """E1 summary: one label per table, first match wins: NEW COLUMN, DROP
    COLUMN, CHANGES TYPE (any attribute change), else no row."""
    keys = list(keys)
    c = F.col("change")
    agg = column_diff.groupBy(*keys).agg(
        F.max(F.when(c == "added", 1).otherwise(0)).alias("__a"),
        F.max(F.when(c == "dropped", 1).otherwise(0)).alias("__d"),
        F.max(F.when(c.isin("type_changed", "nullability_changed", "default_changed"), 1).otherwise(0)).alias("__t"),
        F.count(F.when(c != "unchanged", 1)).alias("n_changed_columns"),
    )
    label = F.when(F.col("__a") == 1, "NEW COLUMN").when(F.col("__d") == 1, "DROP COLUMN").when(F.col("__t") == 1, "CHANGES TYPE")
    return agg.filter(F.col("n_changed_columns") > 0).select(*keys, label.alias("changes_type"), "n_changed_columns")


FIELDS_TYPE = "array<struct<field: string, type: string, name: string, optional: boolean, scale: int, default: string>>"


def fields_of(schema: Column) -> Column:
    """The columns that an envelope's schema block lists for the after-image, by
    name; two blocks with the same columns give the same value."""
    blocks = F.from_json(schema, EV.SCHEMA_SCHEMA).getField("fields")
    image = F.flatten(F.transform(F.filter(blocks, lambda b: b.getField("field") == "after"), lambda b: b.getField("fields")))
    one = lambda f: F.struct(
        f.getField("field").alias("field"),
        f.getField("type").alias("type"),
        f.getField("name").alias("name"),
        F.coalesce(f.getField("optional"), F.lit(True)).alias("optional"),
        f.getField("parameters").getItem("scale").cast("int").alias("scale"),
        f.getField("default").alias("default"),
    )
    return F.array_sort(F.transform(image, one))


def schema_events(raw: DataFrame) -> DataFrame:
    """(table_name, at, tie, schema) of the raw events that carry a schema block:
    ``at`` is the event's time, equal times go by the event's text."""
    shape = T.StructType([T.StructField("schema", T.StringType()), T.StructField("payload", T.StructType([T.StructField("ts_ms", T.LongType())]))])
    parsed = raw.select(EV.topic_table(F.col("topic")).alias("table_name"), F.xxhash64("key", "value").alias("tie"), F.explode(F.array(F.from_json("value", shape))).alias("v"))
    out = parsed.select("table_name", F.col("v.payload.ts_ms").alias("at"), "tie", F.col("v.schema").alias("schema"))
    return out.filter(F.col("table_name").isNotNull() & F.col("at").isNotNull() & F.col("schema").isNotNull())


def schema_runs(events: DataFrame, bucket_ms: int = 3_600_000) -> DataFrame:
    """Where a table's schema changes in the time order of its events:
    (table_name, started_ms, fields), one row for each stretch of events that carry
    the same columns, the first included.

    Events are merged map-side to (table, hour, schema), with the text as a key, as
    a hash aggregate can't hold one as a value and would sort all events; only in
    hours with more than one schema are single events put in order.  What is left is
    one row for each hour, which a window per table compares."""
    spread = events.select("*", F.floor(F.col("at") / bucket_ms).alias("__b"), F.xxhash64("schema").alias("__s"))
    hours = spread.groupBy("table_name", "__b", "__s", "schema").agg(F.min("at").alias("at"))
    mixed = hours.groupBy("table_name", "__b").agg(F.count("*").alias("n"), F.first("__s").alias("__s"), F.min("at").alias("at"))
    plain = mixed.filter("n = 1").select("table_name", "at", F.lit(None).cast("long").alias("tie"), "__s")
    in_hour = Window.partitionBy("table_name", "__b").orderBy("at", "tie")
    split = spread.join(mixed.filter("n > 1").select("table_name", "__b"), ["table_name", "__b"], "left_semi")
    split = split.withColumn("__before", F.lag("__s").over(in_hour)).filter(~F.col("__s").eqNullSafe(F.col("__before"))).select("table_name", "at", "tie", "__s")
    # Each different text is parsed once.
    texts = hours.select("__s", "schema").distinct().groupBy("__s").agg(F.min("schema").alias("schema")).select("__s", fields_of(F.col("schema")).alias("fields"))
    stretches = plain.unionByName(split).join(texts, "__s")
    per_table = Window.partitionBy("table_name").orderBy("at", "tie")
    stretches = stretches.withColumn("__before", F.lag("fields").over(per_table)).filter(~F.col("fields").eqNullSafe(F.col("__before")))
    return stretches.select("table_name", F.col("at").alias("started_ms"), "fields")


def label_of(old, new) -> str:
    """The summary of a change between two lists of fields (E1's precedence)."""
    if old is None:
        return "INITIAL_LOAD"
    before, after = {f["field"] for f in old}, {f["field"] for f in new}
    return "NEW COLUMN" if after - before else "DROP COLUMN" if before - after else "CHANGES TYPE"


def version_log(runs: DataFrame) -> DataFrame:
    """``schema_runs`` numbered per table, with the summary of each change; the
    first is the INITIAL_LOAD (version 1).  The window is per table over its schema
    changes (a handful per table, not per data row)."""
    w = Window.partitionBy("table_name").orderBy("started_ms")
    names = lambda c: F.transform(c, lambda f: f.getField("field"))
    v = runs.withColumn("version", F.row_number().over(w)).withColumn("__old", F.lag("fields").over(w))
    label = (
        F.when(F.col("__old").isNull(), "INITIAL_LOAD")
        .when(F.size(F.array_except(names(F.col("fields")), names(F.col("__old")))) > 0, "NEW COLUMN")
        .when(F.size(F.array_except(names(F.col("__old")), names(F.col("fields")))) > 0, "DROP COLUMN")
        .otherwise("CHANGES TYPE")
    )
    return v.select("table_name", "version", label.alias("changes_type"), "started_ms", "fields")


def column_changes(log: DataFrame) -> DataFrame:
    """What each version changed, a row per changed column: (table_name, version,
    column_name, change, type); a log of these holds every schema without a copy."""
    w = Window.partitionBy("table_name").orderBy("version")
    before = log.withColumn("__old", F.coalesce(F.lag("fields").over(w), F.expr(f"cast(array() AS {FIELDS_TYPE})")))
    named = lambda c: F.map_from_entries(F.transform(c, lambda f: F.struct(f.getField("field"), f)))
    both = before.select("table_name", "version", named(F.col("fields")).alias("new"), named(F.col("__old")).alias("old"))
    both = both.select("*", F.explode(F.array_union(F.map_keys("new"), F.map_keys("old"))).alias("column_name"))
    old, new = F.col("old").getItem(F.col("column_name")), F.col("new").getItem(F.col("column_name"))
    typed = lambda f: F.struct(f.getField("type"), f.getField("name"), f.getField("scale"))
    change = (
        F.when(old.isNull(), "added")
        .when(new.isNull(), "dropped")
        .when(~typed(old).eqNullSafe(typed(new)), "type_changed")
        .when(~old.getField("optional").eqNullSafe(new.getField("optional")), "nullability_changed")
        .when(~old.getField("default").eqNullSafe(new.getField("default")), "default_changed")
    )
    kept = F.coalesce(new, old)
    rows = both.select("table_name", "version", "column_name", change.alias("change"), kept.getField("type").alias("type"), kept.getField("name").alias("logical_name"))
    return rows.filter(F.col("change").isNotNull())


def schema_at(changes: DataFrame, versions: DataFrame) -> DataFrame:
    """The schema at any version, folded from the column changes up to it, with
    the change that this version made: (table_name, version, column_name, type,
    logical_name, change), columns that it dropped included.  ``versions``:
    (table_name, version) asked for."""
    asked = versions.select("table_name", F.col("version").alias("__at")).distinct()
    upto = asked.join(changes, "table_name").filter(F.col("version") <= F.col("__at"))
    last = upto.groupBy("table_name", "__at", "column_name").agg(F.max_by(F.struct("version", "change", "type", "logical_name"), "version").alias("c"))
    made = F.when(F.col("c.version") == F.col("__at"), F.col("c.change")).otherwise("unchanged")
    rows = last.select("table_name", F.col("__at").alias("version"), "column_name", "c.type", "c.logical_name", made.alias("change"), F.col("c.change").alias("__last"))
    return rows.filter((F.col("__last") != "dropped") | (F.col("change") == "dropped")).drop("__last")


def snapshot_log(history: DataFrame, key: str, ts_col: str) -> DataFrame:
    """Recorded schema changes numbered per table in time order."""
    w = Window.partitionBy(key).orderBy(F.col(ts_col), F.col("snapshot_id"))
    v = history.withColumn("version_schema", F.row_number().over(w))
    return v.withColumn("changes_type", F.when(F.col("version_schema") == 1, "INITIAL_LOAD").otherwise(F.col("changes_type")))


def to_schema(df: DataFrame, schema: T.StructType, defaults: Mapping[str, str] | None = None) -> DataFrame:
    """Rows in the columns of another schema: a column they lack gets its
    default, if that is a value of its type, else NULL; columns that the schema lacks
    go; the others are cast, a value that does not convert is NULL."""
    out = []
    for f in schema.fields:
        if f.name in df.columns:
            out.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit((defaults or {}).get(f.name)).try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def current_version(tables: DataFrame, history: DataFrame, key: str = "table_name") -> DataFrame:
    """Current version per table: max(version), 0 when never
    recorded; the next version is current + 1 (so 1 for a new table)."""
    mx = history.groupBy(key).agg(F.max("version_schema").alias("__mx"))
    return tables.select(key).distinct().join(mx, key, "left").select(
        key, F.coalesce("__mx", F.lit(0)).alias("current_version"), (F.coalesce("__mx", F.lit(0)) + 1).alias("next_version")
    )


def dedup_versions(history: DataFrame, key: str = "table_name") -> DataFrame:
    """Rows duplicating a (table, version) are removed, keeping the
    oldest by ``created_at`` (then id)."""
    w = Window.partitionBy(key, "version_schema").orderBy(F.col("created_at"), F.col("history_id"))
    return history.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def duplicate_versions(history: DataFrame, key: str = "table_name") -> DataFrame:
    """A13 detection: (table, version) groups with more than one row."""
    return history.groupBy(key, "version_schema").agg(F.count("*").alias("n")).filter(F.col("n") > 1)


_CAST = r"^'([^']*)'::[\w\s]+"


def parse_default(text: Column) -> Column:
    """E5: source default expression -> warehouse literal/expression (NULL
    when it has no meaningful equivalent, e.g. sequences)."""
    s = F.trim(text)
    low = F.lower(s)
    return (
        F.when(s.isNull() | (s == ""), F.lit(None))
        .when(low.contains("nextval"), F.lit(None))
        # A cast literal ('x'::type, prefix match) is checked before anything
        # else, so '{}'::jsonb comes out as the quoted text '{}'.
        .when(s.rlike(_CAST), F.concat(F.lit("'"), F.regexp_extract(s, _CAST, 1), F.lit("'")))
        .when(s.startswith("'") & s.endswith("'"), s)
        .when(s.try_cast("double").isNotNull(), s)
        .when(low.isin("true", "false"), F.upper(s))
        .when(low.contains("current_timestamp"), F.lit("CURRENT_TIMESTAMP()"))
        .when(low.contains("current_date"), F.lit("CURRENT_DATE()"))
        .when(low.contains("now()"), F.lit("CURRENT_TIMESTAMP()"))
    )


def is_literal(parsed: Column) -> Column:
    """Whether a parsed default is a plain literal (quoted string, boolean or
    number) -- only those may fill a newly added column."""
    s = F.trim(parsed)
    return (s.startswith("'") & s.endswith("'")) | F.upper(s).isin("TRUE", "FALSE") | s.try_cast("double").isNotNull()


def evolve(df: DataFrame, add: Mapping[str, tuple[str, str | None]] = None, drop=(), retype: Mapping[str, str] = None) -> DataFrame:
    """Apply a schema change to a target's rows: added columns get their
    literal default (NULL when the default is not a literal), dropped columns
    go, retyped columns are ``try_cast`` (a value that does not convert is
    NULL rather than a failed batch)."""
    add = add or {}
    retype = retype or {}
    out = []
    for c in df.columns:
        if c in drop:
            continue
        out.append(F.col(c).try_cast(retype[c]).alias(c) if c in retype else F.col(c))
    for name, (type_name, literal) in add.items():
        value = F.lit(None).cast(type_name)
        if literal is not None:
            lit_text = literal.strip()
            if lit_text.startswith("'") and lit_text.endswith("'"):
                lit_text = lit_text[1:-1]
            value = F.lit(lit_text).try_cast(type_name)
        out.append(value.alias(name))
    return df.select(*out)


def refresh_candidates(changes: DataFrame, branches: DataFrame, pipelines: DataFrame, running: str = "START") -> DataFrame:
    """Running pipelines with a branch on a table whose schema changed."""
    hit = branches.join(changes.select("table_name").distinct(), "table_name", "left_semi")
    return hit.join(pipelines.filter(F.col("status") == running).select("pipeline_id"), "pipeline_id", "left_semi").select("pipeline_id").distinct()


def catalog_to_struct(rows: list[dict]) -> T.StructType:
    """K8: a Spark schema from catalog rows (decoded types, NOT NULL kept)."""
    fields = []
    for r in sorted(rows, key=lambda r: r["ordinal"]):
        fields.append(T.StructField(r["column_name"], T._parse_datatype_string(r["spark_type"]), bool(r.get("is_nullable", True))))
    return T.StructType(fields)
