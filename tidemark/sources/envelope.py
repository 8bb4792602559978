"""Change-event envelopes: parse, route by topic, type catalog, decode.

A raw change event is ``(topic, key, value)`` with JSON text in key and value::

    value = {"schema": {"fields": [{"field": "after", "fields": [
                 {"field", "type", "name", "optional", "parameters"}...]}...]},
             "payload": {"before": {...}, "after": {...}, "op": "c|u|d|r|m",
                         "ts_ms": 1700000000000}}
    key   = {"payload": {pk...}}  or  {pk...}

Parsing is a ``from_json`` with an explicit schema (no inference), so it runs
in the JVM and works the same in batch and in Structured Streaming.  Images
(``before``/``after``) stay JSON text until the table's column types are known;
``decode_image`` then produces exactly typed columns in one projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import decode as DC

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("schema", T.StringType()),
        T.StructField("payload", T.StringType()),
    ]
)

PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("before", T.StringType()),
        T.StructField("after", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)

FIELD_SCHEMA = T.StructType(
    [
        T.StructField("field", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("optional", T.BooleanType()),
        T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
        T.StructField("default", T.StringType()),
    ]
)

SCHEMA_SCHEMA = T.StructType(
    [
        T.StructField(
            "fields",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("field", T.StringType()),
                        T.StructField("fields", T.ArrayType(FIELD_SCHEMA)),
                    ]
                )
            ),
        )
    ]
)

RAW_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

IMAGE_OPS = ("c", "u", "r")


def topic_table(topic: Column) -> Column:
    """S3: table name = last dotted segment; NULL for topics with fewer than
    three segments (such events are skipped)."""
    parts = F.split(topic, r"\.")
    return F.when(F.size(parts) >= 3, F.element_at(parts, -1))


def topic_schema_table(topic: Column) -> Column:
    """``schema.table`` (the last two segments) -- routes two tables of the
    same name in different schemas apart."""
    parts = F.split(topic, r"\.")
    return F.when(F.size(parts) >= 3, F.concat_ws(".", F.element_at(parts, -2), F.element_at(parts, -1)))


VALUE_SCHEMA = T.StructType(
    [
        T.StructField("schema", T.StringType()),
        T.StructField("payload", PAYLOAD_SCHEMA),
    ]
)


def _parse_once(raw: DataFrame, keep: Sequence[str], parsed: Column) -> DataFrame:
    """Attach ``parsed`` as ``__v`` so that it is evaluated once per row.

    Later filters on parsed fields (heartbeats, malformed rows) would
    otherwise be pushed below the projection with the parse inlined --
    parsing every event twice.  A predicate on a generator's output cannot
    move below the generator, so the parse sits in a one-element explode."""
    return raw.select(*keep, F.explode(F.array(parsed)).alias("__v"))


def _key_text() -> Column:
    key_payload = F.get_json_object(F.col("key"), "$.payload")
    return F.when(F.col("key").isNull(), F.lit("{}")).otherwise(F.coalesce(key_payload, F.col("key")))


def _finish(parsed: DataFrame, image: Column, keep_malformed: bool, extra: Sequence[Column] = ()) -> DataFrame:
    op_raw = F.col("__v.payload.op")
    malformed = F.col("value").isNotNull() & F.col("__v.payload").isNull()
    out = parsed.select(
        F.coalesce(op_raw, F.lit("u")).alias("op"),
        topic_table(F.col("topic")).alias("table_name"),
        _key_text().alias("key"),
        image,
        *extra,
        F.col("__v.payload.ts_ms").alias("ts_ms"),
        malformed.alias("malformed"),
        F.col("value").isNull().alias("__tombstone"),
    )
    out = out.filter(~F.col("__tombstone") & F.col("table_name").isNotNull() & (F.col("op") != "m"))
    if keep_malformed:
        return out.drop("__tombstone")
    return out.filter(~F.col("malformed")).drop("__tombstone", "malformed")


def parse_envelope(raw: DataFrame, keep_malformed: bool = False) -> DataFrame:
    """Raw events -> ``(op, table_name, key, value, schema, ts_ms)``.

    * ``c``/``u``/``r`` carry the after-image, ``d`` the before-image;
    * ``m`` (heartbeat) events are dropped;
    * an unknown op carries the whole payload; a missing op means ``u``;
    * tombstones (NULL value) and events whose topic has < 3 segments are
      dropped;
    * malformed JSON is dropped, or kept with ``malformed = true`` when
      ``keep_malformed`` (so the caller can dead-letter it).

    One ``from_json`` per event; images stay JSON text (see
    ``parse_table_changes`` for the typed single-pass form)."""
    parsed = _parse_once(raw, ["topic", "key", "value"], F.from_json(F.col("value"), VALUE_SCHEMA))
    op_raw = F.col("__v.payload.op")
    image = (
        F.when(op_raw.isin(*IMAGE_OPS), F.col("__v.payload.after"))
        .when(op_raw == "d", F.col("__v.payload.before"))
        .otherwise(F.coalesce(F.to_json(F.col("__v.payload")), F.lit("{}")))
    )
    return _finish(parsed, image.alias("value"), keep_malformed, [F.col("__v.schema").alias("schema")])


def parse_table_changes(
    raw: DataFrame,
    fields: Sequence[dict],
    keep: Sequence[str] = (),
    keep_malformed: bool = False,
    tz: str = DC.DEFAULT_TZ,
    count_errors: bool = False,
) -> DataFrame:
    """S2 + decode in one pass for a table whose column types are known: the
    before/after images are parsed straight into their wire types by the same
    ``from_json`` that reads the envelope, then decoded column by column.
    Output: ``op, table_name, key, ts_ms`` + the table's columns, and with
    ``count_errors`` a ``decode_errors`` column: how many of the row's values
    were present on the wire but could not be decoded (rows to dead-letter)."""
    image_type = wire_schema(fields)
    schema = T.StructType(
        [
            T.StructField(
                "payload",
                T.StructType(
                    [
                        T.StructField("before", image_type),
                        T.StructField("after", image_type),
                        T.StructField("op", T.StringType()),
                        T.StructField("ts_ms", T.LongType()),
                    ]
                ),
            )
        ]
    )
    parsed = _parse_once(raw, ["topic", "key", "value", *keep], F.from_json(F.col("value"), schema))
    op_raw = F.col("__v.payload.op")
    image = F.when(op_raw == "d", F.col("__v.payload.before")).otherwise(F.col("__v.payload.after"))
    staged = _finish(parsed, image.alias("__img"), keep_malformed, [F.col(c) for c in keep])
    base = [c for c in staged.columns if c != "__img"]
    decoded = staged.select(*base, "__img", *[decode_field(F.col(f"__img.{f['field']}"), f, tz).alias(f["field"]) for f in fields])
    if count_errors:
        errors = [F.when(F.col(f"__img.{f['field']}").isNotNull() & F.col(f["field"]).isNull(), 1).otherwise(0) for f in fields]
        total = errors[0]
        for e in errors[1:]:
            total = total + e
        decoded = decoded.withColumn("decode_errors", total.cast("int"))
    return decoded.drop("__img")


def schema_text(value: Column) -> Column:
    """The schema block of an event as it came (NULL without one)."""
    return F.from_json(value, T.StructType([T.StructField("schema", T.StringType())])).getField("schema")


def changes_schema(fields: Sequence[dict], tz: str = DC.DEFAULT_TZ) -> T.StructType:
    """The columns that ``parse_table_changes`` gives for a table's fields (a field
    may name its ``spark_type`` instead of its wire type)."""
    from pyspark.sql import SparkSession

    wire = [f for f in fields if "spark_type" not in f]
    parsed = parse_table_changes(SparkSession.getActiveSession().createDataFrame([], RAW_EVENT_SCHEMA), wire, tz=tz).schema
    typed = {f["field"]: f["spark_type"] for f in fields if "spark_type" in f}
    names = [f.name for f in parsed.fields[: len(parsed.fields) - len(wire)]]
    return T.StructType([parsed[n] for n in names] + [T.StructField(f["field"], typed.get(f["field"]) or parsed[f["field"]].dataType) for f in fields])


def type_catalog(parsed: DataFrame, image: str = "after") -> DataFrame:
    """Column types per table from the envelope schema:
    ``(table_name, field, type, name, optional, scale, n_events)``.

    The result has one row per (table, column) -- bounded by the width of the
    source tables, not by the number of events -- so it may be collected to
    build the decode projection."""
    # Messages repeat their table's schema: count each distinct schema text
    # first (a partial aggregate), then parse each distinct text once.
    return _catalog_rows(parsed.groupBy("table_name", "schema").agg(F.count("*").alias("__n")), image)


def _catalog_rows(distinct: DataFrame, image: str) -> DataFrame:
    fields = F.from_json(F.col("schema"), SCHEMA_SCHEMA).getField("fields")
    wanted = F.filter(fields, lambda f: f.getField("field") == image)
    exploded = distinct.select(
        "table_name",
        "__n",
        F.explode(F.flatten(F.transform(wanted, lambda f: f.getField("fields")))).alias("f"),
    )
    return exploded.groupBy(
        "table_name",
        F.col("f.field").alias("field"),
        F.col("f.type").alias("type"),
        F.col("f.name").alias("name"),
        F.coalesce(F.col("f.optional"), F.lit(True)).alias("optional"),
        F.col("f.parameters").getItem("scale").cast("int").alias("scale"),
    ).agg(F.sum("__n").alias("n_events"))


def type_catalog_raw(raw: DataFrame, image: str = "after") -> DataFrame:
    """P1 straight from raw events: only the topic and the envelope's schema
    part are read (the payload is skipped by the parser), distinct schema
    texts are counted, and each distinct text is parsed once."""
    schemas = raw.select(
        topic_table(F.col("topic")).alias("table_name"),
        F.from_json(F.col("value"), T.StructType([T.StructField("schema", T.StringType())])).getField("schema").alias("schema"),
    )
    # Filter after counting (on the few distinct rows), so the parse is not
    # duplicated into a pushed-down predicate.
    distinct = schemas.groupBy("table_name", "schema").agg(F.count("*").alias("__n"))
    distinct = distinct.filter(F.col("table_name").isNotNull() & F.col("schema").isNotNull())
    return _catalog_rows(distinct, image)


_WIRE_TYPES = {
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float": T.FloatType(),
    "float32": T.FloatType(),
    "double": T.DoubleType(),
    "float64": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "bytes": T.StringType(),
    "struct": T.StructType([T.StructField("wkb", T.StringType()), T.StructField("srid", T.IntegerType())]),
    "array": T.ArrayType(T.StringType()),
}


def wire_schema(fields: Sequence[dict]) -> T.StructType:
    """The JSON shape of an image given its catalog rows."""
    out = []
    for f in fields:
        wire = _WIRE_TYPES.get((f.get("type") or "string").lower(), T.StringType())
        if f.get("name") in (DC.DECIMAL,):
            wire = T.StringType()
        if f.get("name") == DC.JSON_TYPE:
            wire = T.StringType()
        out.append(T.StructField(f["field"], wire))
    return T.StructType(out)


def decode_field(c: Column, f: dict, tz: str = DC.DEFAULT_TZ, precision: int | None = None) -> Column:
    """Decode one wire value by its logical type name."""
    name = f.get("name")
    if name == DC.DECIMAL:
        scale = int(f.get("scale") or 0)
        return DC.decimal_from_base64(c, scale, precision or 38)
    if name == DC.DATE:
        return DC.date_from_days(c)
    if name == DC.TS_MILLI:
        return DC.timestamp_from_epoch(c, "ms")
    if name == DC.TS_MICRO:
        return DC.timestamp_from_epoch(c, "us")
    if name == DC.TS_NANO:
        return DC.timestamp_from_epoch(c, "ns")
    if name == DC.ZONED_TS:
        return DC.normalize_timestamptz(c, tz)
    if name == DC.TIME_MILLI:
        return DC.time_from_epoch(c, "ms")
    if name == DC.TIME_MICRO:
        return DC.time_from_epoch(c, "us")
    if name == DC.TIME_NANO:
        return DC.time_from_epoch(c, "ns")
    if name == DC.ZONED_TIME:
        return DC.normalize_timetz(c, tz)
    if name == DC.JSON_TYPE:
        return DC.normalize_json(c)
    if name in (DC.GEOMETRY, DC.GEOGRAPHY):
        return DC.wkb_hex(c)
    if (f.get("type") or "").lower() == "bytes":
        return DC.binary_hex(F.unbase64(c))
    return c


def decode_image(df: DataFrame, fields: Sequence[dict], image_col: str = "value", keep: Sequence[str] = (), tz: str = DC.DEFAULT_TZ) -> DataFrame:
    """Decode the JSON image column into typed columns (one projection)."""
    parsed = F.from_json(F.col(image_col), wire_schema(fields))
    staged = df.select(*keep, parsed.alias("__img"))
    return staged.select(*keep, *[decode_field(F.col(f"__img.{f['field']}"), f, tz).alias(f["field"]) for f in fields])


# ---------------------------------------------------------------- encoding (sources for tests)


def field_entry(
    field: str, wire_type: str, name: str | None = None, optional: bool = True, scale: int | None = None, default: str | None = None
) -> dict:
    """One column of an envelope's schema block."""
    entry = {} if default is None else {"default": default}
    return entry | {
        "field": field,
        "type": wire_type,
        "name": name,
        "optional": optional,
        "parameters": {"scale": str(scale)} if scale is not None else None,
    }


def schema_json(fields: Sequence[dict]) -> str:
    """The envelope's schema block as JSON text (rendered once per table)."""
    import json

    return json.dumps({"fields": [{"field": "after", "fields": list(fields)}]}, separators=(",", ":"))


def encode_envelope(
    df: DataFrame,
    topic: Column,
    key_cols: Sequence[str],
    image: Column,
    fields: Sequence[dict],
    op: Column,
    ts_ms: Column,
    key_wrapped: Column | None = None,
) -> DataFrame:
    """Build raw events ``(topic, key, value)`` from typed rows -- the shape a
    change-capture connector writes (used to derive change logs from tables
    and in tests).  ``image`` is a struct of wire values; the schema block is
    rendered once and spliced into every message."""
    key_struct = F.struct(*[F.col(k) for k in key_cols])
    key = F.to_json(key_struct)
    if key_wrapped is not None:
        key = F.when(key_wrapped, F.to_json(F.struct(key_struct.alias("payload")))).otherwise(key)
    payload = F.struct(
        F.when(op == "d", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        op.alias("op"),
        ts_ms.alias("ts_ms"),
    )
    value = F.concat(F.lit('{"schema":' + schema_json(fields) + ',"payload":'), F.to_json(payload), F.lit("}"))
    return df.select(topic.alias("topic"), key.alias("key"), value.alias("value"))
