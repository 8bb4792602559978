"""Column decoders for change-log values.

Each function maps a Column to a Column; a table is decoded by one ``select``
built from its type catalog (``decode_columns``), so decoding runs inside
whole-stage codegen on the executors and never row by row in Python.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Logical type names carried in the change-log schema.
DECIMAL = "org.apache.kafka.connect.data.Decimal"
DATE = "io.debezium.time.Date"
TS_MILLI = "io.debezium.time.Timestamp"
TS_MICRO = "io.debezium.time.MicroTimestamp"
TS_NANO = "io.debezium.time.NanoTimestamp"
ZONED_TS = "io.debezium.time.ZonedTimestamp"
TIME_MILLI = "io.debezium.time.Time"
TIME_MICRO = "io.debezium.time.MicroTime"
TIME_NANO = "io.debezium.time.NanoTime"
ZONED_TIME = "io.debezium.time.ZonedTime"
JSON_TYPE = "io.debezium.data.Json"
GEOMETRY = "io.debezium.data.geometry.Geometry"
GEOGRAPHY = "io.debezium.data.geometry.Geography"

DEFAULT_TZ = "Asia/Jakarta"
MICROS_PER_DAY = 86_400_000_000


# ---------------------------------------------------------------- numbers


def _byte(hex_col: Column, i: Column) -> Column:
    return F.conv(F.substring(hex_col, i * 2 - 1, 2), 16, 10).cast("int")


def _fold_unscaled(h: Column, n: Column) -> Column:
    """Any width: fold the bytes left to right starting from -1 when the sign
    bit is set (two's complement), in DECIMAL(38,0); overflow -> NULL."""
    init = F.when(_byte(h, F.lit(1)) >= 128, F.lit(-1).cast("decimal(38,0)")).otherwise(F.lit(0).cast("decimal(38,0)"))
    return F.aggregate(
        F.sequence(F.lit(1), n),
        init,
        lambda acc, i: F.try_add(F.try_multiply(acc, F.lit(256).cast("decimal(38,0)")), _byte(h, i).cast("decimal(38,0)")).cast("decimal(38,0)"),
    )


def _signed64(h: Column) -> Column:
    """Up to 8 bytes: sign-extend the hex to 16 digits and read it as a
    signed 64-bit number (``conv`` with a negative target base)."""
    fill = F.when(F.substring(h, 1, 1).isin("8", "9", "A", "B", "C", "D", "E", "F"), F.lit("F")).otherwise(F.lit("0"))
    return F.conv(F.lpad(h, 16, fill), 16, -10)


def unscaled_from_base64(b64: Column) -> Column:
    """Big-endian two's-complement bytes (base64) -> DECIMAL(38,0), exact.

    Up to 8 bytes (the usual width) it is one ``conv``; wider values fold the
    bytes in decimal arithmetic.  Overflow beyond 38 digits gives NULL, which
    callers route to the dead-letter table."""
    h = F.hex(F.unbase64(b64))
    n = (F.length(h) / 2).cast("int")
    return (
        F.when(F.length(h) == 0, F.lit(None).cast("decimal(38,0)"))
        .when(n <= 8, _signed64(h).cast("decimal(38,0)"))
        .otherwise(_fold_unscaled(h, n))
    )


def scale_decimal(unscaled: Column, scale: int, precision: int = 38) -> Column:
    """unscaled * 10^-scale as DECIMAL(precision, scale) without any floating
    point step: the decimal point is placed in the digit string."""
    if scale == 0:
        return unscaled.try_cast(T.DecimalType(precision, 0))
    plain = F.abs(unscaled).cast("string")
    digits = F.when(F.length(plain) <= scale, F.lpad(plain, scale + 1, "0")).otherwise(plain)
    cut = F.length(digits) - F.lit(scale)
    sign = F.when(unscaled < 0, F.lit("-")).otherwise(F.lit(""))
    whole = F.concat(sign, F.left(digits, cut), F.lit("."), F.right(digits, F.lit(scale)))
    return F.when(unscaled.isNotNull(), whole.try_cast(T.DecimalType(precision, scale)))


def decimal_from_base64(b64: Column, scale: int, precision: int = 38) -> Column:
    """Change-log decimal (base64 bytes + declared scale) -> exact DECIMAL.

    Fast path (<= 8 bytes, scale <= 16): DECIMAL(20,0) times the literal
    10^-scale is exact (result precision <= 38, no rounding)."""
    import decimal

    h = F.hex(F.unbase64(b64))
    n = (F.length(h) / 2).cast("int")
    target = T.DecimalType(precision, scale)
    if scale <= 16:
        factor = F.lit(decimal.Decimal(1).scaleb(-scale))
        fast = (_signed64(h).cast("decimal(20,0)") * factor).try_cast(target)
    else:
        fast = scale_decimal(_signed64(h).cast("decimal(38,0)"), scale, precision)
    wide = scale_decimal(_fold_unscaled(h, n), scale, precision)
    return F.when(F.length(h) == 0, F.lit(None).cast(target)).when(n <= 8, fast).otherwise(wide)


def decimal_to_base64(value: Column, scale: int) -> Column:
    """Inverse of ``decimal_from_base64`` for values whose unscaled form fits a
    long: 8-byte big-endian two's complement, base64."""
    unscaled = F.round(value * F.lit(10**scale)).cast("long")
    return F.base64(F.unhex(F.lpad(F.hex(unscaled), 16, "0")))


# ---------------------------------------------------------------- dates and times


def date_from_days(days: Column) -> Column:
    """Days since 1970-01-01 -> DATE."""
    return F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))


def _floor_div(c: Column, d: int) -> Column:
    """Exact floor division of a long by a small constant (via decimal; a
    double quotient loses digits beyond 2^53)."""
    return F.floor(c.cast("decimal(20,0)") / F.lit(d).cast("decimal(20,0)")).cast("long")


def timestamp_from_epoch(value: Column, unit: str) -> Column:
    """Epoch count in ms / us / ns -> TIMESTAMP_NTZ, no zone shift
    (nanoseconds truncate to microseconds by integer division)."""
    v = value.cast("long")
    if unit == "ms":
        micros = v * F.lit(1000)
    elif unit == "us":
        micros = v
    elif unit == "ns":
        micros = _floor_div(v, 1000)
    else:
        raise ValueError(f"unit must be ms, us or ns, not {unit!r}")
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def micros_of_day(value: Column, unit: str) -> Column:
    v = value.cast("long")
    if unit == "ms":
        return v * F.lit(1000)
    if unit == "us":
        return v
    if unit == "ns":
        return _floor_div(v, 1000)
    raise ValueError(f"unit must be ms, us or ns, not {unit!r}")


def format_time_of_day(micros: Column, always_fraction: bool = False) -> Column:
    """Microseconds since midnight -> ``HH:MM:SS`` plus ``.ffffff`` when the
    fraction is non-zero (or always)."""
    us = F.pmod(micros, F.lit(MICROS_PER_DAY))
    secs = _floor_div(us, 1_000_000)
    frac = F.pmod(us, F.lit(1_000_000))
    hms = F.format_string("%02d:%02d:%02d", (secs / 3600).cast("int"), (F.pmod(secs, F.lit(3600)) / 60).cast("int"), F.pmod(secs, F.lit(60)).cast("int"))
    frac_text = F.concat(F.lit("."), F.lpad(frac.cast("string"), 6, "0"))
    if always_fraction:
        return F.concat(hms, frac_text)
    return F.concat(hms, F.when(frac != 0, frac_text).otherwise(F.lit("")))


def time_from_epoch(value: Column, unit: str) -> Column:
    """P5: time of day in ms / us / ns -> ``HH:MM:SS[.ffffff]``."""
    return format_time_of_day(micros_of_day(value, unit))


def format_ntz(ts: Column) -> Column:
    """Zone-less timestamp as ``YYYY-MM-DDTHH:MM:SS.ffffff`` (always 6 digits)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _offset_text(seconds: Column) -> Column:
    sign = F.when(seconds < 0, F.lit("-")).otherwise(F.lit("+"))
    a = F.abs(seconds)
    return F.concat(sign, F.format_string("%02d:%02d", (a / 3600).cast("int"), F.pmod(a / 60, F.lit(60)).cast("int")))


ISO_TS = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2})(\.\d+)?(Z|[+-]\d{2}(:?\d{2})?)?$"


def _offset_seconds(text: Column) -> Column:
    """``Z`` / ``+HH`` / ``+HH:MM`` / ``+HHMM`` -> seconds east of UTC."""
    t = F.regexp_replace(text, ":", "")
    sign = F.when(F.substring(t, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    hh = F.substring(t, 2, 2).cast("int")
    mm = F.coalesce(F.nullif(F.substring(t, 4, 2), F.lit("")).cast("int"), F.lit(0))
    return F.when(text == "Z", F.lit(0)).otherwise(sign * (hh * 3600 + mm * 60))


ZONE_SUFFIX = r"(Z|[+-]\d{2}(:?\d{2})?)$"


def _iso_local_text(local: Column, offset_seconds: Column, date_part: bool = True) -> Column:
    """``[YYYY-MM-DDT]HH:MM:SS[.ffffff]+HH:MM`` of a wall-clock timestamp."""
    us = F.pmod(F.unix_micros(local), F.lit(1_000_000))
    frac = F.when(us != 0, F.concat(F.lit("."), F.lpad(us.cast("string"), 6, "0"))).otherwise(F.lit(""))
    pattern = "yyyy-MM-dd'T'HH:mm:ss" if date_part else "HH:mm:ss"
    return F.concat(F.date_format(local, pattern), frac, _offset_text(offset_seconds))


def normalize_timestamptz(iso: Column, tz: str = DEFAULT_TZ) -> Column:
    """ISO timestamp with zone -> the same instant in ``tz`` as ISO text
    (``YYYY-MM-DDTHH:MM:SS[.ffffff]+HH:MM``).  Zone-less or unparsable text is
    returned unchanged.  Parsing is Spark's ISO-8601 cast (Z, +hh, +hhmm,
    +hh:mm); the session zone is UTC."""
    s = F.trim(iso)
    instant = s.try_cast("timestamp")
    local = F.from_utc_timestamp(instant, tz)
    offset = ((F.unix_micros(local) - F.unix_micros(instant)) / F.lit(1_000_000)).cast("long")
    ok = s.rlike(ISO_TS) & s.rlike(ZONE_SUFFIX) & instant.isNotNull()
    return F.when(ok, _iso_local_text(local, offset)).otherwise(iso)


ISO_TIME = r"^(\d{2}):(\d{2}):(\d{2})(\.\d+)?(Z|[+-]\d{2}(:?\d{2})?)?$"


def zone_offset_seconds(tz: str, on: str = "2000-01-01 00:00:00") -> Column:
    """Fixed UTC offset of ``tz`` on a given day (times with zone have no date;
    the offset of a fixed dummy day is used)."""
    ref = F.lit(on).cast("timestamp")
    return ((F.unix_micros(F.from_utc_timestamp(ref, tz)) - F.unix_micros(ref)) / F.lit(1_000_000)).cast("long")


def normalize_timetz(iso: Column, tz: str = DEFAULT_TZ) -> Column:
    """``HH:MM:SS[.f](Z|+HH[:MM])`` -> the same moment at ``tz``'s offset,
    ``HH:MM:SS[.ffffff]+HH:MM``; zone-less text is returned unchanged.  A time
    has no date: it is placed on a fixed day and shifted by the zone's offset
    on that day."""
    s = F.trim(iso)
    instant = F.concat(F.lit("2000-01-01T"), s).try_cast("timestamp")
    target = zone_offset_seconds(tz)
    local = F.timestamp_micros(F.unix_micros(instant) + target * F.lit(1_000_000))
    ok = s.rlike(ISO_TIME) & s.rlike(ZONE_SUFFIX) & instant.isNotNull()
    return F.when(ok, _iso_local_text(local, target, date_part=False)).otherwise(iso)


UNTYPED_TS = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?([+-]\d{2}:?\d{0,2}|Z)?$"
UNTYPED_TIME_TZ = r"^\d{2}:\d{2}:\d{2}(\.\d+)?([+-]\d{2}:?\d{0,2})$"


def normalize_untyped_time(text: Column, tz: str = DEFAULT_TZ) -> Column:
    """A string with no declared type that looks like an ISO timestamp with
    a zone is converted to ``tz``; a zone-less one is trimmed; a time with an
    offset is shifted; anything else is unchanged."""
    s = F.trim(text)
    has_zone = s.contains("+") | s.contains("Z") | (F.size(F.split(s, "-")) > 3)
    return (
        F.when(s.rlike(UNTYPED_TS) & has_zone, normalize_timestamptz(s, tz))
        .when(s.rlike(UNTYPED_TS), s)
        .when(s.rlike(UNTYPED_TIME_TZ), normalize_timetz(s, tz))
        .otherwise(text)
    )


# ---------------------------------------------------------------- text-like values


def json_string_literal(text: Column) -> Column:
    """A string as a JSON string literal (quoted and escaped)."""
    wrapped = F.to_json(F.array(text))
    return F.regexp_extract(wrapped, r"^\[(.*)\]$", 1)


def normalize_json(text: Column) -> Column:
    """JSON column value: valid JSON text is kept as it is, anything else
    is stored as a JSON string."""
    return F.when(text.isNull(), F.lit(None)).when(F.try_parse_json(text).isNotNull(), text).otherwise(json_string_literal(text))


def array_literal(arr: Column, element_type: str = "string") -> Column:
    """P10: array -> PostgreSQL array literal ``{a,b}``; strings quoted with
    inner quotes escaped, NULL elements as ``NULL``."""
    if element_type == "string":
        item = lambda x: F.when(x.isNull(), F.lit("NULL")).otherwise(
            F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('\\"')), F.lit('"'))
        )
    else:
        item = lambda x: F.when(x.isNull(), F.lit("NULL")).otherwise(x.cast("string"))
    return F.concat(F.lit("{"), F.array_join(F.transform(arr, item), ","), F.lit("}"))


def wkb_hex(geom: Column) -> Column:
    """Geometry struct {wkb: base64, srid} -> lower-case hex WKB (NULL when
    the WKB is empty)."""
    b = F.unbase64(geom.getField("wkb"))
    return F.when(F.length(b) > 0, F.lower(F.hex(b)))


def binary_hex(b: Column) -> Column:
    """Binary -> lower-case hex."""
    return F.lower(F.hex(b))


# ---------------------------------------------------------------- whole frames


def infer_numeric_columns(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, bool]:
    """Which string columns hold only numeric strings, at least one with
    a decimal point.  One aggregation pass over all columns; the result (one
    flag per column) is tiny and drives the cast plan."""
    cols = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    if not cols:
        return {}
    aggs = []
    for c in cols:
        v = F.col(c)
        numeric = v.isNull() | F.trim(v).try_cast("double").isNotNull()
        aggs.append(F.bool_and(numeric).alias(f"{c}__num"))
        aggs.append(F.bool_or(v.contains(".")).alias(f"{c}__dot"))
        aggs.append(F.count(v).alias(f"{c}__n"))
    row = df.agg(*aggs).first()
    return {c: bool(row[f"{c}__num"]) and bool(row[f"{c}__dot"]) and row[f"{c}__n"] > 0 for c in cols}


def inference_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P13 as a relation: one row per column with its inference outcome."""
    aggs = []
    for c in columns:
        v = F.col(c)
        aggs.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.bool_and(v.isNull() | F.trim(v).try_cast("double").isNotNull()).alias("all_numeric"),
                F.coalesce(F.bool_or(v.contains(".")), F.lit(False)).alias("has_dot"),
            )
        )
    return (
        df.agg(F.array(*aggs).alias("flags"))
        .select(F.inline("flags"))
        .withColumn("inferred_double", F.col("all_numeric") & F.col("has_dot"))
    )


def apply_numeric_inference(df: DataFrame, flags: Mapping[str, bool]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if flags.get(c) else F.col(c) for c in df.columns])


def serialize_value(col: Column, data_type: T.DataType, tz: str = DEFAULT_TZ) -> Column:
    """One snapshot value as text by its type: decimals as plain digits,
    zone-less timestamps ``YYYY-MM-DDTHH:MM:SS.ffffff``, zoned ones in ``tz``
    (ISO with offset), dates ISO, binary hex; other scalars unchanged."""
    if isinstance(data_type, T.DecimalType):
        return col.cast("string")
    if isinstance(data_type, T.TimestampNTZType):
        return format_ntz(col)
    if isinstance(data_type, T.TimestampType):
        iso = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        return normalize_timestamptz(iso, tz)
    if isinstance(data_type, T.DateType):
        return F.date_format(col, "yyyy-MM-dd")
    if isinstance(data_type, T.BinaryType):
        return binary_hex(col)
    return col


def serialize_snapshot(df: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    return df.select(*[serialize_value(F.col(f.name), f.dataType, tz).alias(f.name) for f in df.schema.fields])


def cast_to_target(df: DataFrame, target: T.StructType, error_col: str = "cast_errors") -> DataFrame:
    """Cast every column to the target type with ``try_cast``; a value
    that does not convert becomes NULL and is counted in ``error_col`` (rows
    with errors > 0 are the ones to dead-letter)."""
    out, errors = [], []
    for f in target.fields:
        src = F.col(f.name)
        casted = src.try_cast(f.dataType)
        out.append(casted.alias(f.name))
        errors.append(F.when(src.isNotNull() & casted.isNull(), F.lit(1)).otherwise(F.lit(0)))
    total = errors[0]
    for e in errors[1:]:
        total = total + e
    return df.select(*out, total.alias(error_col))
