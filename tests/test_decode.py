import base64
import decimal

from pyspark.sql import functions as F

from tidemark.functions import decode as DC


def _b64(n: int) -> str:
    length = max(1, (n.bit_length() + 8) // 8)
    return base64.b64encode(n.to_bytes(length, "big", signed=True)).decode()


def test_decimal_two_complement_wide(spark):
    values = [0, 1, -1, 127, 128, -128, -129, 255, 10**20 + 7, -(10**20) - 7, 10**37 + 9, -(10**37) - 9]
    df = spark.createDataFrame([(_b64(v), str(v)) for v in values], "b string, want string")
    got = df.select(DC.unscaled_from_base64(F.col("b")).cast("string").alias("got"), "want").collect()
    assert all(r.got == r.want for r in got), got


def test_decimal_scale_exact(spark):
    df = spark.createDataFrame([(_b64(-5),), (_b64(12345),), (_b64(-1234567890123456789),)], "b string")
    got = [r[0] for r in df.select(DC.decimal_from_base64(F.col("b"), 4).cast("string")).collect()]
    assert got == ["-0.0005", "1.2345", "-123456789012345.6789"]


def test_decimal_round_trip(spark):
    df = spark.createDataFrame([(1.25,), (-99999.99,), (0.01,)], "x double")
    back = df.select(DC.decimal_from_base64(DC.decimal_to_base64(F.col("x"), 2), 2, 12).alias("d")).collect()
    assert [r.d for r in back] == [decimal.Decimal("1.25"), decimal.Decimal("-99999.99"), decimal.Decimal("0.01")]


def test_times(spark):
    df = spark.createDataFrame([(0,), (3_723_000_001,), (86_399_999_999,)], "us long")
    got = [r[0] for r in df.select(DC.time_from_epoch(F.col("us"), "us")).collect()]
    assert got == ["00:00:00", "01:02:03.000001", "23:59:59.999999"]


def test_zoned(spark):
    df = spark.createDataFrame([("2024-01-15T10:30:00Z",), ("2024-01-15T20:30:00.5-05:00",), ("2024-01-15T10:30:00",)], "s string")
    got = [r[0] for r in df.select(DC.normalize_timestamptz(F.col("s"), "Asia/Jakarta")).collect()]
    assert got == ["2024-01-15T17:30:00+07:00", "2024-01-16T08:30:00.500000+07:00", "2024-01-15T10:30:00"]
    t = spark.createDataFrame([("14:30:00+00:00",), ("23:30:00.25+05:30",), ("10:00:00",)], "s string")
    got = [r[0] for r in t.select(DC.normalize_timetz(F.col("s"), "Asia/Jakarta")).collect()]
    assert got == ["21:30:00+07:00", "01:00:00.250000+07:00", "10:00:00"]


def test_json_and_arrays(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("plain",), ("5",)], "s string")
    got = [r[0] for r in df.select(DC.normalize_json(F.col("s"))).collect()]
    assert got == ['{"a": 1}', '"plain"', "5"]
    arr = spark.createDataFrame([(["a", 'b"c', None],)], "a array<string>")
    assert arr.select(DC.array_literal(F.col("a"))).first()[0] == '{"a","b\\"c",NULL}'
