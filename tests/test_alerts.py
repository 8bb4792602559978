import random

from pyspark.sql import functions as F

from tidemark.operators import alerts as AL
from tidemark.functions import redact as R


def _reference_fold(rows, limit=3):
    state, made, out = {}, {}, {}
    for key, ts, i, forced in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        s = state.get(key, 0)
        if s > 0 and (s < limit or forced):
            s += 1
        else:
            s = 1
            made[key] = made.get(key, 0) + 1
        state[key] = s
        out[i] = (made[key], s)
    return out


def test_iteration_fold_hot_key_split(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 else f"k{i % 7}"
        rows.append((key, rnd.randint(0, 10_000), i, rnd.random() < 0.4))
    df = spark.createDataFrame(rows, "k string, ts long, id long, forced boolean")
    got = AL.iteration_fold(df, "k", ["ts", "id"], "forced", partitions=9).collect()
    want = _reference_fold(rows)
    assert {r.id: (r.notification_no, r.iteration_check) for r in got} == want


def test_throttle(spark):
    rows = [("a", 0, 1, False), ("a", 60, 2, False), ("a", 301, 3, False), ("a", 400, 4, True), ("b", 10, 5, False)]
    df = spark.createDataFrame(rows, "k string, s long, id long, acked boolean").withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    got = {r.id: r.create for r in AL.throttle(df, "k", "ts", "id", "acked").collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 5: True}


def test_redact(spark):
    text = "url postgresql://u:pw@h/db and PASSWORD: 'abc' token=xyz\n-----BEGIN PRIVATE KEY-----\nAAA\n-----END PRIVATE KEY----- Authorization: Bearer q.w.e"
    df = spark.createDataFrame([(text,)], "t string")
    out = df.select(R.redact(F.col("t"))).first()[0]
    assert "pw@" not in out and "abc" not in out and "xyz" not in out and "AAA" not in out and "q.w.e" not in out
    assert "[REDACTED]" in out and "Authorization: Bearer ***" in out


def test_error_class(spark):
    df = spark.createDataFrame([("Connection refused by host",), ("ERROR: column does not exist: x",), ("weird password=1",), ("",)], "m string")
    got = [r[0] for r in df.select(R.error_class(F.col("m"))).collect()]
    assert got == [
        "Unable to connect to destination database",
        "Column mismatch between source and destination",
        "Database authentication configuration error",
        "Unknown error occurred",
    ]


def _reference_throttle(rows, gap_s=300):
    out, last = {}, {}
    for k, s, i, acked in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        l = last.get(k)
        make = l is None or acked or s - l >= gap_s
        if make:
            last[k] = s
        out[i] = make
    return out


def test_throttle_hot_key(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(4000):
        k = "hot" if i % 3 else f"k{i % 4}"
        rows.append((k, rnd.randint(0, 200_000), i, rnd.random() < 0.05))
    df = spark.createDataFrame(rows, "k string, s long, id long, acked boolean").withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    got = {r.id: r.create for r in AL.throttle(df, "k", "ts", "id", "acked", partitions=11).collect()}
    assert got == _reference_throttle(rows)


def test_throttle_ties_and_acks(spark):
    rnd = random.Random(23)
    rows = [("hot" if i % 4 else "cold", rnd.randint(0, 3000) // 60 * 60, i, rnd.random() < 0.3) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, s long, id long, acked boolean").withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    got = {r.id: r.create for r in AL.throttle(df, "k", "ts", "id", "acked", partitions=13).collect()}
    assert got == _reference_throttle(rows)


def test_throttle_many_attempts_of_today(spark):
    """Times of today sum beyond 64 bits after some 5,000 rows of a key."""
    rnd = random.Random(31)
    rows = [("hot" if i % 20 else "cold", 1_704_067_200 + rnd.randint(0, 2_592_000), i, rnd.random() < 0.1) for i in range(20_000)]
    df = spark.createDataFrame(rows, "k string, s long, id long, acked boolean").withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    got = {r.id: r.create for r in AL.throttle(df, "k", "ts", "id", "acked", partitions=3).collect()}
    assert got == _reference_throttle(rows)
