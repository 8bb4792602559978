"""Dead-letter tables: the reference's queue test cases as table tests."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dlq as Q

NOW = "2024-01-31 00:00:00"


@pytest.fixture(scope="module")
def msgs(spark):
    base = dt.datetime(2024, 1, 30)
    rows = []
    for i in range(7):
        rows.append((i, 1, "users", 2, "u", i % 11, base - dt.timedelta(days=i * 2)))
    rows.append((100, 1, "public.orders.v2", 3, "d", 0, base))
    return spark.createDataFrame(rows, "msg_id long, source_id int, table_name string, destination_id int, op string, retry_count int, first_failed_at timestamp_ntz")


def test_depth(msgs):
    d = {(r.table_name, r.destination_id): r.depth for r in Q.depth(msgs).collect()}
    assert d == {("users", 2): 7, ("public.orders.v2", 3): 1}


def test_batch_limit(msgs):
    got = sorted(r.msg_id for r in Q.batch(msgs, "msg_id", 3).filter(F.col("table_name") == "users").collect())
    assert got == [0, 1, 2]


def test_cap_keeps_newest(msgs):
    got = sorted(r.msg_id for r in Q.cap(msgs, "msg_id", 5).filter(F.col("table_name") == "users").collect())
    assert got == [2, 3, 4, 5, 6]


def test_ack_empties_queue(msgs):
    assert Q.ack(msgs, msgs, "msg_id").count() == 0


def test_purge_by_retry_and_age(msgs):
    left = sorted(r.msg_id for r in Q.purge(msgs, NOW, max_retry=5, max_age_days=7).collect())
    # ages 1, 3, 5, 7, 9, 11, 13 days: older than 7 days purges ids 4-6 (id 3 is
    # exactly 7 days old and stays); retry >= 5 would also purge ids 5, 6
    assert left == [0, 1, 2, 3, 100]


def test_retry_split(msgs):
    out = {r.msg_id: (r.retry_count, r.action) for r in Q.retry_split(msgs, max_retry=3).collect()}
    assert out[0] == (1, "requeue") and out[2] == (3, "discard")


def test_queue_key_round_trip_with_dots(spark, msgs):
    q = Q.queues(msgs, "test:dlq")
    s, t, d = Q.parse_queue_key(F.col("queue_key"), "test:dlq")
    got = {r.queue_key: (r.s, r.t, r.d) for r in q.select("queue_key", s.alias("s"), t.alias("t"), d.alias("d")).collect()}
    assert got["test:dlq:s1:tusers:d2"] == (1, "users", 2)
    assert got["test:dlq:s1:tpublic.orders.v2:d3"] == (1, "public.orders.v2", 3)
    bad = spark.createDataFrame([("other:s1:tx:d1",)], "k string")
    assert bad.select(Q.parse_queue_key(F.col("k"), "test:dlq")[0]).first()[0] is None


def test_round_trip(msgs):
    from pyspark.sql import types as T

    body = ["op", "retry_count", "first_failed_at"]
    schema = T.StructType([f for f in msgs.schema.fields if f.name in body])
    back = Q.restore(Q.serialize(msgs, body), schema)
    assert sorted(map(tuple, back.select(*msgs.columns).collect())) == sorted(map(tuple, msgs.collect()))


def test_delete_queue(msgs):
    assert Q.delete_queue(msgs, 1, "users", 2).count() == 1
