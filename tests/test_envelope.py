import json

from pyspark.sql import functions as F

from tidemark.sources import envelope as EV


def _ev(topic, key, payload):
    return (topic, json.dumps(key) if key is not None else None, json.dumps({"payload": payload}) if payload is not None else None)


def test_parse_rules(spark):
    rows = [
        _ev("db.public.users", {"payload": {"id": 1}}, {"op": "c", "after": {"id": 1, "n": "a"}, "ts_ms": 10}),
        _ev("db.public.users", {"id": 2}, {"op": "d", "before": {"id": 2, "n": "b"}, "ts_ms": 11}),
        _ev("db.public.users", {"id": 3}, {"op": "m", "ts_ms": 12}),  # heartbeat
        _ev("db.public.users", {"id": 4}, None),  # tombstone
        _ev("public.users", {"id": 5}, {"op": "c", "after": {"id": 5}, "ts_ms": 13}),  # 2 segments
        _ev("db.public.users", {"id": 6}, {"op": "x", "after": {"id": 6}, "ts_ms": 14}),  # unknown op
        _ev("db.public.users", {"id": 7}, {"after": {"id": 7}, "ts_ms": 15}),  # missing op
        ("db.public.users", '{"id": 8}', "{not json"),
    ]
    raw = spark.createDataFrame(rows, EV.RAW_EVENT_SCHEMA)
    out = {json.loads(r.key)["id"]: r for r in EV.parse_envelope(raw, keep_malformed=True).collect()}
    assert set(out) == {1, 2, 6, 7, 8}
    assert out[1].op == "c" and json.loads(out[1].value) == {"id": 1, "n": "a"} and out[1].table_name == "users"
    assert out[2].op == "d" and json.loads(out[2].value)["n"] == "b"
    assert out[6].op == "x" and json.loads(out[6].value)["op"] == "x"  # whole payload
    assert out[7].op == "u"
    assert out[8].malformed and not out[1].malformed
    assert EV.parse_envelope(raw).count() == 4


def test_typed_parse_matches_generic(spark):
    fields = [{"field": "id", "type": "int64", "name": None}, {"field": "n", "type": "string", "name": None}]
    rows = [
        _ev("db.public.users", {"id": 1}, {"op": "u", "after": {"id": 1, "n": "a"}, "ts_ms": 10}),
        _ev("db.public.users", {"id": 2}, {"op": "d", "before": {"id": 2, "n": "b"}, "ts_ms": 11}),
        _ev("db.public.users", {"id": 3}, {"op": "m", "ts_ms": 12}),
    ]
    raw = spark.createDataFrame(rows, EV.RAW_EVENT_SCHEMA)
    typed = sorted((r.op, r.id, r.n, r.ts_ms) for r in EV.parse_table_changes(raw, fields).collect())
    generic = EV.decode_image(EV.parse_envelope(raw), fields, keep=["op", "ts_ms"])
    assert typed == sorted((r.op, r.id, r.n, r.ts_ms) for r in generic.collect()) == [("d", 2, "b", 11), ("u", 1, "a", 10)]


def test_topic_table(spark):
    df = spark.createDataFrame([("a.b.c",), ("a.b",), ("x.y.z.w",)], "t string")
    got = [r[0] for r in df.select(EV.topic_table(F.col("t"))).collect()]
    assert got == ["c", None, "w"]


def test_undecodable_values_are_counted(spark):
    import base64

    fields = [{"field": "id", "type": "int64", "name": None}, {"field": "amount", "type": "bytes", "name": "org.apache.kafka.connect.data.Decimal", "scale": 2},
              {"field": "at", "type": "string", "name": "io.debezium.time.ZonedTimestamp"}]
    wide = base64.b64encode((10**40).to_bytes(17, "big", signed=True)).decode()  # beyond 38 digits
    ok = base64.b64encode((12345).to_bytes(2, "big", signed=True)).decode()
    rows = [
        _ev("db.public.pay", {"id": 1}, {"op": "c", "after": {"id": 1, "amount": ok, "at": "2024-01-01T00:00:00Z"}, "ts_ms": 1}),
        _ev("db.public.pay", {"id": 2}, {"op": "c", "after": {"id": 2, "amount": wide, "at": "2024-01-01T00:00:00Z"}, "ts_ms": 2}),
        _ev("db.public.pay", {"id": 3}, {"op": "c", "after": {"id": 3, "amount": None, "at": "2024-01-01T00:00:00Z"}, "ts_ms": 3}),
    ]
    raw = spark.createDataFrame(rows, EV.RAW_EVENT_SCHEMA)
    got = {r.id: (r.decode_errors, None if r.amount is None else str(r.amount)) for r in EV.parse_table_changes(raw, fields, count_errors=True).collect()}
    assert got == {1: (0, "123.45"), 2: (1, None), 3: (0, None)}
