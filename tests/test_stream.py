"""Streaming targets: order independence, idempotent replay, restart."""

import dataclasses
import json
import os
import tempfile

from pyspark.sql import functions as F

from tidemark.operators import apply as A
from tidemark.operators import dlq as Q
from tidemark.streaming import changes as S


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_target_order_independent_and_idempotent(spark):
    base = tempfile.mkdtemp(prefix="tm-target-")
    log = [(k % 5, f"v{i}", "d" if i % 7 == 0 else "u", i // 2, i) for i, k in enumerate(range(40))]
    df = spark.createDataFrame(log, "k long, v string, op string, ts long, seq long")
    a = S.Target(spark, os.path.join(base, "a"), ["k"])
    b = S.Target(spark, os.path.join(base, "b"), ["k"])
    halves = [df.filter(F.col("seq") < 20), df.filter(F.col("seq") >= 20)]
    a.write(halves[0], "s-0")
    a.write(halves[1], "s-1")
    b.write(halves[1], "s-0")  # late half first
    b.write(halves[0], "s-1")
    b.write(halves[0], "s-1")  # delivered again: the same folder
    expected = A.latest_per_key(df, ["k"], ["ts", "seq"]).filter(F.col("op") != "d")
    assert _rows(a.read()) == _rows(b.read()) == _rows(expected.select(*a.read().columns))
    assert sorted(os.listdir(os.path.join(base, "b", "schema=1"))) == ["batch=s-0", "batch=s-1"]


def test_target_reads_older_versions_with_the_newest_columns(spark):
    base = tempfile.mkdtemp(prefix="tm-evolve-")
    t = S.Target(spark, f"{base}/t", ["k"])
    t.create(spark.createDataFrame([], "k long, v double, gone string, op string, ts long, seq long").schema)
    t.write(spark.createDataFrame([(1, 2.5, "x", "u", 1, 1), (2, None, "y", "u", 1, 2)], "k long, v double, gone string, op string, ts long, seq long"), "a", 1)
    t.write(spark.createDataFrame([(2, 7, "new", "u", 2, 3), (3, 8, None, "d", 2, 4)], "k long, v long, more string, op string, ts long, seq long"), "b", 2)
    t.write(spark.createDataFrame([(4, "9", None, "u", 0, 5)], "k long, v string, more string, op string, ts long, seq long"), "late", 1)  # another type
    assert t.versions() == [1, 2] and t.columns() == ["k", "v", "more", "op", "ts", "seq"]
    t2 = S.Target(spark, f"{base}/t2", ["k"])
    t2.write(t.batch("a", 1), "a", 1)
    t2.write(t.batch("b", 2), "b", 2)
    assert _rows(t2.read({"more": "n/a"}).select("k", "v", "more")) == [(1, 2, "n/a"), (2, 7, "new")]


def test_guard_and_key_resolution(spark):
    import pytest

    with pytest.raises(A.TargetMissing):
        A.guard_target(spark, tempfile.mkdtemp(prefix="tm-none-") + "/missing")
    assert A.resolve_key(None, ["k"], ["id"], ["id", "k"]) == ["k"]
    assert A.resolve_key(None, None, None, ["user_id", "name"]) == ["user_id"]
    with pytest.raises(ValueError):
        A.resolve_key(None, None, None, ["a", "b"])


def test_failing_branch_is_isolated_and_dead_lettered(spark):
    import json

    from tidemark.sources import envelope as EV

    base = tempfile.mkdtemp(prefix="tm-branches-")
    fields = [{"field": "id", "type": "int64", "name": None}, {"field": "n", "type": "string", "name": None}]
    msgs = [
        ("db.public.users", json.dumps({"id": i}), json.dumps({"payload": {"op": "c", "after": {"id": i, "n": f"n{i}"}, "ts_ms": 1000 + i}}))
        for i in range(20)
    ] + [("db.public.users", json.dumps({"id": 99}), "{broken")]
    spark.createDataFrame(msgs, EV.RAW_EVENT_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{base}/src")
    common = dict(table="users", fields=fields, keys=["id"], ts_col="ts", seq_col="id")
    good = S.Branch(name="good", target_path=f"{base}/t_good", **common)
    bad = S.Branch(name="bad", target_path=f"{base}/t_bad", sql="SELECT no_such_column FROM users", **common)
    sinks = S.StreamSinks(dlq_path=f"{base}/dlq", throughput_path=f"{base}/tp")
    S.run_change_stream(spark, f"{base}/src", [good, bad], sinks, f"{base}/ckpt")
    assert good.target(spark).read().count() == 20
    dlq = spark.read.parquet(sinks.dlq_path)
    per_branch = {r.branch: r.n for r in dlq.groupBy("config.branch").agg(F.count("*").alias("n")).collect()}
    assert per_branch == {"bad": 21, "good": 1}  # the malformed event is a letter of either branch
    assert [r.raw for r in dlq.filter(~Q.decoded()).select(F.try_variant_get("record", "$.__raw", "string").alias("raw")).collect()] == ["{broken"] * 2
    logged = {r.branch: r.record_count for r in spark.read.parquet(sinks.throughput_path).collect()}
    assert logged == {"good": 20}


def test_missing_required_target_dead_letters(spark):
    import json

    from tidemark.sources import envelope as EV

    base = tempfile.mkdtemp(prefix="tm-guard-")
    fields = [{"field": "id", "type": "int64", "name": None}]
    msgs = [("db.public.items", json.dumps({"id": i}), json.dumps({"payload": {"op": "c", "after": {"id": i}, "ts_ms": i}})) for i in range(5)]
    spark.createDataFrame(msgs, EV.RAW_EVENT_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{base}/src")
    br = S.Branch(name="strict", table="items", fields=fields, keys=["id"], target_path=f"{base}/t", ts_col="ts", seq_col="id", require_target=True)
    sinks = S.StreamSinks(dlq_path=f"{base}/dlq", throughput_path=f"{base}/tp")
    S.run_change_stream(spark, f"{base}/src", [br], sinks, f"{base}/ckpt")
    dlq = spark.read.parquet(sinks.dlq_path)
    assert dlq.count() == 5 and "does not exist" in dlq.first().error.lower() or "not exist" in dlq.first().error.lower()
    assert not S.path_exists(spark, f"{base}/t")


def test_batch_metrics_listener(spark):
    import json
    import time

    from tidemark.sources import envelope as EV

    base = tempfile.mkdtemp(prefix="tm-metrics-")
    fields = [{"field": "id", "type": "int64", "name": None}]
    msgs = [("db.public.m", json.dumps({"id": i}), json.dumps({"payload": {"op": "c", "after": {"id": i}, "ts_ms": i}})) for i in range(30)]
    msgs.append(("db.public.m", json.dumps({"id": 5}), None))  # a tombstone
    spark.createDataFrame(msgs, EV.RAW_EVENT_SCHEMA).repartition(3).write.mode("overwrite").json(f"{base}/src")
    br = S.Branch(name="m", table="m", fields=fields, keys=["id"], target_path=f"{base}/t", ts_col="ts", seq_col="id")
    metrics = S.BatchMetrics(spark)
    try:
        S.run_change_stream(spark, f"{base}/src", [br], S.StreamSinks(f"{base}/dlq", f"{base}/tp"), f"{base}/ck", max_files_per_trigger=1)
        for _ in range(50):  # listener events arrive asynchronously
            if sum(r["events"] for r in metrics.records) == 31:
                break
            time.sleep(0.2)
    finally:
        metrics.close()
    assert sum(r["events"] for r in metrics.records) == 31
    assert sum(r["tombstones"] for r in metrics.records) == 1


def test_many_micro_batches_match_batch_merge(spark):
    from conftest import SF
    from tidemark.plans import derived as D
    from tidemark.plans.decode_queries import EVENT_FIELDS, events_raw

    base = tempfile.mkdtemp(prefix="tm-many-")
    events_raw(spark, SF).repartition(7).write.mode("overwrite").json(f"{base}/src")
    br = S.Branch(
        name="u", table="events", fields=EVENT_FIELDS, keys=["k"], target_path=f"{base}/t", key_from_json={"k": "long"},
        ts_col="ts", seq_col="event_id",
    )
    S.run_change_stream(spark, f"{base}/src", [br], S.StreamSinks(f"{base}/dlq", f"{base}/tp"), f"{base}/ck", max_files_per_trigger=1)
    got = br.target(spark).read().select("k", "event_id", "op")
    ch = D.chg_events(spark, SF)
    want = A.latest_per_key(ch, ["k"], ["ts", "seq"]).filter(F.col("op") != "d").select("k", F.col("seq").alias("event_id"), "op")
    assert _rows(got) == _rows(want)
    assert spark.read.parquet(f"{base}/tp").select(F.sum("record_count")).first()[0] == ch.count()


def _events(spark, path, rows):
    """rows: (op, image or None, key) of table ``items`` as change events."""
    import json

    from tidemark.sources import envelope as EV

    msgs = [
        ("db.public.items", json.dumps(key), json.dumps({"payload": {"op": op, ("before" if op == "d" else "after"): image, "ts_ms": i}}))
        for i, (op, image, key) in enumerate(rows)
    ]
    spark.createDataFrame(msgs, EV.RAW_EVENT_SCHEMA).coalesce(1).write.mode("append").json(path)


ITEM_FIELDS = [{"field": "id", "type": "int64", "name": None}, {"field": "v", "type": "int64", "name": None}]


def test_key_only_delete_and_all_null_update(spark):
    """A delete whose image holds the key alone deletes; an update that sets the
    only data column to NULL applies."""
    base = tempfile.mkdtemp(prefix="tm-del-")
    _events(spark, f"{base}/src", [("c", {"id": 1, "v": 5}, {"id": 1}), ("c", {"id": 2, "v": 6}, {"id": 2}), ("d", {"id": 1}, {"id": 1}), ("u", {"id": 2, "v": None}, {"id": 2})])
    br = S.Branch("b", "items", ITEM_FIELDS, ["id"], f"{base}/t", ts_col="ts", seq_col="ts_ms")
    S.run_change_stream(spark, f"{base}/src", [br], S.StreamSinks(f"{base}/dlq", f"{base}/tp"), f"{base}/ck")
    assert [(r.id, r.v) for r in br.target(spark).read().collect()] == [(2, None)]


def test_second_stream_into_one_target(spark):
    """Epochs of another checkpoint are not taken for ones already applied."""
    base = tempfile.mkdtemp(prefix="tm-two-")
    br = S.Branch("b", "items", ITEM_FIELDS, ["id"], f"{base}/t", ts_col="ts", seq_col="ts_ms")
    for i in (1, 2):
        _events(spark, f"{base}/src{i}", [("c", {"id": i, "v": i}, {"id": i})])
        S.run_change_stream(spark, f"{base}/src{i}", [br], S.StreamSinks(f"{base}/dlq", f"{base}/tp"), f"{base}/ck{i}")
    assert sorted(r.id for r in br.target(spark).read().collect()) == [1, 2]


def test_redelivery_writes_side_outputs_once(spark):
    """A batch delivered again after its targets committed still writes its dead
    letters and log row, and only once."""
    from tidemark.sources import envelope as EV

    base = tempfile.mkdtemp(prefix="tm-again-")
    _events(spark, f"{base}/src", [("c", {"id": 1, "v": 1}, {"id": 1})])
    bad = [("db.public.items", '{"id": 9}', "{not json")]
    spark.createDataFrame(bad, EV.RAW_EVENT_SCHEMA).coalesce(1).write.mode("append").json(f"{base}/src")
    batch = spark.read.schema(EV.RAW_EVENT_SCHEMA).json(f"{base}/src")
    br = S.Branch("b", "items", ITEM_FIELDS, ["id"], f"{base}/t", ts_col="ts", seq_col="ts_ms")
    for turn in (1, 2):  # the first delivery's side outputs go to sinks that are then lost
        sinks = S.StreamSinks(f"{base}/dlq{turn}", f"{base}/tp{turn}")
        S.process_batch(spark, batch, 0, [br], sinks, "s")
    S.process_batch(spark, batch, 0, [br], sinks, "s")
    assert spark.read.parquet(sinks.dlq_path).count() == 1
    assert [r.record_count for r in spark.read.parquet(sinks.throughput_path).collect()] == [1]


def test_branches_of_one_table_with_different_fields(spark):
    base = tempfile.mkdtemp(prefix="tm-wide-")
    _events(spark, f"{base}/src", [("c", {"id": 1, "v": 4}, {"id": 1})])
    narrow = S.Branch("n", "items", ITEM_FIELDS[:1], ["id"], f"{base}/n", ts_col="ts", seq_col="ts_ms")
    wide = S.Branch("w", "items", ITEM_FIELDS, ["id"], f"{base}/w", ts_col="ts", seq_col="ts_ms")
    S.run_change_stream(spark, f"{base}/src", [narrow, wide], S.StreamSinks(f"{base}/dlq", f"{base}/tp"), f"{base}/ck")
    assert [r.v for r in wide.target(spark).read().collect()] == [4]


def test_side_input_on_the_stream(spark):
    base = tempfile.mkdtemp(prefix="tm-side-")
    _events(spark, f"{base}/src", [("c", {"id": 1, "v": 4}, {"id": 1})])
    names = spark.createDataFrame([(4, "four")], "v long, name string")
    br = S.Branch("s", "items", ITEM_FIELDS, ["id"], f"{base}/t", ts_col="ts", seq_col="ts_ms", sql="SELECT i.*, n.name FROM items i LEFT JOIN names n ON i.v = n.v", side_inputs={"names": names})
    S.run_change_stream(spark, f"{base}/src", [br], S.StreamSinks(f"{base}/dlq", f"{base}/tp"), f"{base}/ck")
    assert [r.name for r in br.target(spark).read().collect()] == ["four"]


def test_two_backfill_jobs_and_a_lost_progress_row(spark):
    from tidemark.sources import backfill as B

    base = tempfile.mkdtemp(prefix="tm-jobs-")
    make = lambda lo: spark.range(lo, lo + 5).select(F.col("id"), (F.col("id") * 2).alias("v"))
    for job, lo in (("a", 0), ("b", 100)):
        target = S.Target(spark, f"{base}/{job}", ["id"])
        done = B.run_backfill(spark, make(lo), target, job, f"{base}/progress")
        assert sorted(r.id for r in target.read().collect()) == list(range(lo, lo + 5))
    assert _rows(done.select("job_id", "n_rows")) == [("a", 5), ("b", 5)]
    # The crash: the batch is committed, its row isn't there; the source has changed since.
    os.rename(f"{base}/progress/job=a", f"{base}/lost")
    again = B.run_backfill(spark, make(50), S.Target(spark, f"{base}/a", ["id"]), "a", f"{base}/progress")
    assert _rows(again.select("job_id", "n_rows")) == [("a", 5), ("b", 5)]
    assert sorted(r.id for r in S.Target(spark, f"{base}/a", ["id"]).read().collect()) == list(range(5))
    # Changes are newer than the backfill, whichever came first.
    t = S.Target(spark, f"{base}/a", ["id"])
    change = spark.createDataFrame([(3, None, "d", 1), (4, 9, "u", 1)], "id long, v long, op string, seq long")
    t.write(change.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz")), "s-0")
    assert {(r.id, r.v) for r in t.read().collect()} == {(0, 0), (1, 2), (2, 4), (4, 9)}


def test_hourly_lag_after_a_new_checkpoint(spark):
    """Rows that a second checkpoint reads again, and one more, replace the first's."""
    import datetime as dt

    base = tempfile.mkdtemp(prefix="tm-lag-")
    rows = [(1, 10, dt.datetime(2024, 1, 1, 5, m)) for m in range(3)] + [(1, 1000, dt.datetime(2024, 1, 1, 5, 30))]
    df = spark.createDataFrame(rows, "source_id long, size_bytes long, recorded_at timestamp_ntz")
    out = S.Target(spark, f"{base}/out", ["hour", "source_id"])
    for i, part in enumerate((df.filter("size_bytes = 10"), df.filter("size_bytes = 1000"))):
        part.coalesce(1).write.mode("append").parquet(f"{base}/src")
        S.hourly_lag_stream(spark, f"{base}/src", df.schema, out, f"{base}/ckpt{i}", max_files_per_trigger=1)
        got = [(r.total_bytes, r.n) for r in out.read().collect()]
        assert got == [[(30, 3)], [(1030, 4)]][i]


def _schema_event(fields, image, op="c", ts=0, key=None, table="items"):
    import json

    schema = {"fields": [{"field": "before", "fields": []}, {"field": "after", "fields": fields}]}
    payload = {"op": op, ("before" if op == "d" else "after"): image, "ts_ms": ts}
    return (f"db.public.{table}", json.dumps(key or {"id": image["id"]}), json.dumps({"schema": schema, "payload": payload}))


def test_schema_drift_on_the_stream(spark):
    """A column comes (with a default), another goes, a type changes and changes
    back; late events of an older schema make no version."""
    from tidemark.operators import evolution as EVO
    from tidemark.sources import envelope as EV

    e = EV.field_entry
    one = [e("id", "int64"), e("v", "double"), e("old", "string")]
    two = [*one, e("more", "string", default="none")]
    three = [e("more", "string", default="none"), e("id", "int64"), e("v", "int64")]  # another order of columns
    events = [_schema_event(one, {"id": i, "v": i + 0.5, "old": "o"}, ts=i) for i in range(4)]
    events += [_schema_event(two, {"id": i, "v": 1.5, "old": "o", "more": "m"}, ts=10 + i) for i in range(2)]
    late = [_schema_event(one, {"id": 9, "v": 3.5, "old": "late"}, ts=5)]
    third = [_schema_event(three, {"id": 1, "v": 7, "more": None}, "u", ts=20), _schema_event(list(reversed(three)), {"id": 8, "v": 8, "more": "x"}, ts=21)]
    back = [_schema_event(two, {"id": 2, "v": 0.25, "old": "again", "more": "m"}, "u", ts=30), _schema_event(two, {"id": 3}, "d", ts=31)]
    base = tempfile.mkdtemp(prefix="tm-drift-")
    br = S.Branch("b", "items", None, ["id"], f"{base}/t", seq_col="ts_ms")
    sinks = S.StreamSinks(f"{base}/dlq", f"{base}/tp", f"{base}/log")
    raw = lambda rows: spark.createDataFrame(rows, EV.RAW_EVENT_SCHEMA)
    labels, seen = [], []
    for delivery in (events, late + third, back):  # the first brings two schemas at once
        raw(delivery).coalesce(1).write.mode("append").json(f"{base}/src")
        S.run_change_stream(spark, f"{base}/src", [br], sinks, f"{base}/ckpt")
        log = S.SchemaLog(spark, sinks.schema_path)
        labels.append([r.changes_type for r in log.read().orderBy("version").collect()])
        seen.append({r.id: (r.v, r.more) for r in br.target(spark).read(log.defaults("items")).collect()})
    assert labels == [["INITIAL_LOAD", "NEW COLUMN"], ["INITIAL_LOAD", "NEW COLUMN", "DROP COLUMN"], ["INITIAL_LOAD", "NEW COLUMN", "DROP COLUMN", "NEW COLUMN"]]
    assert seen[0] == {0: (1.5, "m"), 1: (1.5, "m"), 2: (2.5, "none"), 3: (3.5, "none")}
    assert seen[1] == {0: (1, "m"), 1: (7, None), 2: (2, "none"), 3: (3, "none"), 8: (8, "x"), 9: (3, "none")}
    assert seen[2][2] == (0.25, "m") and 3 not in seen[2]
    # The stream's log is the batch's over the same events in time order.
    in_time = EVO.version_log(EVO.schema_runs(EVO.schema_events(raw(events + third + back)), bucket_ms=8))
    cols = ["table_name", "version", "changes_type", "started_ms"]
    assert _rows(log.read().select(*cols)) == _rows(in_time.select(*cols))
    # A batch delivered again finds the same versions.
    before = _rows(log.read().select(*cols))
    S.process_batch(spark, raw(back), 2, [br], sinks, S.stream_name(spark, f"{base}/ckpt"))
    assert _rows(log.read().select(*cols)) == before
    # Every version's columns, folded from the changes.
    changes = EVO.column_changes(in_time)
    at = EVO.schema_at(changes, in_time.select("table_name", "version")).collect()
    told = {v: {r.column_name: r.change for r in at if r.version == v} for v in (1, 2, 3, 4)}
    assert told[1] == {"id": "added", "v": "added", "old": "added"}
    assert told[2] == {"id": "unchanged", "v": "unchanged", "old": "unchanged", "more": "added"}
    assert told[3] == {"id": "unchanged", "v": "type_changed", "old": "dropped", "more": "unchanged"}
    assert told[4] == {"id": "unchanged", "v": "type_changed", "old": "added", "more": "unchanged"}


def test_dead_letters_of_a_stream_are_replayed_through_the_branch_of_today(spark):
    """Inserts, updates and a delete fail by a wrong SQL; replayed with the repaired
    branch they end as the merge of the same events does."""
    base = tempfile.mkdtemp(prefix="tm-replay-")
    rows = [("c", {"id": i, "v": i * 10}, {"id": i}) for i in range(6)] + [("u", {"id": 1, "v": 99}, {"id": 1}), ("d", {"id": 2, "v": 20}, {"id": 2}), ("u", {"id": 3, "v": None}, {"id": 3})]
    _events(spark, f"{base}/src", rows)
    from tidemark.sources import envelope as EV

    spark.createDataFrame([("db.public.items", '{"id": 7}', "{broken")], EV.RAW_EVENT_SCHEMA).coalesce(1).write.mode("append").json(f"{base}/src")
    spec = {"version": 2, "groups": [{"conditions": [{"column": "v", "operator": "<", "value": "95"}]}], "interLogic": []}
    bad = S.Branch("b", "items", ITEM_FIELDS, ["id"], f"{base}/t", sql="SELECT nothing FROM items", seq_col="ts_ms", pipeline_id=4, source_id=5, destination_id=6)
    sinks = S.StreamSinks(f"{base}/dlq", f"{base}/tp")
    S.run_change_stream(spark, f"{base}/src", [bad], sinks, f"{base}/ck")
    queue = spark.read.parquet(sinks.dlq_path).drop("batch", "part")
    assert queue.count() == 10 and {tuple(r) for r in queue.select("pipeline_id", "source_id", "table_name", "destination_id", "target_name").collect()} == {(4, 5, "items", 6, f"{base}/t")}
    # Still broken: all stay, with one retry more; at the limit they are discarded.
    left, taken = S.replay(spark, queue, [bad], "r1")
    assert taken == [] and {r.retry_count for r in left.collect()} == {1} and left.count() == 10
    assert S.replay(spark, queue, [bad], "r1", max_retry=1)[0].count() == 0
    fixed = dataclasses.replace(bad, sql="SELECT *, v + 1 AS w FROM items", filter_spec=spec)
    left, taken = S.replay(spark, queue, [fixed], "r2")
    assert taken == ["b"] and [r.retry_count for r in left.collect()] == [1]  # the text that no branch can take
    other = dataclasses.replace(fixed, target_path=f"{base}/direct")
    S.run_change_stream(spark, f"{base}/src", [other], S.StreamSinks(f"{base}/dlq2", f"{base}/tp2"), f"{base}/ck2")
    want = other.target(spark).read()
    assert _rows(fixed.target(spark).read().select(*want.columns)) == _rows(want)
    assert {(r.id, r.v, r.w) for r in want.collect()} == {(0, 0, 1), (1, 10, 11), (3, None, None), (4, 40, 41), (5, 50, 51)}
    S.replay(spark, queue, [fixed], "r2")  # once more: the same batch
    assert fixed.target(spark).read().count() == 5
    # The branch is gone: its stored filter and SQL, its old target.
    gone, taken = S.replay(spark, queue, [dataclasses.replace(fixed, name="new", target_path=f"{base}/n")], "r3")
    assert taken == [] and gone.count() == 10  # the stored SQL is the wrong one
    assert S.replay(spark, queue.filter("false"), [fixed], "r4")[0].count() == 0


def test_keys_come_from_the_events_the_target_or_the_columns(spark):
    base = tempfile.mkdtemp(prefix="tm-keys-")
    wide = [*ITEM_FIELDS, {"field": "part", "type": "int64", "name": None}]
    _events(spark, f"{base}/src", [("c", {"id": 1, "v": 1, "part": p}, {"id": 1, "part": p}) for p in (1, 2)])
    br = S.Branch("b", "items", wide, None, f"{base}/t", seq_col="ts_ms")
    S.run_change_stream(spark, f"{base}/src", [br], S.StreamSinks(f"{base}/dlq", f"{base}/tp"), f"{base}/ck")
    assert dataclasses.replace(br, keys=["id", "part"]).target(spark).read().count() == 2


def test_counter_and_throttle_folds_in_buckets():
    """The processors' folds over sorted buckets equal a plain loop over all rows."""
    import random

    import numpy as np

    from tidemark.streaming import alert_state as ST

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, v):
            self.held = v

    rng = random.Random(3)
    for trial in range(200):
        rows = sorted((rng.randint(0, 40) * 60_000_000, i, rng.random() < 0.4) for i in range(rng.randint(1, 60)))
        cuts = sorted(rng.sample(range(len(rows) + 1), min(3, len(rows))))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)]) if a < b]
        counter = ST._Iterations(3600, 1 + trial % 4)
        throttle = ST._Throttle(3600, 5)
        counter.value, throttle.value = Value(), Value()
        numbers, creates = [], []
        for p in parts:
            packed = np.array(p, ST.ROW)
            out = counter.fold("k", packed)
            numbers += list(zip(out["notification_no"], out["iteration_check"]))
            creates += throttle.fold("k", packed)["create"].tolist()
        state, made, last, want, flags = 0, 0, None, [], []
        for t, _, flag in rows:
            if state and (state < counter.limit or flag):
                state += 1
            else:
                state, made = 1, made + 1
            want.append((made, state))
            flags.append(last is None or flag or t - last >= 300_000_000)
            last = t if flags[-1] else last
        assert numbers == want and creates == flags


def test_schema_texts_are_not_sorted(spark):
    """Only rows that are merged already may reach a sorting aggregate."""
    from tidemark.operators import evolution as EVO

    schema = "table_name string, at long, tie long, schema string"
    block = lambda *names: json.dumps({"fields": [{"field": "after", "fields": [{"field": n, "type": "string"} for n in names]}]})
    rows = [("t", i * 1000, i, block("a") if i < 5000 else block("a", "b")) for i in range(20_000)]
    runs = EVO.schema_runs(spark.createDataFrame(rows, schema))
    plan = runs._jdf.queryExecution().executedPlan().toString()
    texts = [line for line in plan.split("\n") if "SortAggregate" in line and "table_name" in line]
    assert not texts
    got = sorted((r.table_name, r.started_ms, [f.field for f in r.fields]) for r in runs.collect())
    assert got == [("t", 0, ["a"]), ("t", 5_000_000, ["a", "b"])]


def test_spread_by_rows(spark):
    """A task's share does not grow with the input."""
    from tidemark.session import spread

    df = spark.range(1000).coalesce(1)
    assert spread(df, 2, rows=100).rdd.getNumPartitions() == 10
    assert spread(df, 2, rows=None).rdd.getNumPartitions() == 2
    assert spread(df, 2).rdd.getNumPartitions() == 2
