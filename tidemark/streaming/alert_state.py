"""Alert state machines as Structured Streaming stateful operators (V5, V6).

Both are ``transformWithStateInPandas`` processors over event time.  A key's rows
wait in a map state, packed by time bucket, and each bucket has a timer; when the
watermark has passed a bucket its rows are folded in time order, the key's value
state goes on, and the bucket is dropped.  So rows may arrive in any order within
the watermark's delay, chunks of a micro-batch are packed one by one, and a hot key
holds one bucket in memory, whatever its history.  Values, maps and timers are in
the state store, which a restarted query resumes.

Rows later than the watermark are left out, as in any event-time operator.  A
bucket is emitted once the watermark is beyond it: an idle source sends ``tick``
rows (only their time counts), as change connectors send heartbeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.alerts import ITERATION_LIMIT, THROTTLE_MINUTES

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKET_SECONDS = 3600
ROW = np.dtype([("t", "<i8"), ("id", "<i8"), ("flag", "?")])
INPUT = "key string, ts timestamp, id long, flag boolean, tick boolean"


class _Buckets(StatefulProcessor):
    """Rows of a key, folded bucket by bucket.  A subclass folds sorted rows with
    its value state into an output frame."""

    state = ""

    def __init__(self, bucket_seconds: int):
        self.width = bucket_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("run", self.state)
        self.waiting = handle.getMapState("waiting", "bucket long", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            chunk = chunk[~chunk["tick"].astype(bool)]
            packed = np.zeros(len(chunk), ROW)
            packed["t"] = chunk["ts"].to_numpy().astype("datetime64[us]").astype(np.int64)
            packed["id"] = chunk["id"].to_numpy()
            packed["flag"] = chunk["flag"].fillna(False).astype(bool)
            bucket = packed["t"] // self.width
            for b in np.unique(bucket).tolist():
                held = self.waiting.getValue((b,))[0] if self.waiting.containsKey((b,)) else None
                if held is None:
                    self.handle.registerTimer((b + 1) * self.width // 1000)
                self.waiting.updateValue((b,), ((held or b"") + packed[bucket == b].tobytes(),))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        due = sorted(b[0] for b in self.waiting.keys() if (b[0] + 1) * self.width <= passed)
        for b in due:
            rows = np.sort(np.frombuffer(self.waiting.getValue((b,))[0], ROW), order=["t", "id"])
            self.waiting.removeKey((b,))
            yield self.fold(key[0], rows)

    def fold(self, key, rows: np.ndarray) -> pd.DataFrame:
        raise NotImplementedError

    def close(self) -> None:
        pass


class _Iterations(_Buckets):
    state = "counter int, made long"

    def __init__(self, bucket_seconds: int, limit: int):
        super().__init__(bucket_seconds)
        self.limit = limit

    def fold(self, key, rows):
        counter, made = self.value.get() if self.value.exists() else (0, 0)
        # Places count from the open notification's first alert; an alert that is
        # not forced and not within the limit opens the next one.
        free = np.append(np.flatnonzero(~rows["flag"]), len(rows))
        number, place = np.empty(len(rows), np.int64), np.empty(len(rows), np.int32)
        at = 0
        while at < len(rows):
            if not counter:
                stop, made = at, made + 1
            else:
                stop = int(free[np.searchsorted(free, at + max(self.limit - counter, 0))]) if at + max(self.limit - counter, 0) < len(rows) else len(rows)
                number[at:stop], place[at:stop] = made, counter + 1 + np.arange(stop - at)
                counter += stop - at
                if stop == len(rows):
                    break
                made += 1
            number[stop], place[stop], counter, at = made, 1, 1, stop + 1
        self.value.update((int(counter), int(made)))
        return pd.DataFrame({"id": rows["id"], "key": key, "notification_no": number, "iteration_check": place})


class _Throttle(_Buckets):
    state = "last_us long"

    def __init__(self, bucket_seconds: int, minutes: int):
        super().__init__(bucket_seconds)
        self.gap = minutes * 60 * 1_000_000

    def fold(self, key, rows):
        last = self.value.get()[0] if self.value.exists() else None
        t = rows["t"]
        acked = np.append(np.flatnonzero(rows["flag"]), len(t))
        create = np.zeros(len(t), bool)
        at = 0 if last is None else min(int(np.searchsorted(t, last + self.gap)), int(acked[0]))
        while at < len(t):  # from one creation to the next
            create[at], last = True, int(t[at])
            at = min(max(int(np.searchsorted(t, last + self.gap)), at + 1), int(acked[np.searchsorted(acked, at + 1)]))
        self.value.update((last,))
        return pd.DataFrame({"id": rows["id"], "key": key, "create": create})


def _input(rows: DataFrame, key: str, ts_col: str, id_col: str, flag_col: str, delay: str) -> DataFrame:
    tick = F.col("tick") if "tick" in rows.columns else F.lit(False)
    staged = rows.select(
        F.col(key).cast("string").alias("key"),
        F.col(ts_col).cast("timestamp").alias("ts"),
        F.col(id_col).cast("long").alias("id"),
        F.col(flag_col).alias("flag"),
        F.coalesce(tick, F.lit(False)).alias("tick"),
    )
    return staged.withWatermark("ts", delay)


def iteration_stream(
    alerts: DataFrame, key: str, ts_col: str, id_col: str, force_col: str, limit: int = ITERATION_LIMIT, delay: str = "0 seconds", bucket_seconds: int = BUCKET_SECONDS
) -> DataFrame:
    """V5 on a stream: per alert, the notification row that absorbs it and
    that row's counter.  State per key: (counter, rows created)."""
    rows = _input(alerts, key, ts_col, id_col, force_col, delay)
    out = rows.groupBy("key").transformWithStateInPandas(
        _Iterations(bucket_seconds, limit), "id long, key string, notification_no long, iteration_check int", "append", "eventTime"
    )
    return out.select(F.col("id").alias(id_col), F.col("key").alias(key), "notification_no", "iteration_check")


def throttle_stream(
    attempts: DataFrame, key: str, ts_col: str, id_col: str, acked_col: str, minutes: int = THROTTLE_MINUTES, delay: str = "0 seconds", bucket_seconds: int = BUCKET_SECONDS
) -> DataFrame:
    """V6 on a stream: ``create`` per attempt.  State per key: the last
    creation time (epoch microseconds)."""
    rows = _input(attempts, key, ts_col, id_col, acked_col, delay)
    out = rows.groupBy("key").transformWithStateInPandas(_Throttle(bucket_seconds, minutes), "id long, key string, create boolean", "append", "eventTime")
    kind = attempts.schema[key].dataType
    return out.select(F.col("id").alias(id_col), F.col("key").cast(kind).alias(key), "create")


def run_state_stream(spark: SparkSession, out: DataFrame, path: str, checkpoint: str):
    """Run a stream of this module over what is there, into Parquet files.  These
    operators need the RocksDB state store; the session's choice is put back after."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        writer = out.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
    return query
