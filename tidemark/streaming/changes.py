"""Structured Streaming change pipeline.

    raw change files --readStream(json, maxFilesPerTrigger)--> micro-batch
      foreachBatch(batch, epoch):
        schema blocks of the events -> schema log (a version only where they differ)
        parse envelopes (malformed -> dead letters)
        for each branch of the table:  decode -> filter -> SQL -> drop all-null
          -> write into the branch's target -> throughput log
          (any failure of a branch -> its rows to the dead-letter table)

A target is the plain Parquet folders of its batches, each with the latest change
per key, *including* deletes; its state is the latest change per key over all of
them.  That makes it independent of the order of batches (late ones cannot
resurrect deleted rows), and a batch that is delivered again overwrites its own
folder, so nothing is applied twice.  Spark's writer commits a folder as a whole;
the query's checkpoint (``checkpointLocation``) does the rest.
"""

from __future__ import annotations

import re
import uuid
from collections import deque
from functools import reduce
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import filters as FL
from tidemark.functions import redact as RD
from tidemark.operators import apply as A
from tidemark.operators import dlq as Q
from tidemark.operators import evolution as EVO
from tidemark.operators import joins as J
from tidemark.session import scratch_path
from tidemark.sources import envelope as EV


# ---------------------------------------------------------------- storage helpers


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder (empty when it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


class Target:
    """A target table: ``<path>/schema=<version>/batch=<name>`` folders of changes
    (see the module's docstring).  ``op_col`` tells deletes, which ``read`` hides.

    Rows of an older schema version are read with the newest one's columns: added
    columns get their default (or NULL), dropped ones go, retyped ones are cast."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], ts_col: str = "ts", seq_col: str = "seq", op_col: str = "op"):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.ts_col, self.seq_col, self.op_col = ts_col, seq_col, op_col

    def _folder(self, version: int, batch: str) -> str:
        return f"{self.path}/schema={int(version)}/batch={re.sub(r'[^A-Za-z0-9_.-]', '_', batch)}"

    def create(self, schema: T.StructType) -> None:
        """K8: an empty target with these columns."""
        self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(self._folder(1, "created"))

    def write(self, changes: DataFrame, batch: str, version: int = 1) -> None:
        """K1/K3: the latest change per key of a batch; once more overwrites it."""
        A.latest_per_key(changes, self.keys, [self.ts_col, self.seq_col]).write.mode("overwrite").parquet(self._folder(version, batch))

    def written(self, batch: str, version: int = 1) -> bool:
        return path_exists(self.spark, f"{self._folder(version, batch)}/_SUCCESS")

    def batch(self, batch: str, version: int = 1) -> DataFrame:
        """One batch's rows."""
        return self.spark.read.parquet(self._folder(version, batch))

    def versions(self) -> list[int]:
        return sorted(int(n[len("schema=") :]) for n in list_names(self.spark, self.path) if n.startswith("schema="))

    def columns(self) -> list[str]:
        """The newest version's columns; none where there is no target."""
        return self._version(self.versions()[-1]).columns if self.versions() else []

    def _version(self, version: int) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.path}/schema={version}").parquet(f"{self.path}/schema={version}").drop("batch")

    def state(self, defaults: Mapping[str, str] | None = None) -> DataFrame:
        """The latest change per key, deletes too."""
        versions = self.versions()
        if not versions:
            raise FileNotFoundError(self.path)
        newest = self._version(versions[-1])
        rows = newest
        for v in reversed(versions[:-1]):
            rows = rows.unionByName(EVO.to_schema(self._version(v), newest.schema, defaults))
        return A.latest_per_key(rows, self.keys, [self.ts_col, self.seq_col])

    def read(self, defaults: Mapping[str, str] | None = None) -> DataFrame:
        """The visible rows."""
        return self.state(defaults).filter(F.coalesce(F.lower(F.col(self.op_col)), F.lit("u")) != "d")


# ---------------------------------------------------------------- sources


def write_change_files(raw: DataFrame, path: str, files: int) -> None:
    """Lay raw change events down as JSON-lines files (test/bench input)."""
    raw.repartition(files).write.mode("overwrite").json(path)


def change_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1000) -> DataFrame:
    """Raw change events as a stream of bounded micro-batches (None: all
    that is there in one)."""
    reader = spark.readStream.schema(EV.RAW_EVENT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


# ---------------------------------------------------------------- branches


@dataclass
class Branch:
    """One table-sync branch: a source table routed to a target.  ``fields`` are the
    table's columns; without them they come from the schema log.  ``keys`` may be
    left to the event's key, the target's or the columns (P16)."""

    name: str
    table: str
    fields: Sequence[dict] | None
    keys: Sequence[str] | None
    target_path: str
    filter_spec: object = None
    sql: str | None = None
    key_from_json: Mapping[str, str] = field(default_factory=dict)
    ts_col: str = "ts"
    seq_col: str = "seq"
    require_target: bool = False  # K9: dead-letter instead of creating a missing target
    side_inputs: Mapping[str, DataFrame] = field(default_factory=dict)  # tables the SQL may join, by view name
    pipeline_id: int = 1
    source_id: int = 1
    destination_id: int = 1

    def target(self, spark: SparkSession) -> "Target":
        return Target(spark, self.target_path, self.keys or [], self.ts_col, self.seq_col)

    def config(self) -> dict:
        """What a dead letter keeps of the branch."""
        return Q.branch_config(self.name, self.filter_spec, self.sql)

    def routing(self) -> dict:
        return {
            "pipeline_id": self.pipeline_id,
            "source_id": self.source_id,
            "table_name": self.table,
            "destination_id": self.destination_id,
            "target_name": self.target_path,
        }


@dataclass
class StreamSinks:
    dlq_path: str
    throughput_path: str
    schema_path: str | None = None  # the schema log, for branches without fields


class SchemaLog:
    """The schema versions of the source tables, a Parquet folder per batch that
    found one: (table_name, version, changes_type, started_ms, fields)."""

    SCHEMA = f"table_name string, version int, changes_type string, started_ms long, fields {EVO.FIELDS_TYPE}"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self, but: str | None = None) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.SCHEMA)
        rows = self.spark.read.schema(f"{self.SCHEMA}, batch string").parquet(self.path)
        return (rows.filter(F.col("batch") != but) if but else rows).drop("batch")

    def newest(self, but: str | None = None) -> dict:
        """Table name -> its newest version's row (one for each source table)."""
        rows = self.read(but).groupBy("table_name").agg(F.max_by(F.struct("*"), "version").alias("v")).select("v.*")
        return {r["table_name"]: r for r in rows.collect()}

    def defaults(self, table: str) -> dict:
        """The newest version's default values by column."""
        newest = self.newest().get(table)
        return {f["field"]: f["default"] for f in newest["fields"] if f["default"] is not None} if newest else {}

    def observe(self, batch: DataFrame, marker: str) -> dict:
        """Log the versions that the raw events of a batch bring; the newest ones.
        The driver sees one row for every schema change in the batch.  What a batch
        finds doesn't depend on an earlier delivery of itself."""
        newest = self.newest(but=marker)
        found = []
        for r in EVO.schema_runs(EVO.schema_events(batch)).orderBy("table_name", "started_ms").collect():
            last = newest.get(r["table_name"])
            if last is not None and (r["started_ms"] <= last["started_ms"] or r["fields"] == last["fields"]):
                continue  # a late event of an older schema, or no change
            label = EVO.label_of(last["fields"] if last else None, r["fields"])
            row = (r["table_name"], last["version"] + 1 if last else 1, label, r["started_ms"], r["fields"])
            found.append(row)
            newest[r["table_name"]] = dict(zip(("table_name", "version", "changes_type", "started_ms", "fields"), row, strict=True))
        folder = f"{self.path}/batch={marker}"
        if found or path_exists(self.spark, folder):
            self.spark.createDataFrame(found, self.SCHEMA).write.mode("overwrite").parquet(folder)
        return newest


def process_batch(
    spark: SparkSession, batch: DataFrame, epoch: int, branches: Sequence[Branch], sinks: StreamSinks, stream_id: str = "stream"
) -> None:
    """V1: one micro-batch.  Each source table's events are parsed and decoded
    once (typed single-pass parse over the union of its branches' fields, or with
    the schema that each event carries); every branch then runs in isolation -- a
    failing branch dead-letters its rows and the others go on.

    Everything a batch writes carries ``stream_id`` and the epoch, so two streams
    into one target, or a stream with a new checkpoint, never overwrite each
    other's batches.  Dead letters and log rows have a folder per batch that a
    re-delivery overwrites; malformed rows are written before any target, so a
    crash in between loses none."""
    marker = f"{stream_id}-{epoch}"
    batch = batch.withColumn("__table", EV.topic_table(F.col("topic"))).persist()
    log_rows = []
    try:
        by_table: dict[str, list[Branch]] = {}
        for br in branches:
            by_table.setdefault(br.table, []).append(br)
        tracked = [t for t, group in by_table.items() if any(br.fields is None for br in group)]
        versions = {}
        if tracked:
            if not sinks.schema_path:
                raise ValueError("branches without fields need StreamSinks.schema_path")
            versions = SchemaLog(spark, sinks.schema_path).observe(batch.filter(F.col("__table").isin(tracked)).drop("__table"), marker)
        for table, group in by_table.items():
            rows = batch.filter(F.col("__table") == table).drop("__table")
            version = 1
            if table in tracked:
                if table not in versions:
                    continue  # no event with a schema so far
                version = versions[table]["version"]
                parsed = _parse_by_schema(rows, versions[table]["fields"])
            else:
                parsed = EV.parse_table_changes(_texted(rows), _all_fields(group), [TEXT], keep_malformed=True, count_errors=True)
            # A row whose values do not decode is treated like a malformed event; its
            # text is kept.
            parsed = parsed.withColumn("malformed", F.col("malformed") | (F.col("decode_errors") > 0))
            parsed = parsed.withColumn(Q.RAW, F.when(F.col("malformed"), F.col(TEXT))).drop("decode_errors", TEXT).persist()
            try:
                # A cheap check on the cached rows (stops at the first hit).
                if parsed.filter(F.col("malformed")).limit(1).count():
                    bad = parsed.filter(F.col("malformed")).drop("malformed")
                    for br in group:
                        letters = Q.dead_letters(bad, br.routing(), br.config(), F.lit("malformed change event or undecodable value"))
                        letters.write.mode("overwrite").parquet(_side_path(sinks.dlq_path, marker, f"malformed {br.name}"))
                good = parsed.filter(~F.col("malformed")).drop("malformed", Q.RAW)
                for br in group:
                    row = _run_branch(spark, br, good, epoch, marker, sinks, version)
                    if row is not None:
                        log_rows.append(row)
            finally:
                parsed.unpersist()
        if log_rows:
            schema = "epoch long, branch string, table_name string, record_count long"
            log = spark.createDataFrame(log_rows, schema).withColumn("created_at", F.current_timestamp())
            log.write.mode("overwrite").parquet(_side_path(sinks.throughput_path, marker, "log"))
    finally:
        batch.unpersist()


TEXT = "__text"


def _texted(rows: DataFrame) -> DataFrame:
    """Raw events with their text under a name that no table's column has."""
    return rows.withColumn(TEXT, F.col("value"))


def _side_path(base: str, marker: str, part: str) -> str:
    """The folder of one batch's side output (a partition of the sink's table)."""
    return f"{base.rstrip('/')}/batch={marker}/part={re.sub(r'[^A-Za-z0-9_.-]', '_', part)}"


def _all_fields(group: Sequence[Branch]) -> list[dict]:
    """The union of the branches' fields; a field declared twice must agree."""
    fields: dict[str, dict] = {}
    for br in group:
        for f in br.fields:
            if fields.setdefault(f["field"], f) != f:
                raise ValueError(f"branches declare field {f['field']!r} of {br.table!r} differently")
    return list(fields.values())


def _parse_by_schema(rows: DataFrame, newest: Sequence) -> DataFrame:
    """Events decoded by the schema that each carries, in the newest one's
    columns.  A batch has a few different schema texts (one, but for a change)."""
    spark = rows.sparkSession
    staged = rows.withColumn("__schema", EV.schema_text(F.col("value")))
    texts = staged.select("__schema").distinct().select("__schema", EVO.fields_of(F.col("__schema")).alias("fields")).collect()
    kept = dict(keep=[TEXT], keep_malformed=True, count_errors=True)
    newest = [r.asDict() for r in newest]
    shape = EV.parse_table_changes(_texted(spark.createDataFrame([], EV.RAW_EVENT_SCHEMA)), newest, **kept).schema
    defaults = {r["field"]: r["default"] for r in newest if r["default"] is not None}
    parts = []
    for r in texts:
        mine = staged.filter(F.col("__schema").eqNullSafe(F.lit(r["__schema"]))).drop("__schema")
        # Events without a schema block (malformed ones, tombstones) by the newest.
        fields = [f.asDict() for f in r["fields"]] if r["fields"] else newest
        parts.append(EVO.to_schema(EV.parse_table_changes(_texted(mine), fields, **kept), shape, defaults))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], shape)


def _keys_of(br: Branch, good: DataFrame, target: Target) -> list[str]:
    """The branch's keys, else the fields of the events' keys, else the
    target's own key columns, else the one that the columns name."""
    if br.keys:
        return list(br.keys)
    first = good.select(F.json_object_keys("key").alias("k")).filter(F.size("k") > 0).first()
    columns = [c for c in good.columns if c not in ("op", "table_name", "key", "ts_ms")]
    return A.resolve_key(None, [k for k in first["k"] if k in columns] if first else None, None, target.columns() or columns)


def _run_branch(spark: SparkSession, br: Branch, good: DataFrame, epoch: int, marker: str, sinks: StreamSinks, version: int):
    from pyspark.sql import Observation

    target = br.target(spark)
    letters = _side_path(sinks.dlq_path, marker, f"branch {br.name}")
    try:
        target.keys = _keys_of(br, good, target)
        cleaned = shape_branch(spark, good, br)
        if br.require_target:
            A.guard_target(spark, target.path, [c for c in target.columns() if c in target.keys], target.columns)
        counted = Observation(f"{br.name}_{marker}")
        target.write(cleaned.observe(counted, F.count(F.lit(1)).alias("n")), marker, version)
        try:
            n = int(counted.get.get("n", 0))
        except Exception:  # noqa: BLE001 - no metrics row (e.g. nothing to observe): count
            n = int(cleaned.count())
        return (int(epoch), br.name, br.table, n)
    except Exception as e:  # noqa: BLE001 - a failing branch must not stop the others
        Q.dead_letters(good, br.routing(), br.config(), RD.error_class(F.lit(str(e)))).write.mode("overwrite").parquet(letters)
        return None


def shape_branch(spark: SparkSession, good: DataFrame, br: Branch) -> DataFrame:
    """Decoded changes of a table -> a branch's rows: filter, SQL, all-null rows
    dropped.  Replayed dead letters go the same way."""
    extra = [F.get_json_object("key", f"$.{k}").cast(t).alias(k) for k, t in br.key_from_json.items()]
    decoded = good.select(*extra, *[c for c in good.columns if c not in ("table_name", "key")])
    if br.fields is not None:
        decoded = decoded.select(*br.key_from_json, "op", "ts_ms", *[f["field"] for f in br.fields])
    if br.ts_col not in decoded.columns:
        decoded = decoded.withColumn(br.ts_col, F.timestamp_millis("ts_ms").cast("timestamp_ntz"))
    filtered = FL.apply_filter(decoded, br.filter_spec, unknown="keep") if br.filter_spec else decoded
    shaped = J.run_transform(spark, filtered, br.table, br.sql, br.side_inputs)
    # K6 with the key counted as a value; a delete is never dropped (its
    # image may hold the key alone).
    meta = {"op", "ts_ms", br.ts_col, br.seq_col} - set(br.keys or [])
    keep = reduce(lambda x, y: x | y, [F.col(c).isNotNull() for c in shaped.columns if c not in meta])
    if "op" in shaped.columns:
        keep = keep | (F.coalesce(F.lower(F.col("op")), F.lit("u")) == "d")
    return shaped.filter(keep)


def _changes_schema(spark: SparkSession, schema_path: str | None, br: Branch) -> T.StructType:
    """The columns that a branch's table has now."""
    fields = br.fields
    if fields is None:
        newest = SchemaLog(spark, schema_path).newest().get(br.table) if schema_path else None
        if newest is None:
            raise A.TargetMissing(f"no schema of table {br.table} is known")
        fields = [f.asDict() for f in newest["fields"]]
    return EV.changes_schema(fields)


def replay(
    spark: SparkSession, letters: DataFrame, branches: Sequence[Branch], batch: str, max_retry: int = Q.MAX_RETRY_COUNT, schema_path: str | None = None
) -> tuple[DataFrame, list[str]]:
    """Dead letters go once more through their branch as it is *now* (its
    current filter, SQL and target); those of a branch that is gone go by the
    filter and SQL that they were stored with, into the target they were meant for.
    Returns (the letters that stay: failed again, with one retry more and fewer than
    ``max_retry``; the names of the branches that took theirs)."""
    by_route = {(br.source_id, br.table, br.destination_id, br.name): br for br in branches}
    routes = letters.groupBy("source_id", "table_name", "destination_id", "target_name", "config").agg(F.count("*").alias("n")).collect()
    stays, taken = [], []
    for r in sorted(routes, key=str):
        name = r["config"]["branch"]
        now = by_route.get((r["source_id"], r["table_name"], r["destination_id"], name))
        mine = letters.filter(
            F.col("source_id").eqNullSafe(r["source_id"])
            & F.col("table_name").eqNullSafe(r["table_name"])
            & F.col("destination_id").eqNullSafe(r["destination_id"])
            & F.col("target_name").eqNullSafe(r["target_name"])
            & (F.col("config.branch").eqNullSafe(name) & F.col("config.filter").eqNullSafe(r["config"]["filter"]) & F.col("config.sql").eqNullSafe(r["config"]["sql"]))
        )
        again = Q.retry_split(mine.filter(~Q.decoded()), max_retry)  # nothing that a branch could take
        stays.append(again.filter(F.col("action") == "requeue").drop("action"))
        mine = mine.filter(Q.decoded())
        try:
            if now is None:
                like = [br for br in branches if br.table == r["table_name"]]
                if not like:
                    raise A.TargetMissing(f"no branch reads table {r['table_name']}")
                stored = Q.stored_config(r["config"])
                now = replace(like[0], name=name, target_path=r["target_name"], filter_spec=stored["filter"], sql=stored["sql"])
            target = now.target(spark)
            rows = Q.restore_records(mine, _changes_schema(spark, schema_path, now))
            target.keys = _keys_of(now, rows, target)
            if now.require_target:
                A.guard_target(spark, target.path, [], target.columns)
            target.write(shape_branch(spark, rows, now), f"{batch}-{name}")
            taken.append(name)
        except Exception as e:  # noqa: BLE001 - the letters stay
            again = Q.retry_split(mine.withColumn("error", RD.error_class(F.lit(str(e)))), max_retry)
            stays.append(again.filter(F.col("action") == "requeue").drop("action"))
    left = reduce(DataFrame.unionByName, stays) if stays else letters.limit(0)
    return left, taken


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """A random name kept beside the stream's checkpoint: restarts share it, a
    new checkpoint gets a new one (its epochs start at 0 again)."""
    path = f"{checkpoint.rstrip('/')}/stream_name"
    if not path_exists(spark, path):
        write_text(spark, path, uuid.uuid4().hex)
    return read_text(spark, path).strip()


def run_change_stream(
    spark: SparkSession,
    source_path: str,
    branches: Sequence[Branch],
    sinks: StreamSinks,
    checkpoint: str,
    max_files_per_trigger: int | None = 1000,
    available_now: bool = True,
    observe: bool = True,
):
    """Start the change pipeline; with ``available_now`` it processes what is
    there and stops.  Returns the finished (or running) query."""
    stream = change_stream(spark, source_path, max_files_per_trigger)
    if observe:
        # V7: live counters per micro-batch, reported in query progress.
        stream = stream.observe("changes", F.count(F.lit(1)).alias("events"), F.count(F.when(F.col("value").isNull(), 1)).alias("tombstones"))

    name = stream_name(spark, checkpoint)

    def each(batch: DataFrame, epoch: int) -> None:
        process_batch(spark, batch, epoch, branches, sinks, name)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="500 milliseconds")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


# ---------------------------------------------------------------- landing -> target (K5)


def landing_merge_stream(
    spark: SparkSession,
    landing_path: str,
    schema: T.StructType,
    target: Target,
    checkpoint: str,
    op_col: str = "OPERATION",
    max_files_per_trigger: int = 1000,
):
    """K5: merge what arrived in the landing table since the last run into
    the target (incremental, checkpointed; nothing is deleted from landing,
    so rows arriving during a merge are simply picked up next time)."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing_path)
    name = stream_name(spark, checkpoint)

    def each(batch: DataFrame, epoch: int) -> None:
        target.write(batch.withColumnRenamed(op_col, target.op_col) if op_col != target.op_col else batch, f"{name}-{epoch}")

    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


# ---------------------------------------------------------------- windowed monitor


def hourly_lag_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    out: Target,
    checkpoint: str,
    watermark: str | None = None,
    max_files_per_trigger: int = 1000,
):
    """A5 as a stream: hourly mean lag per source; windows are upserted into
    ``out`` as they update.  An update's version is the number of rows it counts,
    which only grows for an hour, also when a new checkpoint starts over.  Rows
    however late count; a ``watermark`` bounds the state instead, and rows later
    than it are left out."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
    # Event-time watermarks need an instant; zone-less times are read as UTC.
    stream = stream.withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))
    if watermark:
        stream = stream.withWatermark("recorded_at", watermark)
    agg = (
        stream.groupBy(F.window("recorded_at", "1 hour").alias("w"), "source_id")
        .agg(F.sum("size_bytes").alias("total_bytes"), F.count("*").alias("n"))
        .select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "source_id", "total_bytes", "n")
    )
    name = stream_name(spark, checkpoint)

    def each(batch: DataFrame, epoch: int) -> None:
        rows = batch.withColumn("op", F.lit("u")).withColumn("ts", F.col("n")).withColumn("seq", F.lit(0).cast("long"))
        out.write(rows, f"{name}-{epoch}")

    q = agg.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint directory."""
    return scratch_path(spark, name)




class BatchMetrics:
    """V7: collects each micro-batch's observed metrics (``observe`` on the
    stream) through a ``StreamingQueryListener`` -- one small record for each of
    the last ``keep`` batches, on the driver."""

    def __init__(self, spark: SparkSession, name: str = "changes", keep: int = 10_000):
        from pyspark.sql.streaming import StreamingQueryListener

        self.records: deque = deque(maxlen=keep)
        outer = self

        class _Listener(StreamingQueryListener):
            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                p = event.progress
                metrics = p.observedMetrics.get(name) if p.observedMetrics else None
                if metrics is not None:
                    outer.records.append({"batch_id": p.batchId, "num_input_rows": p.numInputRows, **metrics.asDict()})

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass

        self._listener = _Listener()
        self.spark = spark
        spark.streams.addListener(self._listener)

    def close(self) -> None:
        self.spark.streams.removeListener(self._listener)
