"""Greedy runs over ordered groups, with a group split over many tasks.

A group's rows, in order, are cut into runs: a row opens a new run when the open
run can't take it.  Which row that is depends on where the open run began, so a
plain fold would walk a group in one task.  Three operators are of this kind:

* request packing (K7): a request is full when a row ends beyond its first byte
  plus the limit;
* the alert counter (V5): a notification is full after ``limit`` alerts, and an
  alert that is not forced opens the next one;
* the alert throttle (V6): a created alert holds back others for some minutes, but
  not after an acknowledgement.

``Rule`` says so with two numbers for each row: ``at``, which never falls within a
group, and ``upto``, what a run that begins here covers.  A row opens a run if it
is ``always`` one that does, or if it is ``eligible`` and its ``at`` is greater
than the open run's ``upto``.  As the next opening row depends on the last one
only, rows form a forest of jumps:

1. the rows are range-partitioned and sorted by (group, order); a *slice* is the
   part of a group in one partition, and only the first and last slice of a
   partition may belong to a group of several;
2. in each slice the rows whose run outlasts the slice (*leavers*) are looked up in
   the slice where the run ends: there the first opening row is found, and its
   jumps are followed to that slice's own leaver -- one edge, with the number of
   runs that it passes;
3. pointer doubling over these edges (log2 of the number of slices, a join each)
   tells which leavers the group's first row reaches, and after how many runs;
4. every partition is read again from its exact open run.

The driver holds at most two rows for each partition.  Tasks stream their sorted
partition; a slice of a group of several is held as a few numbers a row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import ordering as O
from tidemark.session import scratch_path

NONE = np.iinfo(np.int64).min  # covers nothing
UNKNOWN = -(1 << 62)  # a null value, which sorts first


@dataclass(frozen=True)
class Rule:
    """``by``: what ``at`` counts -- "sum" (the values up to and with the row),
    "value" (the value itself) or "index" (the row's number in its group).  A run
    that begins at a row covers ``reach`` more from where the row begins."""

    by: str
    reach: int

    def numbers(self, value: np.ndarray, row: np.ndarray, total: np.ndarray):
        """(at, upto) of rows with these values, numbers in their group, and sums
        of the group's values up to and with them."""
        if self.by == "index":
            return row, row + self.reach
        if self.by == "value":
            return value, value + self.reach
        return total, np.maximum(total - value + self.reach, total)  # a row beyond the reach is a run of its own

    def summed(self, value: np.ndarray) -> np.ndarray:
        """What rows add to their group's sum: nothing where no bound counts by it,
        as a sum of times doesn't fit 64 bits."""
        return value if self.by == "sum" else np.zeros(len(value), np.int64)

    def moved(self, at: int, rows_before: int, sum_before: int) -> int:
        """An ``at`` that was counted from the slice's first row."""
        return at + {"index": rows_before, "value": 0, "sum": sum_before}[self.by]


def openings(at, upto, eligible, always, covered: int, part=None) -> np.ndarray:
    """The row that opens the next run, or len: at first when ``covered`` is covered,
    then after a run that begins at each row.  Rows may be of several groups (numbered
    by ``part``, in order) if the first row of each but the first is ``always`` one."""
    n = len(at)
    part = np.zeros(n, np.int64) if part is None else part
    seat = np.flatnonzero(eligible)
    # How many seats are at or below each bound, or in an earlier group.
    value = np.concatenate([at[seat], [covered], upto])
    of = np.concatenate([part[seat], part[:1], part])
    asks = np.arange(len(value)) >= len(seat)
    order = np.lexsort((asks, value, of))
    below = np.empty(len(value), np.int64)
    below[order] = np.cumsum(~asks[order])
    free = np.append(seat, n)[below[len(seat) :]]
    forced = np.append(np.flatnonzero(always), n)
    forced = forced[np.searchsorted(forced[:-1], np.arange(n + 1), "left")]  # at or after 0, ..., n
    return np.minimum(free, forced)


def reached(jump: np.ndarray, start: int) -> np.ndarray:
    """Mask of the rows on the path from ``start``; ``jump`` leads to len at the end."""
    n = len(jump)
    on = np.zeros(n + 1, bool)
    on[start] = True
    path, hop = np.array([start]), np.append(jump, n)
    while True:
        more = hop[path]
        more = more[more < n]
        if not len(more):
            return on[:n]
        on[more] = True
        path, hop = np.concatenate([path, more]), hop[hop]


def ends(jump: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the last row on each row's path, number of rows on it)."""
    n = len(jump)
    last, count, hop = np.arange(n), np.ones(n, np.int64), jump.copy()
    while True:
        go = np.flatnonzero(hop < n)
        if not len(go):
            return last, count
        to = hop[go]
        last[go], count[go], hop[go] = last[to], count[go] + count[to], hop[to]


def _cuts(group: pa.Array) -> np.ndarray:
    """First row of every stretch of equal values, and the end."""
    if len(group) < 2:
        return np.array([0, len(group)])
    new = pc.not_equal(group.slice(1), group.slice(0, len(group) - 1)).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(new) + 1, [len(group)]])


def _columns(batch: pa.RecordBatch):
    """(partition, group, value, eligible, always) of a batch."""
    get = lambda n: batch.column(batch.schema.get_field_index(n))
    flags = (pc.fill_null(get(n), False).to_numpy(zero_copy_only=False) for n in ("__eligible", "__always"))
    return get("__pid")[0].as_py(), get("__group"), get("__value").to_numpy().astype(np.int64), *flags


def _map_edges(rule: Rule):
    """First and last slice of the partition, numbers counted from its first row:
    (pid, group, rows, total, greatest eligible at, last always)."""

    def run(batches):
        kept: list[dict] = []  # the first slice and the current one
        pid = None
        for batch in batches:
            if not batch.num_rows:
                continue
            pid, group, value, eligible, always = _columns(batch)
            adds = rule.summed(value)
            cut = _cuts(group)
            for j in sorted({0, len(cut) - 2}):
                a, b = int(cut[j]), int(cut[j + 1])
                name = group[a].as_py()
                if not kept or kept[-1]["group"] != name:
                    kept = [*kept[:1], {"group": name, "rows": 0, "total": 0, "high": NONE, "forced": -1}]
                s = kept[-1]
                at, _ = rule.numbers(value[a:b], s["rows"] + np.arange(b - a), s["total"] + np.cumsum(adds[a:b]))
                if eligible[a:b].any():
                    s["high"] = int(at[eligible[a:b]][-1])
                if always[a:b].any():
                    s["forced"] = s["rows"] + int(np.flatnonzero(always[a:b])[-1])
                s["rows"] += b - a
                s["total"] += int(adds[a:b].sum())
        if pid is not None:
            names = ["group", "rows", "total", "high", "forced"]
            yield pa.RecordBatch.from_arrays(
                [pa.array([pid] * len(kept), pa.int64())]
                + [pa.array([s[n] for s in kept], pa.string() if n == "group" else pa.int64()) for n in names],
                ["pid", *names],
            )

    return run


class Slices:
    """The slices of the groups that lie in several partitions; ``of`` finds one
    by (partition, group)."""

    def __init__(self, rows: list, rule: Rule):
        by_group: dict[str, list] = {}
        for r in sorted(rows, key=lambda r: r["pid"]):
            by_group.setdefault(r["group"], []).append(r)
        self.of: dict[tuple, dict] = {}
        self.groups: list[list[dict]] = []
        for parts in by_group.values():
            if len(parts) < 2:
                continue
            n = total = 0
            slices = []
            for r in parts:
                high = r["high"] if r["high"] == NONE else rule.moved(r["high"], n, total)
                s = {"pid": r["pid"], "gid": len(self.groups), "rows_before": n, "sum_before": total, "rows": r["rows"], "high": high, "forced": r["forced"]}
                n, total = n + r["rows"], total + r["total"]
                slices.append(s)
                self.of[r["pid"], r["group"]] = s
            self.groups.append(slices)
        # Where a run is over at the latest: the first later slice with an eligible
        # row beyond what it covers, or with a row that always opens one.
        for slices in self.groups:
            forced = None
            for s in reversed(slices):
                s["next_forced"] = forced
                forced = s["pid"] if s["forced"] >= 0 else forced
            highs = np.maximum.accumulate(np.array([s["high"] for s in slices], np.int64))
            for i, s in enumerate(slices):
                s["later"] = (highs[i + 1 :], np.array([x["pid"] for x in slices[i + 1 :]], np.int64))

    def end_of(self, s: dict, upto: np.ndarray) -> np.ndarray:
        """The partition where runs that leave slice ``s`` are over (-1: never)."""
        highs, pids = s["later"]
        # Accumulated from the group's start, but rows of s and before are covered.
        to = np.append(pids, -1)[np.searchsorted(highs, upto, "right")]
        if s["next_forced"] is not None:
            to = np.where((to < 0) | (to > s["next_forced"]), s["next_forced"], to)
        return to


@dataclass
class Stretch:
    """A batch's rows: numbers of each, ``cut`` at the groups, and whether the first
    group goes on from the batch before; ``slices``: (first row, end, slice) of its
    groups of several slices, which can only be the first and the last."""

    batch: pa.RecordBatch
    cut: np.ndarray
    goes_on: bool
    row: np.ndarray
    at: np.ndarray
    upto: np.ndarray
    eligible: np.ndarray
    always: np.ndarray
    slices: list


def _walk(batches, slices: Slices, rule: Rule):
    current, rows, total = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        pid, group, value, eligible, always = _columns(batch)
        cut = _cuts(group)
        sizes = np.diff(cut)
        before, sums = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        inside = []
        goes_on = current == (group[0].as_py(),)
        for j in sorted({0, len(sizes) - 1}):
            s = slices.of.get((pid, group[int(cut[j])].as_py()))
            if s:
                before[j], sums[j] = s["rows_before"], s["sum_before"]
                inside.append((int(cut[j]), int(cut[j + 1]), s))
        if goes_on:
            before[0], sums[0] = rows, total
        first = np.repeat(cut[:-1], sizes)
        row = np.arange(len(value)) - first + np.repeat(before, sizes)
        adds = rule.summed(value)
        upto_here = np.cumsum(adds)
        upto_here += np.repeat(sums - upto_here[cut[:-1]] + adds[cut[:-1]], sizes)
        at, upto = rule.numbers(value, row, upto_here)
        yield Stretch(batch, cut, goes_on, row, at, upto, eligible, always | (row == 0), inside)
        current, rows, total = (group[int(cut[-2])].as_py(),), int(row[-1]) + 1, int(upto_here[-1])


LEAVER = "gid long, pid long, row long, upto long"
ROW = "gid long, pid long, row long, at long, upto long, eligible boolean, always boolean"
EDGE = "gid long, row long, pid long, to long, runs long, upto long"


def _map_leavers(slices_bc, rule: Rule):
    """Rows whose run outlasts their slice, with the partition where it is over."""

    def run(batches):
        slices = slices_bc.value
        for x in _walk(batches, slices, rule):
            for a, b, s in x.slices:
                row, upto = x.row[a:b], x.upto[a:b]
                leaves = (upto >= s["high"]) & (row >= s["rows_before"] + s["forced"])
                row, upto = row[leaves], upto[leaves]
                to = slices.end_of(s, upto)
                keep = to >= 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (np.full(keep.sum(), s["gid"]), to[keep], row[keep], upto[keep])],
                    ["gid", "pid", "row", "upto"],
                )

    return run


def _map_rows(slices_bc, rule: Rule):
    """The rows of the groups of several slices, as numbers."""

    def run(batches):
        for x in _walk(batches, slices_bc.value, rule):
            for a, b, s in x.slices:
                columns = (np.full(b - a, s["gid"]), np.full(b - a, s["pid"]), *(c[a:b] for c in (x.row, x.at, x.upto, x.eligible, x.always)))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gid", "pid", "row", "at", "upto", "eligible", "always"])

    return run


def _edges(leavers: pa.Table, rows: pa.Table) -> pa.Table:
    """For each run that is over in this slice: the leaver that the slice's runs
    lead to (``to``, and what that covers) and the number of runs that begin here."""
    rows = rows.sort_by("row")
    row, at, upto = (rows.column(n).to_numpy() for n in ("row", "at", "upto"))
    eligible, always = (rows.column(n).to_numpy(zero_copy_only=False) for n in ("eligible", "always"))
    covered = leavers.column("upto").to_numpy()
    if not len(covered) or not len(row):
        return pa.table({n: pa.array([], t) for n, t in zip(("gid", "row", "pid", "to", "runs", "upto"), [pa.int64()] * 6, strict=True)})
    jump = openings(at, upto, eligible, always, NONE)[1:]
    last, count = ends(jump)
    seat = np.flatnonzero(eligible)
    first = np.append(seat, len(row))[np.searchsorted(at[seat], covered, "right")]
    first = np.minimum(first, np.append(np.flatnonzero(always), len(row))[0])
    to = last[first]
    return pa.table(
        {
            "gid": leavers.column("gid"),
            "row": leavers.column("row"),
            "pid": leavers.column("pid"),
            "to": pa.array(row[to]),
            "runs": pa.array(count[first]),
            "upto": pa.array(upto[to]),
        }
    )


def _reached(edges: DataFrame, groups: int, slices: int) -> list:
    """The edges on the paths from each group's first row, with the number of
    runs before them: (gid, row, to, upto, before)."""
    spark = edges.sparkSession

    def written(df):
        path = scratch_path(spark, "runs")
        df.write.parquet(path)
        return spark.read.parquet(path)

    hop = written(edges.select("gid", "row", "to", "runs"))
    edges = written(edges)
    path = spark.createDataFrame([(g, -1, 0) for g in range(groups)], "gid long, row long, before long")
    for _ in range(max(1, slices.bit_length())):  # a path has at most one edge a slice
        on = path.join(hop, ["gid", "row"]).select("gid", F.col("to").alias("row"), (F.col("before") + F.col("runs")).alias("before"))
        path = written(path.unionByName(on))
        far = hop.select("gid", F.col("row").alias("to"), F.col("to").alias("beyond"), F.col("runs").alias("more"))
        hop = written(hop.join(far, ["gid", "to"]).select("gid", "row", F.col("beyond").alias("to"), (F.col("runs") + F.col("more")).alias("runs")))
    # One edge for each slice that has an opening row: at most two a partition.
    return path.distinct().join(edges, ["gid", "row"]).select("gid", "row", "pid", "to", "runs", "upto", "before").collect()


def _open_runs(slices: Slices, found: list) -> dict[tuple, tuple]:
    """(partition, group number) -> (covered, runs, first row) of the run that is
    open where the slice begins."""
    by_group: dict[int, list] = {}
    for r in found:
        by_group.setdefault(r["gid"], []).append(r)
    out = {}
    for gid, parts in enumerate(slices.groups):
        state, at = (NONE, 0, 0), 0
        steps = sorted(by_group.get(gid, []), key=lambda r: r["pid"])
        for s in parts:
            out[s["pid"], gid] = state
            while at < len(steps) and steps[at]["pid"] <= s["pid"]:
                r = steps[at]
                state, at = (r["upto"], r["before"] + r["runs"], r["to"]), at + 1
    return out


def _map_runs(slices_bc, open_bc, rule: Rule):
    """All columns, with the run's number and the row's place in it."""

    def run(batches):
        state = (NONE, 0, 0)  # covered, runs and first row of the open run
        for x in _walk(batches, slices_bc.value, rule):
            if not x.goes_on:
                state = (NONE, 0, 0)
                if x.slices and x.slices[0][0] == 0:
                    s = x.slices[0][2]
                    state = open_bc.value[s["pid"], s["gid"]]
            sizes = np.diff(x.cut)
            jump = openings(x.at, x.upto, x.eligible, x.always, state[0], np.repeat(np.arange(len(sizes)), sizes))
            opens = reached(jump[1:], int(jump[0]))
            number = np.cumsum(opens)
            earlier = -number[x.cut[:-1]] + opens[x.cut[:-1]]
            earlier[0] += state[1]
            number += np.repeat(earlier, sizes)
            at = np.maximum.accumulate(np.where(opens, np.arange(len(opens)), -1))
            begin = np.where(at >= 0, x.row[at], state[2])
            out = [*x.batch.columns, pa.array(number), pa.array(x.row - begin + 1)]
            yield pa.RecordBatch.from_arrays(out, [*x.batch.schema.names, "__run", "__place"])
            # The open run of the last group goes on in the next batch.
            covered = state[0] if at[-1] < 0 else int(x.upto[at[-1]])
            state = (covered, int(number[-1]), int(begin[-1]))

    return run


def greedy_runs(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    rule: Rule,
    value: str | None = None,
    eligible: str | None = None,
    always: str | None = None,
    run: str = "run_no",
    place: str = "place",
    partitions: int | None = None,
) -> DataFrame:
    """``df`` with the number of each row's run in its group and the row's place
    in it (both from 1).  ``order`` must be a total order within a group."""
    spark = df.sparkSession
    staged = df.select(
        *df.columns,
        F.to_json(F.struct(*[F.col(g) for g in group])).alias("__group"),
        F.coalesce(F.col(value).cast("long") if value else F.lit(0), F.lit(0 if rule.by == "sum" else UNKNOWN)).cast("long").alias("__value"),
        (F.col(eligible) if eligible else F.lit(True)).alias("__eligible"),
        (F.col(always) if always else F.lit(False)).alias("__always"),
    )
    numbered = O._number_partitions(staged, [F.col(c) for c in [*group, *order]], partitions).drop("__local")
    kinds = "pid long, group string, rows long, total long, high long, forced long"
    slices = Slices(numbered.mapInArrow(_map_edges(rule), kinds).collect(), rule)  # two rows a partition
    slices_bc = spark.sparkContext.broadcast(slices)
    found: list = []
    if slices.groups:
        leavers = numbered.mapInArrow(_map_leavers(slices_bc, rule), LEAVER)
        roots = spark.createDataFrame([(g, x[0]["pid"], -1, NONE) for g, x in enumerate(slices.groups)], LEAVER)
        rows = numbered.mapInArrow(_map_rows(slices_bc, rule), ROW)
        edges = leavers.unionByName(roots).groupBy("gid", "pid").cogroup(rows.groupBy("gid", "pid")).applyInArrow(_edges, EDGE)
        found = _reached(edges, len(slices.groups), max(map(len, slices.groups)))
    open_bc = spark.sparkContext.broadcast(_open_runs(slices, found))
    schema = T.StructType([*numbered.schema.fields, T.StructField("__run", T.LongType()), T.StructField("__place", T.LongType())])
    out = numbered.mapInArrow(_map_runs(slices_bc, open_bc, rule), schema)
    return out.select(*df.columns, F.col("__run").alias(run), F.col("__place").alias(place))
