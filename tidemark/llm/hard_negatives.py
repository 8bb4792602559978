"""Hard-negative mining by a vertical scan with branch and bound.

Rows take part with ``floor(256 x)`` of every component.  They are dealt by hash
into groups of about ``group_rows`` and anchors into groups of about
``group_anchors``; every (anchor group, row group) cell is a task's work, so
neither side is ever held whole.

In a cell the rows are stored by dimension, sorted by label, with the least and
greatest value of each dimension in every zone of ``ZONE`` rows.  An anchor reads
the dimensions in descending order of its own magnitude.  After some of them a
row's score lies between its partial score plus the least and plus the greatest
that the unread dimensions can add in its zone.  The candidate bitmap keeps the
rows that may still matter:

* positives: the greatest possible score reaches the ``positives``-th largest
  least one among the same label;
* negatives: for some positive the range meets the window of permitted scores, and
  reaches the ``negatives``-th largest least score of those that surely lie in it.

What is left after the last dimension has exact scores.  The cells' first rows are
ranked first among shares of the cells, then over all.

Results for odd input: a row with a null vec_id, label or vector, or a null or
non-finite component takes no part.  Identical rows count once; rows that share a
vec_id but differ each take part, and are never each other's positives.  Vectors
of different length are compared over the shorter one; an empty vector scores 0.
Scores must fit in 64 bits.  Equal scores go by ascending vec_id.  An anchor
without a positive, or a pair without a row in its window (as when the positive's
score is negative), has no rows; an empty table gives none.  There are no texts;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import _written
from tidemark.llm.ranking import first_rows
from tidemark.sources.tables import read_table

ZONE = 256
FRACTIONS = (8, 4, 2, 1.34, 1)  # bounds are tested after these parts of the dimensions
EXACT = 1 << 53  # integers below are exact as doubles


def rows_of(embeddings: DataFrame, shifted_every: int = 7, labels: int = 10) -> DataFrame:
    """(vec_id, label, v): the rows that take part, each once."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("e")
    )
    finite = "forall(e, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL").where(F.coalesce(F.expr(finite), F.lit(False)))
    return rows.select(
        "vec_id",
        F.expr(f"CASE WHEN vec_id % {shifted_every} = 0 THEN (label + 1) % {labels} ELSE label END AS label"),
        F.expr("transform(e, x -> cast(floor(256D * cast(x AS double)) AS long)) AS v"),
    ).distinct()


def _matrix(column, dims: int | None = None) -> np.ndarray:
    """Rows x dimensions of a list column; shorter vectors are filled with 0."""
    column = column.combine_chunks()
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    dims = int(sizes.max(initial=0)) if dims is None else dims
    out = np.zeros((len(sizes), dims), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    flat = column.flatten().to_numpy()
    inside = place < dims
    out[owner[inside], place[inside]] = flat[inside]
    return out


class Cell:
    """The rows of one group, by dimension."""

    def __init__(self, rows: pa.Table):
        label = rows.column("label").to_numpy()
        order = np.lexsort((rows.column("vec_id").to_numpy(), label))
        self.label, self.id = label[order], rows.column("vec_id").to_numpy()[order]
        v = _matrix(rows.column("v"))[order]
        self.dims = v.shape[1]
        self.most = int(np.abs(v).max(initial=0))
        cuts = np.arange(0, len(v), ZONE)
        self.low, self.high = np.minimum.reduceat(v, cuts), np.maximum.reduceat(v, cuts)
        self.zone = np.arange(len(v)) // ZONE
        self.columns = np.ascontiguousarray(v.T)
        self.real = self.columns.astype(np.float64)

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.label, [label, label + 1]))

    def scan(self, a: np.ndarray, rows: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of the candidates that ``keep(least, greatest)``
        leaves, asked as dimensions are read."""
        exact = int(np.abs(a).max(initial=0)) * self.most * max(self.dims, 1) < EXACT
        columns, a = (self.real, a.astype(np.float64)) if exact else (self.columns, a)
        order = np.argsort(-np.abs(a), kind="stable")
        ends = a[order] * self.low[:, order], a[order] * self.high[:, order]
        least, greatest = (np.cumsum(f(*ends)[:, ::-1], axis=1)[:, ::-1] for f in (np.minimum, np.maximum))
        score = np.zeros(len(rows), columns.dtype)
        read = 0
        for part in FRACTIONS:
            upto = self.dims if part == 1 else int(self.dims / part)
            if upto == read < self.dims:
                continue
            some = order[read:upto]
            score += a[some] @ columns[np.ix_(some, rows)]
            read = upto
            if read < self.dims:
                zone = self.zone[rows]
                stay = keep(score + least[zone, read], score + greatest[zone, read])
            else:
                stay = keep(score, score)
            if not stay.all():
                rows, score = rows[stay], score[stay]
        return rows, score.astype(np.int64)

    def first(self, rows: np.ndarray, score: np.ndarray, top: int) -> np.ndarray:
        """Places of the first rows: higher scores, then smaller ids."""
        return np.lexsort((self.id[rows], -score))[:top]


def _nth(values: np.ndarray, n: int):
    """The n-th largest value."""
    return np.partition(values, -n)[-n]


def positives_in(cell: Cell, anchor: int, label: int, a: np.ndarray, top: int):
    """(ids, scores) of the anchor's first other rows of its label."""

    def keep(least, greatest):
        return greatest >= _nth(least, top) if len(least) > top else np.ones(len(least), bool)

    same = cell.of_label(label)
    rows = np.arange(same.start, same.stop)
    rows, score = cell.scan(a, rows[cell.id[rows] != anchor], keep)
    best = cell.first(rows, score, top)
    return cell.id[rows[best]], score[best]


def negatives_in(cell: Cell, label: int, a: np.ndarray, low: np.ndarray, high: np.ndarray, top: int):
    """For every window of scores (low, high): (ids, scores) of the first rows of
    other labels in it."""

    def keep(least, greatest):
        may = (greatest >= low[:, None]) & (least <= high[:, None])
        sure = (least >= low[:, None]) & (greatest <= high[:, None])
        for i in np.flatnonzero(sure.sum(axis=1) > top):
            may[i] &= greatest >= _nth(least[sure[i]], top)
        return may.any(axis=0)

    same = cell.of_label(label)
    rows = np.concatenate([np.arange(same.start), np.arange(same.stop, len(cell.id))])
    rows, score = cell.scan(a, rows, keep)
    for lo, hi in zip(low, high, strict=True):
        at = np.flatnonzero((score >= lo) & (score <= hi))
        best = at[cell.first(rows[at], score[at], top)]
        yield cell.id[rows[best]], score[best]


def window_of(positive_score: np.ndarray, low: int, high: int):
    """The scores s with low * p <= 100 s <= high * p."""
    return -((-low * positive_score) // 100), (high * positive_score) // 100


def _table(parts: list[tuple], names: list[str]) -> pa.Table:
    """Columns from parts whose single values are repeated to the part's length."""
    columns = [np.concatenate([np.broadcast_to(p[i], len(p[-1])) for p in parts] or [np.zeros(0, np.int64)]) for i in range(len(names))]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


POSITIVE = ["anchor", "anchor_id", "share", "positive_id", "positive_score"]
NEGATIVE = ["anchor", "anchor_id", "share", "positive_id", "positive_score", "turn", "negative_id", "negative_score"]


def _anchors(table: pa.Table, cell: Cell):
    a = _matrix(table.column("anchor_v"), cell.dims)
    names = ("anchor", "anchor_id", "anchor_label", "share")
    return [(*(table.column(n)[i].as_py() for n in names), a[i]) for i in range(len(a))]


def _positive_cell(top: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        parts = []
        if rows.num_rows and anchors.num_rows:
            cell = Cell(rows)
            for key, anchor, label, g, a in _anchors(anchors, cell):
                parts.append((key, anchor, g, *positives_in(cell, anchor, label, a, top)))
        return _table(parts, POSITIVE)

    return run


def _negative_cell(top: int, low: int, high: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        parts = []
        if rows.num_rows and anchors.num_rows:
            cell = Cell(rows)
            pairs = anchors.column("pairs").to_pylist()
            for (key, anchor, label, g, a), asked in zip(_anchors(anchors, cell), pairs, strict=True):
                asked = sorted((p["rank"], p["positive_id"], p["positive_score"]) for p in asked)
                windows = window_of(np.array([p[2] for p in asked], np.int64), low, high)
                for (turn, positive, score), found in zip(asked, negatives_in(cell, label, a, *windows, top), strict=True):
                    parts.append((key, anchor, g, positive, score, turn, *found))
        return _table(parts, NEGATIVE)

    return run


def _shape(names: list[str]) -> str:
    return ", ".join(f"{n} long" for n in names)


def mine(
    embeddings: DataFrame,
    anchor_every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    group_rows: int = 8192,
    group_anchors: int = 1024,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score: for every anchor (vec_id divisible by ``anchor_every``) and
    each of its first ``positives`` other rows of its label, the first
    ``negatives`` rows of other labels whose score is between ``low`` and
    ``high`` percent of the positive's."""
    rows = _written(rows_of(embeddings), "negatives-rows")
    is_anchor = F.expr(f"vec_id % {anchor_every} = 0")
    n, n_anchors = rows.agg(F.count("*"), F.count(F.when(is_anchor, 1))).first()
    shares, groups = -(-n // group_rows) or 1, -(-n_anchors // group_anchors) or 1
    name = F.xxhash64("vec_id", "label", "v")
    of = rows.withColumn("g", F.pmod(name, F.lit(shares))).withColumn("ab", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    anchors = rows.where(is_anchor).withColumn("anchor", name)
    dealt = anchors.withColumn("ab", F.pmod(F.xxhash64("anchor"), F.lit(groups)).cast("int"))
    dealt = dealt.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))
    dealt = dealt.select("anchor", F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), F.col("v").alias("anchor_v"), "share", F.col("ab").alias("anchor_ab"))

    def cells(asking: DataFrame, work, names: list[str]) -> DataFrame:
        return of.groupBy("ab", "g").cogroup(asking.groupBy("anchor_ab", "share")).applyInArrow(work, _shape(names))

    found = cells(dealt, _positive_cell(positives), POSITIVE)
    order = [F.desc("positive_score"), F.asc("positive_id")]
    found = first_rows(found, ["anchor"], order, positives, F.col("share"))
    pairs = found.groupBy("anchor").agg(F.collect_list(F.struct("rank", "positive_id", "positive_score")).alias("pairs"))
    pairs = _written(pairs, "negatives-pairs")  # at most ``positives`` an anchor

    found = cells(dealt.join(pairs, "anchor"), _negative_cell(negatives, low, high), NEGATIVE)
    order = [F.desc("negative_score"), F.asc("negative_id")]
    found = first_rows(found, ["anchor", "turn"], order, negatives, F.col("share"))
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark, sf_dir):
    """Hard negatives for every hundredth embedding."""
    return mine(read_table(spark, sf_dir, "embeddings"))


SQL = """
WITH vectors AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS al, a.v AS av, b.vec_id AS id, b.label AS bl,
         CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: coalesce(p[1] * p[2], 0))), 0) AS BIGINT) AS s
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, al, av, id AS positive_id, s AS ps,
         row_number() OVER (PARTITION BY anchor_id, al, av ORDER BY s DESC, id) AS turn
  FROM scored WHERE al = bl AND id <> anchor_id QUALIFY turn <= 5),
negatives AS (
  SELECT p.anchor_id, positive_id, ps, n.id AS negative_id, n.s AS ns,
         row_number() OVER (PARTITION BY p.anchor_id, p.al, p.av, turn ORDER BY n.s DESC, n.id) AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND n.al = p.al AND n.av = p.av
    AND n.bl <> p.al AND 30 * ps <= 100 * n.s AND 100 * n.s <= 90 * ps
  QUALIFY rank <= 10)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, ps AS positive_score, ns AS negative_score
FROM negatives
"""
