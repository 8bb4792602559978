"""N-gram Jaccard join: the product of the document by n-gram incidence matrix
with its transpose, in blocks, keeping only pairs that can reach the bound.

Texts with equal n-gram sets are one *class* (linked by definition, never
paired).  For classes x, y with |x| <= |y| a link needs an overlap of
``ceil(t (|x| + |y|) / (1 + t))`` and |x| >= t |y|.  Under any fixed order of
the n-grams, two linked sets share one among their first ``n - ceil(t n) + 1``,
so only these columns enter the product; an entry at position i of n can add at
most ``n - i``, and pairs whose sizes or positions rule the overlap out are
dropped inside the join.  The surviving pairs' overlaps are then accumulated
exactly, column block by column block, and given up as soon as the remaining
columns can't reach the bound.

Order: n-gram hashes ascending, but n-grams that stand in very many documents
come last, by count.  The counts cover all documents (in the part of the hash
range where prefixes lie); the list is bounded (``hot_limit``) and only moves
work, no result depends on it.

A column held by many classes (a cluster of near copies) is not squared: a few
pivot classes are compared with all of the column, the links found so far are
joined to components, and then only classes outside the column's largest
component are compared with those of about their size that they aren't connected
to.  Links within a component may thus stay unlisted; components lose nothing.
Every join by column is one of written tables, so a hot column's rows are split
over tasks.

Results for odd input: a null or empty text, or one without words, has an empty
set, is linked with nothing and is its own component.  Repeated rows give
repeated result rows.  A null doc_id takes part in linking but never names a
component.  An empty table gives no rows; only doc_id and text are read
(``representatives`` hands on all columns).  A very long text is a block of its own,
its set 8 bytes a distinct shingle.  Sets are compared by 64-bit n-gram hashes; which
of several possible pivots or hot grams is taken changes no component.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bitmap
from tidemark.llm.components import _written, components
from tidemark.llm.decontaminate import row_key
from tidemark.llm.textblocks import LOWER, NOT_SPACE, SLOT, U64, Block, blocks, inside, mix, rolling, small_batches
from tidemark.sources.tables import read_table

REGION = int(0.28 * 2**64)  # hash range in which nearly all prefixes lie
FOLD = 1 << 63  # unsigned hashes travel as signed longs


def shingle_sets(column, k: int):
    """Per text: the sorted distinct hashes of its k-word shingles (unsigned)."""
    block = Block(column, lower=True)
    starts, ends, ptr = block.words(NOT_SPACE)
    h = block.hashes(starts, ends)
    grams, ok = rolling(h, k), inside(ptr, k)
    for i in range(block.n):
        a, b = ptr[i], ptr[i + 1]
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        elif b > a:
            short = h[a:b] * SLOT[: b - a]
            yield mix(np.array([short.sum() + U64(int(b - a))], U64))
        else:
            yield np.zeros(0, U64)
    del ok


def class_key(s: np.ndarray) -> int:
    """A 64-bit key of a whole set (0 only for the empty set)."""
    if not len(s):
        return 0
    total = int(mix(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum()) ^ int(mix(s).sum()) * 3 + len(s)
    key = int(mix(np.array([total & 0xFFFFFFFFFFFFFFFF], U64))[0])
    return (key - 2**64 if key >= FOLD else key) or 1


def _prefix(n: int, percent: int) -> int:
    return n - (n * percent + 99) // 100 + 1


# Entries behind a prefix, in SQL: ceil(t n) - 1.
_REST = "(({0} * {1}L + 99L) div 100 - 1)"


def _map_sets(k):
    def run(batches):
        for part in blocks(batches):
            sets = list(shingle_sets(part.column(1), k))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_key(s) for s in sets], pa.int64()),
                    part.column(2),
                    pa.array([s[: np.searchsorted(s, U64(REGION))].view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "node", "key", "region"],
            )

    return run


def _in_order(s: np.ndarray, hot: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set with the hot grams last, the least frequent of them first, and a
    number for each gram that never falls along the order (31 bits)."""
    place = (s >> U64(34)).astype(np.int64)
    if not len(hot) or not len(s):
        return s, place
    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
    is_hot = hot[at] == s
    tail = np.flatnonzero(is_hot)[np.argsort(rank[at[is_hot]], kind="stable")]
    order = np.concatenate([np.flatnonzero(~is_hot), tail])
    place[is_hot] = (1 << 30) + rank[at[is_hot]]
    return s[order], place[order]


def _map_leaving(percent, hot_bc):
    """Keys of the texts whose prefix leaves the region, from their sets' part in it."""

    def run(batches):
        hot, _ = hot_bc.value
        for batch in batches:
            key, n = batch.column(0), batch.column(1).to_numpy()
            sizes = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
            flat = batch.column(2).flatten().to_numpy().view(np.uint64)
            cold = np.ones(len(flat), np.int64)
            if len(hot):
                cold -= hot[np.minimum(np.searchsorted(hot, flat), len(hot) - 1)] == flat
            within = np.bincount(np.repeat(np.arange(len(n)), sizes), cold, len(n))
            leaves = (n > 0) & (within < n - (n * percent + 99) // 100 + 1)
            yield pa.RecordBatch.from_arrays([key.filter(pa.array(leaves))], ["key"])

    return run


def _wanted(batches, wanted_bc):
    """The blocks (text, key) with only the rows whose key may be wanted."""
    wanted = wanted_bc.value
    for batch in batches:
        take = bitmap.probe(wanted, batch.column(1).to_numpy())
        yield from blocks([batch.filter(pa.array(take))])


def _map_outside(k, wanted_bc):
    """All grams outside the region of the wanted texts."""

    def run(batches):
        for part in _wanted(batches, wanted_bc):
            found = [s[np.searchsorted(s, U64(REGION)) :] for s in shingle_sets(part.column(0), k)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["gram"])

    return run


def _map_entries(k, percent, hot_bc):
    def run(batches):
        hot, rank = hot_bc.value
        for part in blocks(batches):
            gram, node, where, last = [], [], [], []
            for s in shingle_sets(part.column(1), k):
                n = len(s)
                if n:
                    p = _prefix(n, percent)
                    ordered, place = _in_order(s, hot, rank)
                    gram.append(ordered[:p])
                    node.append(np.full(p, class_key(s), np.int64))
                    where.append((n << 32) + np.arange(p, dtype=np.int64))
                    last.append(np.full(p, place[p - 1], np.int32))
            if gram:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(gram).view(np.int64)),
                        pa.array(np.concatenate(node)),
                        pa.array(np.concatenate(where)),
                        pa.array(np.concatenate(last)),
                    ],
                    ["gram", "node", "where", "last"],
                )

    return run


def _map_rows(k, wanted_bc):
    """(node, sorted set) of the wanted texts."""

    def run(batches):
        for part in _wanted(batches, wanted_bc):
            sets = list(shingle_sets(part.column(0), k))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([class_key(s) for s in sets], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["node", "grams"],
            )

    return run


def _enough(nx, ny, percent: int):
    return -(-(nx + ny) * percent // (100 + percent))


def overlap_reaches(x: np.ndarray, y: np.ndarray, percent: int, column_blocks: int = 8) -> int:
    """The overlap of two sorted sets, accumulated over blocks of the columns;
    -1 as soon as the columns left can't reach the bound."""
    need = _enough(len(x), len(y), percent)
    edges = np.array([(i << 64) // column_blocks for i in range(1, column_blocks)], U64)
    bx = [0, *np.searchsorted(x, edges), len(x)]
    by = [0, *np.searchsorted(y, edges), len(y)]
    found = 0
    for i in range(column_blocks):
        a, b = x[bx[i] : bx[i + 1]], y[by[i] : by[i + 1]]
        if len(a) and len(b):
            at = np.searchsorted(b, a)
            found += int((b[np.minimum(at, len(b) - 1)] == a).sum())
        if found + min(len(x) - bx[i + 1], len(y) - by[i + 1]) < need:
            return -1
    return found


def _map_verify(percent):
    def run(batches):
        for batch in batches:
            u, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            gx, gy = batch.column(2), batch.column(3)
            keep = [
                i
                for i in range(batch.num_rows)
                if overlap_reaches(
                    gx[i].values.to_numpy().view(np.uint64), gy[i].values.to_numpy().view(np.uint64), percent
                )
                >= 0
            ]
            yield pa.RecordBatch.from_arrays([pa.array(u[keep]), pa.array(v[keep])], ["u", "v"])

    return run


def _can_link(a: str, b: str, percent: int) -> str:
    need = f"int(ceil(({a}.n + {b}.n) * {percent}L / {100 + percent}.0D - 1e-9))"
    return (
        f"least({a}.n, {b}.n) * 100L >= greatest({a}.n, {b}.n) * {percent}L"
        f" AND 1 + least({a}.n - 1 - {a}.pos, {b}.n - 1 - {b}.pos) >= {need}"
    )


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct()


def link_classes(
    docs: DataFrame,
    k: int = 5,
    percent: int = 80,
    hot_count: int = 128,
    hot_limit: int = 200_000,
    small: int = 32,
    pivots: int = 4,
) -> tuple[DataFrame, DataFrame]:
    """(sets: one row per document with its set size and class ``node``;
    links: pairs ``u, v`` of classes whose Jaccard similarity is at least
    ``percent`` / 100, enough of them to connect all that are connected)."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("key")
    )
    kinds = "doc_id long, n_shingles long, node long, key long, region array<long>"
    sets = _written(docs.mapInArrow(_map_sets(k), kinds), "jaccard-sets")

    counts = sets.select(F.explode("region").alias("gram")).groupBy("gram").agg(F.count("*").alias("c"))
    shared = _written(counts.where("c > 1"), "jaccard-counts")

    def hottest(counts):
        top = counts.where(F.col("c") >= hot_count).orderBy(F.desc("c"), "gram").limit(hot_limit)
        return [(r["c"], r["gram"]) for r in top.collect()]

    def ranked(found):
        """(sorted hot grams, rank of each: the most frequent last), for all tasks."""
        found = sorted(found)
        grams = np.array([g for _, g in found], np.int64).view(np.uint64)
        at = np.argsort(grams)
        return spark.sparkContext.broadcast((grams[at], at))

    def marked(keys):
        return spark.sparkContext.broadcast(bitmap.build(keys, "key"))

    # Where many hot grams push a prefix out of the region, the grams there are
    # counted too.
    hot = hottest(shared)
    leaving = sets.select("key", "n_shingles", "region").mapInArrow(_map_leaving(percent, ranked(hot)), "key long")
    texts = docs.select("text", "key")
    beyond = texts.mapInArrow(_map_outside(k, marked(leaving)), "gram long")
    hot_bc = ranked(hot + hottest(beyond.groupBy("gram").agg(F.count("*").alias("c"))))

    # An entry's size and position share a long; ``last`` places its prefix's end.
    entries = docs.drop("key").mapInArrow(_map_entries(k, percent, hot_bc), "gram long, node long, where long, last int")
    inside_region = F.expr(f"gram >= 0 AND gram < {REGION}L")
    known = entries.where(inside_region).join(shared.select("gram"), "gram", "left_semi")
    columns = known.union(entries.where(~inside_region)).distinct()
    columns = columns.select(
        "gram", "node", F.expr("cast(shiftright(where, 32) as int) AS n"), F.expr("cast(where & 4294967295 as int) AS pos"), "last"
    )
    columns = _written(columns, "jaccard-columns")
    # Written first: a join of plain tables splits a hot column over tasks.
    widths = _written(columns.groupBy("gram").agg(F.count("*").alias("width")).where("width > 1"), "jaccard-widths")
    product = _written(columns.join(widths, "gram"), "jaccard-product")
    thin, wide = product.where(F.col("width") <= small), product.where(F.col("width") > small)

    test = F.expr(_can_link("x", "y", percent))
    pairs = (
        thin.alias("x")
        .join(thin.alias("y"), F.expr("x.gram = y.gram AND x.node < y.node") & test)
        .select(F.col("x.node").alias("x"), F.col("y.node").alias("y"))
    )
    has_wide = bool(wide.take(1))
    if has_wide:
        pairs = pairs.union(_stars(wide, product, pivots, percent, test))
    pairs = _written(_pairs(pairs), "jaccard-pairs")

    def verified(pairs):
        """Links among the pairs: prefix overlaps first, whole sets for the rest."""
        open_pairs = _written(_bounded(pairs, product, percent), "jaccard-open")
        members = open_pairs.select(F.col("u").alias("node")).union(open_pairs.select(F.col("v").alias("node")))
        members = members.distinct()
        one_each = sets.groupBy("node").agg(F.min("key").alias("key")).join(members, "node")
        rows = texts.mapInArrow(_map_rows(k, marked(one_each)), "node long, grams array<long>")
        rows = rows.join(members, "node", "left_semi")
        rows = _written(rows.groupBy("node").agg(F.first("grams").alias("grams")), "jaccard-rows")
        both = open_pairs.join(rows.select(F.col("node").alias("u"), F.col("grams").alias("gu")), "u").join(
            rows.select(F.col("node").alias("v"), F.col("grams").alias("gv")), "v"
        )
        links = both.select("u", "v", "gu", "gv").mapInArrow(_map_verify(percent), "u long, v long")
        return _written(links, "jaccard-links")

    links = verified(pairs)
    if has_wide:
        across = _pairs(_across(wide, links, percent, test)).join(pairs, ["u", "v"], "left_anti")
        across = _written(across, "jaccard-across")
        if across.take(1):
            links = links.union(verified(across))
    return sets.drop("region"), links


def _stars(wide: DataFrame, product: DataFrame, pivots: int, percent: int, test) -> DataFrame:
    """Pairs of up to ``pivots`` classes of every wide column with all others of
    the column.  Pivots are those whose prefix columns are widest on average: the
    text that near copies were made from has no column of its own."""
    shared = product.groupBy("node").agg((F.sum("width") / F.expr(f"max(n) - {_REST.format('max(n)', percent)}")).alias("shared"))
    ranked = F.struct(F.col("shared"), F.xxhash64("node").alias("r"), F.col("node"), F.col("n"), F.col("pos"))
    chosen = _written(
        wide.join(shared, "node")
        .groupBy("gram", F.pmod(F.xxhash64("node"), F.lit(pivots)).alias("turn"))
        .agg(F.max(ranked).alias("p"))
        .select("gram", "p.node", "p.n", "p.pos"),
        "jaccard-pivots",
    )
    return (
        wide.alias("y")
        .join(chosen.alias("x"), F.expr("x.gram = y.gram AND x.node <> y.node") & test)
        .select(F.col("x.node").alias("x"), F.col("y.node").alias("y"))
    )


def _across(wide: DataFrame, links: DataFrame, percent: int, test) -> DataFrame:
    """Pairs of classes that share a wide column but are not connected yet: all
    classes outside the column's largest component with those of the column whose
    sizes are near.  Sizes go by powers of 100 / percent: linked ones are in the
    same step or in neighbouring ones."""
    roots = components(links).select("node", "root")
    known = wide.join(roots, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
    step = F.floor(F.log("n") / math.log(100 / percent)) if percent < 100 else F.col("n")
    known = _written(known.withColumn("step", step.cast("long")), "jaccard-labelled")
    sizes = known.groupBy("gram", "label").agg(F.count("*").alias("c"))
    main = sizes.groupBy("gram").agg(F.max(F.struct("c", "label")).alias("m"), F.count("*").alias("labels"))
    main = main.where("labels > 1").select("gram", F.col("m.label").alias("main"))
    rest = known.join(main, "gram").where("label <> main")
    near = F.explode(F.array(*[F.col("step") + F.lit(d) for d in (-1, 0, 1)]))
    rest = _written(rest.select("gram", "label", "node", "n", "pos", near.alias("step")), "jaccard-rest")
    return (
        rest.alias("x")
        .join(known.alias("y"), F.expr("x.gram = y.gram AND x.step = y.step AND x.label <> y.label") & test)
        .select(F.col("x.node").alias("x"), F.col("y.node").alias("y"))
    )


def _bounded(pairs: DataFrame, product: DataFrame, percent: int) -> DataFrame:
    """The pairs whose overlap can still reach the bound: what their prefixes
    share, plus what follows the last shared column in the shorter rest; and all
    they share up to the earlier prefix end is known, so no more than that
    class's rest can follow."""
    e = product.select("gram", "node", "n", "pos", "last")
    shared = pairs.join(e.alias("a"), F.expr("u = a.node")).join(
        e.alias("b"), F.expr("v = b.node AND a.gram = b.gram")
    )
    shared = shared.groupBy("u", "v").agg(
        F.count("*").alias("c"),
        F.max("a.n").alias("nu"),
        F.max("b.n").alias("nv"),
        F.max("a.pos").alias("pu"),
        F.max("b.pos").alias("pv"),
        F.max("a.last").alias("lu"),
        F.max("b.last").alias("lv"),
    )
    ru, rv = _REST.format("nu", percent), _REST.format("nv", percent)
    rest = f"CASE WHEN lu < lv THEN {ru} WHEN lv < lu THEN {rv} ELSE greatest({ru}, {rv}) END"
    need = f"ceil((nu + nv) * {percent}L / {100 + percent}.0D - 1e-9)"
    return shared.where(f"c + least(nu - 1 - pu, nv - 1 - pv, {rest}) >= {need}").select("u", "v")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest
    doc_id reachable by links, itself included), class_id (the smallest doc_id
    with the same set); also key (of doc_id and text) and root (a name of the
    component that is never null, but for empty sets).  Links are not counted:
    inside wide columns link_classes lists only those that connect."""
    sets, links = link_classes(docs, **options)
    roots = components(links)
    classes = (
        sets.where("n_shingles > 0")
        .groupBy("node")
        .agg(F.min("doc_id").alias("class_id"))
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    classes = _written(classes, "jaccard-classes")
    named = classes.join(classes.groupBy("root").agg(F.min("class_id").alias("component_id")), "root")
    return sets.join(named, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        "key",
        "root",
    )


def representatives(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when one document of each
    component does: the one with the smallest doc_id (of equal ids, by a hash of
    the text; an identical row once).  Rows with an empty set all stay."""
    spark = docs.sparkSession
    found = _written(near_duplicates(docs, **options), "jaccard-found")
    filled = found.where(F.col("root").isNotNull())
    best = filled.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("b"))
    copies = filled.groupBy("key").agg(F.count("*").alias("copies"))
    stays = best.select(F.col("b.key").alias("key")).join(copies, "key")
    stays = stays.union(found.where(F.col("root").isNull()).select("key", F.lit(1).cast("long")).distinct())
    stays = _written(stays, "jaccard-stays")
    # Most rows stay for sure, as their key isn't among those to look at; only
    # the others meet the table of keys, so most texts are not shuffled.
    doubtful = found.join(stays.where("copies = 1"), "key", "left_anti").select("key")
    marks = spark.sparkContext.broadcast(bitmap.build(doubtful, "key"))
    rows = docs.select(F.struct("*").alias("_row"), row_key().alias("_key"))
    sure = rows.mapInArrow(_map_marked(marks, False), rows.schema).select("_row.*")
    open_rows = rows.mapInArrow(_map_marked(marks, True), rows.schema)
    open_rows = open_rows.join(stays.withColumnRenamed("key", "_key"), "_key")
    once = open_rows.where("copies > 1").groupBy("_key").agg(F.first("_row").alias("_row")).select("_row.*")
    return sure.union(open_rows.where("copies = 1").select("_row.*")).union(once)


def _map_marked(marks_bc, marked: bool):
    """The rows (row, key) whose key is in the bitmap, or those whose isn't."""

    def run(batches):
        for batch in batches:
            hit = bitmap.probe(marks_bc.value, batch.column(1).to_numpy())
            yield batch.filter(pa.array(hit == marked))

    return run


def query(spark, sf_dir):
    """Near-duplicate components of all documents (5-word shingles, 0.8)."""
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE
           WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)])
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
rare AS (SELECT g.* FROM grams g JOIN (SELECT g FROM grams GROUP BY g HAVING count(*) > 1) USING (g)),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM rare a JOIN rare b ON a.g = b.g AND a.doc_id <> b.doc_id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM sets
  UNION
  SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.root) AS component_id
FROM sets s JOIN reach r ON r.node = s.doc_id GROUP BY s.doc_id, s.s
"""
