"""Benchmark decontamination by spaced-seed hashing.

A fixed mask over a window of tokens keeps some positions and ignores the
others, so a window still matches when an ignored token was substituted.  Every
window of every document and every benchmark item is hashed under each mask;
Spark joins the two, and around each hit the document is compared with the item
token by token along the hit's diagonal.

A document is contaminated by an item when any segment of the diagonal has at
least ``min_match`` matching tokens (for shorter items: ``percent`` of the item)
that make up ``percent`` of the segment.  Of those segments the one with the
highest score (+1 a match, -2 a substitution) is the overlap.

Documents' hashes pass a fixed-size bitmap of the benchmark's before the join,
and hits of one document that lie near each other travel as one region with the
token hashes around them, so texts are never shuffled and nothing grows with
the benchmark but the join itself.  The seeds of items of about one length (within
a factor of four) have a bitmap of their own, and a hit brings as many tokens as
the longest items among those that may hold it; one long item does not widen the
regions of others.  The joins by seed, region and item are plain equi-joins of
written tables, whose hot keys are split at run time.

Tokens are runs of digits, letters (lower-cased) and other non-ASCII characters.
Items of up to 14 tokens have masks of their own, enough for every set of missing
tokens that the bound allows, so none of their overlaps is lost (items of up to 4
tokens are sought exactly at 80 %: a benchmark with the item "yes" contaminates
every document that holds the word; ``clean`` leaves items under ``min_item``
tokens out).  For longer items the masks are a heuristic: of the sets of missing
tokens that the bound allows in a segment whose ends match, this share has a seed:

    tokens in the segment   12     13     14     15     16     17     18     19
    share found             0.929  0.985  1.000  0.976  0.994  0.998  1.000  1.000

Documents are hashed under short masks only where the benchmark has such lengths.

Null or empty texts have no tokens; an empty table gives no rows.  Repeated rows
count once; an item id with two texts has the better overlap of each.  Ties: of
equally scored segments the one that ends first, then the shorter; of diagonals the
one with most matches, then the shorter segment, then the earlier.  A very long text
is a block of its own; what leaves the task is only what lies around hits.  Other
columns than doc_id and text, item_id and text are not read (``clean`` hands all on).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bitmap
from tidemark.llm.components import _written
from tidemark.llm.textblocks import SLOT, U64, WORD_LOWER, Block, blocks, inside, mix, owners, rolling, small_batches
from tidemark.sources.tables import read_table

# Fixed masks: weight 6 over 8, 10 and 12 tokens.
MASKS = ("11101101", "1100101011", "101100010011")
SHORT_ITEM = 14


def needed(n: int, min_match: int, percent: int) -> int:
    """Matching tokens that an overlap with an item of n tokens must have."""
    return max(1, min(min_match, -(-n * percent // 100)))


def short_masks(n: int, min_match: int, percent: int) -> list[tuple[int, tuple[int, ...]]]:
    """(first position, kept positions from there) of masks over an item of n
    tokens: whichever n - needed tokens are missing, some mask keeps none of them.
    The tokens are cut into groups, and each mask leaves out as many groups as
    tokens may be missing."""
    missing = n - needed(n, min_match, percent)
    parts = n if missing <= 1 else min(n, missing + 3)
    cuts = [n * i // parts for i in range(parts + 1)]
    out = []
    for kept in combinations(range(parts), parts - missing):
        at = [j for g in kept for j in range(cuts[g], cuts[g + 1])]
        out.append((at[0], tuple(j - at[0] for j in at)))
    return out


def all_masks(short_lengths=(), min_match: int = 10, percent: int = 80):
    """(masks, uses): the kept positions of each mask, and for each short item
    length the (mask number, position in the item) of its seeds."""
    numbers = {tuple(i for i, c in enumerate(m) if c == "1"): k for k, m in enumerate(MASKS)}
    uses = {}
    for n in sorted(short_lengths):
        uses[n] = [(numbers.setdefault(m, len(numbers)), at) for at, m in short_masks(n, min_match, percent)]
    return [list(m) for m in numbers], uses


def _tokens(column):
    block = Block(pc.utf8_lower(column))
    starts, ends, ptr = block.words(WORD_LOWER)
    return block.hashes(starts, ends), ptr


def _seeds(h, ptr, mask, number):
    """(hash, window position) of all windows under a mask."""
    span = mask[-1] + 1
    ok = np.flatnonzero(inside(ptr, span))
    if not len(ok):
        return np.zeros(0, U64), ok
    return mix(rolling(h, span, mask)[ok] ^ SLOT[32 + number % 16]), ok


def _item_seeds(h, masks, uses):
    """(hashes, positions) of one item's seeds."""
    ptr = np.array([0, len(h)])
    found = [(np.zeros(0, U64), np.zeros(0, np.int64))]
    if len(h) > SHORT_ITEM:
        found += [_seeds(h, ptr, mask, number) for number, mask in enumerate(masks[: len(MASKS)])]
    for number, start in uses.get(len(h), ()):
        key, at = _seeds(h, ptr, masks[number], number)
        found.append((key[at == start], at[at == start]))
    return np.concatenate([k for k, _ in found]), np.concatenate([p for _, p in found])


def _map_items(masks, uses):
    """A row per item: its token hashes and its seeds."""

    def run(batches):
        for part in blocks(batches):
            h, ptr = _tokens(part.column(1))
            items = [h[a:b] for a, b in zip(ptr, ptr[1:])]
            seeds = [_item_seeds(item, masks, uses) for item in items]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).cast(pa.int64()),
                    pa.array([item.view(np.int64) for item in items], pa.list_(pa.int64())),
                    pa.array([k.view(np.int64) for k, _ in seeds], pa.list_(pa.int64())),
                    pa.array([p.astype(np.int32) for _, p in seeds], pa.list_(pa.int32())),
                ],
                ["item_id", "item", "seed", "at"],
            )

    return run


REACHES = [16 << 2 * i for i in range(13)]  # longest item of each class of lengths


def _map_regions(masks, known_bc):
    """A row per run of hits whose surroundings meet."""

    def run(batches):
        classes = known_bc.value
        known = np.bitwise_or.reduce([words for _, words in classes])
        for part in blocks(batches):
            h, ptr = _tokens(part.column(2))
            keys, places = [], []
            for number, mask in enumerate(masks):
                key, at = _seeds(h, ptr, mask, number)
                hit = bitmap.probe(known, key)
                keys.append(key[hit])
                places.append(at[hit])
            key, at = np.concatenate(keys), np.concatenate(places)
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            key, at = key[order], at[order]
            owner = owners(ptr)[at]
            reach = np.zeros(len(at), np.int64)
            for size, words in classes:
                reach = np.where(bitmap.probe(words, key), np.maximum(reach, size), reach)
            lo, hi = np.maximum(at - reach, ptr[owner]), np.minimum(at + reach, ptr[owner + 1])
            new = np.ones(len(at), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (lo[1:] > np.maximum.accumulate(hi)[:-1])
            begin = np.flatnonzero(new)
            finish = np.append(begin[1:], len(at))
            ids, rows = part.column(0).cast(pa.int64()).to_pylist(), part.column(1).to_pylist()
            out: dict[str, list] = {k: [] for k in ("key", "doc_id", "first", "words", "seed", "at")}
            for a, b, first, end in zip(begin, finish, np.minimum.reduceat(lo, begin), np.maximum.reduceat(hi, begin)):
                i = owner[a]
                out["key"].append(rows[i])
                out["doc_id"].append(ids[i])
                out["first"].append(int(first - ptr[i]))
                out["words"].append(h[first:end].view(np.int64))
                out["seed"].append(key[a:b].view(np.int64))
                out["at"].append((at[a:b] - ptr[i]).astype(np.int32))
            longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
            kinds = (pa.int64(), pa.int64(), pa.int32(), longs, longs, ints)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))

    return run


def best_segment(equal: np.ndarray) -> tuple[int, int, int]:
    """(begin, end, matches) of the segment with the highest score; of equals the
    one that ends first, then the shortest."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -2))])
    least = np.minimum.accumulate(total[:-1])
    end = int(np.argmax(total[1:] - least)) + 1
    begin = int(np.flatnonzero(total[:end] == least[end - 1])[-1])
    return begin, end, int(equal[begin:end].sum())


def overlap(equal: np.ndarray, need: int, percent: int) -> tuple[int, int, int] | None:
    """(begin, end, matches) of the segment with the highest score among all that
    have ``need`` matches and are ``percent`` matches; ties as in best_segment."""
    begin, end, matched = best_segment(equal)
    if matched >= need and 100 * matched >= percent * (end - begin):
        return begin, end, matched
    count = np.concatenate([[0], np.cumsum(equal)])
    above = np.concatenate([[0], np.cumsum(np.where(equal, 100 - percent, -percent))])
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -2))]).tolist()
    first = np.searchsorted(count, count[:-1] + need).tolist()  # the first end with enough matches
    # Begins from the right; the ends so far are kept in a tree of greatest scores
    # over the ranks of ``above``, the greatest first.
    rank = (len(count) - np.searchsorted(np.sort(above), above)).tolist()
    tree: list = [None] * (len(count) + 1)
    best, e = None, len(count)
    for b in range(len(equal) - 1, -1, -1):
        while e > first[b]:
            e -= 1
            at, entry = rank[e], (score[e], -e)
            while at <= len(count):
                tree[at] = entry if tree[at] is None else max(tree[at], entry)
                at += at & -at
        at, found = rank[b], None
        while at:  # ends that lie at least as high as the begin
            found = tree[at] if found is None else max(found, tree[at] or found)
            at -= at & -at
        if found:
            best = max(best or (), (found[0] - score[b], found[1], b))
    return best and (best[2], -best[1], int(count[-best[1]] - count[best[2]]))


def _map_verify(min_match, percent):
    def run(batches):
        for batch in batches:
            key, doc_id, item_id = (batch.column(i).to_pylist() for i in range(3))
            shift, first = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            found = []
            for i in range(batch.num_rows):
                words, item = batch.column(5)[i].values.to_numpy(), batch.column(6)[i].values.to_numpy()
                move = shift[i] - first[i]  # item position j stands at words[j + move]
                lo, hi = max(0, -move), min(len(item), len(words) - move)
                need = needed(len(item), min_match, percent)
                best = overlap(item[lo:hi] == words[lo + move : hi + move], need, percent)
                if best:
                    begin, end, matched = best
                    start = lo + begin + shift[i]
                    found.append((key[i], doc_id[i], item_id[i], start, end - begin, matched, matched / len(item)))
            names = ["key", "doc_id", "item_id", "doc_start", "n_tokens", "n_matched", "coverage"]
            kinds = [pa.int64()] * 6 + [pa.float64()]
            columns = list(zip(*found)) if found else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return run


def row_key():
    """A key of (doc_id, text): told apart where ids repeat or are null."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def matches(docs: DataFrame, benchmark: DataFrame, min_match: int = 10, percent: int = 80, min_item: int = 1) -> DataFrame:
    """key, doc_id, item_id, doc_start (token), n_tokens, n_matched, coverage of
    the item: the best overlap of each contaminated (document, item).  Items under
    ``min_item`` tokens are not sought."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    lengths = texts.mapInArrow(_map_items([], {}), "item_id long, item array<long>, seed array<long>, at array<int>")
    sizes = lengths.select(F.size("item").alias("n")).where(F.col("n") >= max(min_item, 1))
    short = [r[0] for r in sizes.where(F.col("n") <= SHORT_ITEM).distinct().collect()]
    masks, uses = all_masks(short, min_match, percent)
    # Of these only whole items are matches: of their hits in a region the first is the best.
    exact = [n for n in short if needed(n, min_match, percent) == n]

    items = texts.mapInArrow(_map_items(masks, uses), "item_id long, item array<long>, seed array<long>, at array<int>")
    items = _written(items.where(F.size("item") >= max(min_item, 1)), "decontaminate-items")
    reach = F.coalesce(*[F.when(F.size("item") <= n, n) for n in REACHES])
    seeds = items.select(
        "item_id", F.size("item").isin(exact).alias("exact"), reach.alias("reach"), F.explode(F.arrays_zip("seed", "at")).alias("s")
    )
    seeds = _written(seeds.select(F.col("s.seed").alias("seed"), "item_id", "exact", "reach", F.col("s.at").alias("item_at")), "decontaminate-seeds")
    # At most one bitmap for each class of lengths, each of fixed size.
    classes = sorted(r[0] for r in seeds.select("reach").distinct().collect())
    known = [(n, bitmap.build(seeds.where(F.col("reach") == n), "seed")) for n in classes]
    known_bc = spark.sparkContext.broadcast(known or [(0, bitmap.build(seeds, "seed"))])

    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), F.col("text").cast("string").alias("text")
    )
    regions = keyed.mapInArrow(
        _map_regions(masks, known_bc),
        "key long, doc_id long, first int, words array<long>, seed array<long>, at array<int>",
    )
    regions = _written(regions, "decontaminate-regions").withColumn("region", F.xxhash64("key", "first", "words"))
    hits = regions.select("region", F.explode(F.arrays_zip("seed", "at")).alias("s"))
    diagonals = (
        hits.select("region", F.col("s.seed").alias("seed"), F.col("s.at").alias("doc_at"))
        .join(seeds.drop("reach"), "seed")
        .select("region", "item_id", "exact", (F.col("doc_at") - F.col("item_at")).alias("shift"))
        .groupBy("region", "item_id", F.when(~F.col("exact"), F.col("shift")).alias("apart"))
        .agg(F.min("shift").alias("shift"))
        .select("region", "item_id", "shift")
    )
    pairs = (
        diagonals.join(regions.select("region", "key", "doc_id", "first", "words"), "region")
        .join(items.select("item_id", "item"), "item_id")
        .select("key", "doc_id", "item_id", "shift", "first", "words", "item")
    )
    found = pairs.mapInArrow(
        _map_verify(min_match, percent),
        "key long, doc_id long, item_id long, doc_start long, n_tokens long, n_matched long, coverage double",
    )
    rank = F.struct("n_matched", (-F.col("n_tokens")).alias("a"), (-F.col("doc_start")).alias("b"), "coverage")
    best = found.groupBy("key", "doc_id", "item_id").agg(F.max(rank).alias("m"))
    return best.select(
        "key",
        "doc_id",
        "item_id",
        (-F.col("m.b")).alias("doc_start"),
        (-F.col("m.a")).alias("n_tokens"),
        F.col("m.n_matched").alias("n_matched"),
        F.col("m.coverage").alias("coverage"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, min_item: int = 5, **options) -> DataFrame:
    """The rows of ``docs`` that no benchmark item of at least ``min_item`` tokens
    contaminates, all columns."""
    bad = matches(docs, benchmark, min_item=min_item, **options).select(F.col("key").alias("_key")).distinct()
    bad = _written(bad, "decontaminate-found")
    rows = docs.select(F.struct("*").alias("_row"), row_key().alias("_key"))
    return rows.join(bad, "_key", "left_anti").select("_row.*")


def query(spark, sf_dir):
    """Every (document, item) whose overlap contaminates the document."""
    docs, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return matches(docs, benchmark).drop("key")


SQL = r"""
WITH masks(k, span, kept) AS (VALUES
  (0, 8, [1, 2, 3, 5, 6, 8]), (1, 10, [1, 2, 5, 7, 9, 10]), (2, 12, [1, 3, 4, 8, 11, 12])),
docs AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, t, len(t) AS n_item, greatest(1, least(10, (len(t) * 80 + 99) // 100)) AS need
  FROM (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS t FROM benchmark)),
doc_seeds AS (
  SELECT doc_id, k, p, array_to_string([w[p + i - 1] for i in kept], ' ') AS seed
  FROM (SELECT doc_id, w, k, kept, unnest(range(1, len(w) - span + 2)) AS p FROM docs, masks)),
item_seeds AS (
  SELECT item_id, k, p, array_to_string([t[p + i - 1] for i in kept], ' ') AS seed
  FROM (SELECT item_id, t, k, kept, unnest(range(1, len(t) - span + 2)) AS p FROM items, masks WHERE n_item > 14)),
doc_tokens AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM docs),
item_tokens AS (SELECT item_id, need, unnest(t) AS x, unnest(range(1, len(t) + 1)) AS j FROM items WHERE n_item <= 14),
diagonals AS (
  SELECT DISTINCT doc_id, item_id, d.p - i.p AS shift FROM doc_seeds d JOIN item_seeds i USING (k, seed)
  UNION ALL  -- short items: every place with enough of their tokens
  SELECT doc_id, item_id, p - j FROM doc_tokens JOIN item_tokens USING (x)
  GROUP BY doc_id, item_id, need, p - j HAVING count(*) >= need),
laid AS (
  SELECT doc_id, item_id, shift, n_item, need, j, CASE WHEN t[j] = w[j + shift] THEN 1 ELSE 0 END AS m
  FROM (SELECT doc_id, item_id, shift, n_item, need, t, w,
               unnest(range(greatest(1, 1 - shift), least(len(t), len(w) - shift) + 1)) AS j
        FROM diagonals JOIN docs USING (doc_id) JOIN items USING (item_id))),
summed AS (
  SELECT *, sum(m) OVER d AS c, sum(100 * m - 80) OVER d AS a, sum(3 * m - 2) OVER d AS s
  FROM laid WINDOW d AS (PARTITION BY doc_id, item_id, shift ORDER BY j)),
segments AS (  -- any begin and end that meet the bound
  SELECT b.doc_id, b.item_id, b.shift, b.n_item, b.j AS begin_at, e.j AS end_at, e.c - b.c + b.m AS n_matched
  FROM summed b JOIN summed e ON (e.doc_id, e.item_id, e.shift) = (b.doc_id, b.item_id, b.shift) AND e.j >= b.j
    AND e.c - b.c + b.m >= b.need AND e.a - b.a + 100 * b.m - 80 >= 0
  QUALIFY row_number() OVER (PARTITION BY b.doc_id, b.item_id, b.shift
                             ORDER BY e.s - b.s + 3 * b.m - 2 DESC, e.j, b.j DESC) = 1)
SELECT doc_id, item_id, CAST(begin_at + shift - 1 AS BIGINT) AS doc_start, CAST(end_at - begin_at + 1 AS BIGINT) AS n_tokens,
       CAST(n_matched AS BIGINT) AS n_matched, n_matched / n_item AS coverage
FROM segments
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_matched DESC, n_tokens, doc_start) = 1
"""
