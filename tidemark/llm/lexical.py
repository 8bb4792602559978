"""Ranked lexical search: many items at once, with shared term sets scored once.

1. ``postings``: one pass over the texts keeps, for each document, its number of
   terms and the (term, occurrences) of the terms that some item asks for; the
   result is written, so texts are read once per block of items.
2. ``share`` mines what the items have in common.  A term asked for q times is q
   elements.  Elements that stand in exactly the same items form one *set*; then
   neighbours (in order of falling support) that recur together in two items or
   more are paired into a node, round after round, until no pair recurs.  Items
   are sums of nodes, nodes sums of two nodes or sets: a directed acyclic graph.
3. ``best``: for a few hundred documents at a time, the accumulator of every set
   is filled once from the postings, every node is the sum of two finished ones,
   level by level, and an item's score is the sum over its nodes.  A task keeps
   the best ``top`` documents of each item; a window over these ranks them.

Items come in blocks of at most ``block_bytes`` of text (one longer item is a
block of its own), so what is broadcast doesn't grow with the items; every block
is scored against all documents.

Results for odd input: a null or empty text has no terms, is never found and
counts in no statistic; a null or empty item, and one that only asks for terms
that no document has, gets no rows.  Identical item rows count once; items that
share an id but not the text are ranked apart.  Repeated documents are found each;
equal scores go by ascending doc_id, a null doc_id last.  A very long text is
tokenised by itself, its postings are bounded by the block's terms.  Without
documents there are no rows.  Other columns are not read, so their names don't
matter.  Terms are compared as bytes, not by hash.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import _written
from tidemark.llm.ranking import first_rows
from tidemark.llm.textblocks import WORD_LOWER, Block, blocks, owners
from tidemark.sources.tables import read_table

BLOCK_BYTES = 1 << 20
CELLS = 1 << 22  # accumulators (nodes x documents) held at a time


def _terms(block: Block) -> tuple[pa.Array, np.ndarray]:
    """(all terms of the block's texts in order, as binary; term pointers of the texts)."""
    starts, ends, ptr = block.words(WORD_LOWER)
    letters = block.data[WORD_LOWER[block.data]]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers), ptr


def terms_of(text: str | None) -> list[bytes]:
    """The terms of one text, in order."""
    return _terms(Block(pa.array([text], pa.string()), lower=True))[0].to_pylist()


class Plan:
    """What one block of items asks for: ``vocabulary``; the sets' elements
    (``set_term``, ``set_of``); inner nodes (``left``, ``right``) by ``level``;
    ``item_nodes`` of each item with pointers."""

    def __init__(self, asked: list[Counter]):
        self.vocabulary = sorted({t for terms in asked for t in terms})
        place = {t: i for i, t in enumerate(self.vocabulary)}
        holders: dict[tuple, list[int]] = {}
        for i, terms in enumerate(asked):
            for term, times in terms.items():
                for turn in range(times):
                    holders.setdefault((place[term], turn), []).append(i)
        sets: dict[tuple, list[int]] = {}
        for (term, _), items in sorted(holders.items()):
            sets.setdefault(tuple(items), []).append(term)
        self.set_of = np.repeat(np.arange(len(sets)), [len(x) for x in sets.values()])
        self.set_term = np.array([t for terms in sets.values() for t in terms], np.int64)
        self.n_sets = len(sets)
        members = list(sets)
        lists: list[list[int]] = [[] for _ in asked]
        for s in sorted(range(len(members)), key=lambda s: (-len(members[s]), s)):
            for i in members[s]:
                lists[i].append(s)
        self._pair(lists)
        self.item_ptr = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        self.item_nodes = np.array([n for x in lists for n in x], np.int64)

    def _pair(self, lists: list[list[int]]) -> None:
        """Replace recurring neighbours by nodes, the most frequent pairs first."""
        level = [0] * self.n_sets
        left, right = [], []
        while True:
            found = Counter(p for x in lists for p in set(zip(x, x[1:], strict=False)))
            names: dict[tuple, int] = {}
            rank = {p: (-c, p) for p, c in found.items() if c > 1}
            if not rank:
                break
            used = Counter()
            for x in lists:  # each neighbour goes to the better of the two pairs it may join
                for i, p in enumerate(zip(x, x[1:], strict=False)):
                    near = [q for q in ((x[i - 1], x[i]) if i else None, (x[i + 1], x[i + 2]) if i + 2 < len(x) else None) if q in rank]
                    if p in rank and all(rank[p] <= rank[q] for q in near):
                        used[p] += 1
            for p in sorted((p for p, c in used.items() if c > 1), key=rank.get):
                names[p] = self.n_sets + len(left)
                left.append(p[0])
                right.append(p[1])
                level.append(1 + max(level[p[0]], level[p[1]]))
            if not names:
                break
            for k, x in enumerate(lists):
                out, i = [], 0
                while i < len(x):
                    node = names.get((x[i], x[i + 1])) if i + 1 < len(x) else None
                    out.append(x[i] if node is None else node)
                    i += 1 if node is None else 2
                lists[k] = out
        self.left, self.right = np.array(left, np.int64), np.array(right, np.int64)
        self.level = np.array(level[self.n_sets :], np.int64)
        self.n_nodes = self.n_sets + len(left)

    def scores(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
        """Items x documents: the sum of the values of the items' elements."""
        sums = np.zeros((self.n_nodes, n_docs), np.int64)
        order = np.argsort(self.set_term, kind="stable")
        first = np.searchsorted(self.set_term[order], np.arange(len(self.vocabulary) + 1))
        count = np.diff(first)[term]
        at = np.repeat(np.arange(len(term)), count)
        step = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        of = self.set_of[order[first[term[at]] + step]]
        np.add.at(sums.reshape(-1), of * n_docs + doc[at], value[at])
        for depth in range(1, int(self.level.max(initial=0)) + 1):
            here = np.flatnonzero(self.level == depth)
            sums[self.n_sets + here] = sums[self.left[here]] + sums[self.right[here]]
        out = np.zeros((len(self.item_ptr) - 1, n_docs), np.int64)
        filled = np.flatnonzero(np.diff(self.item_ptr))
        if len(filled):
            out[filled] = np.add.reduceat(sums[self.item_nodes], self.item_ptr[filled], axis=0)
        return out


def _map_postings(plan_bc):
    def run(batches):
        wanted = pa.array(plan_bc.value.vocabulary, pa.large_binary())
        size = max(len(wanted), 1)
        for part in blocks(batches):
            terms, ptr = _terms(Block(part.column(1), lower=True))
            at = pc.index_in(terms, value_set=wanted)
            hit = at.is_valid().to_numpy(zero_copy_only=False)
            term = at.filter(pa.array(hit)).to_numpy().astype(np.int64)
            pair, tf = np.unique(owners(ptr)[hit] * size + term, return_counts=True)
            cut = pa.array(np.searchsorted(pair, np.arange(part.num_rows + 1) * size), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).cast(pa.int64()),
                    pa.array(np.diff(ptr), pa.int64()),
                    pa.ListArray.from_arrays(cut, pa.array(pair % size, pa.int32())),
                    pa.ListArray.from_arrays(cut, pa.array(tf, pa.int64())),
                ],
                ["doc_id", "n", "term", "tf"],
            )

    return run


def contributions(weight, tf, n, n_docs: int, total: int) -> np.ndarray:
    """w * ((10^9 tf) div (1000 tf + 8 m)) in 64-bit integers, with
    m = 25 + (75 n N) div L."""
    m = 25 + (75 * n * n_docs) // total
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Best:
    """The best documents of each item so far: higher scores first, then smaller
    ids, null ids last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.item = self.score = self.doc = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)
        self.least = np.ones(items, np.int64)  # a score below can't enter

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        least = self.least
        if scores.shape[1] > self.top:
            least = np.maximum(least, np.partition(scores, -self.top, axis=1)[:, -self.top])
        item, col = np.nonzero(scores >= least[:, None])
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[item, col]])
        doc, null = np.concatenate([self.doc, doc[col]]), np.concatenate([self.null, null[col]])
        order = np.lexsort((doc, null, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        keep = order[place < self.top]
        self.item, self.score, self.doc, self.null = item[keep], score[keep], doc[keep], null[keep]
        last = order[place == self.top - 1]
        self.least[item[last]] = score[last]


def _map_best(plan_bc, weight: np.ndarray, n_docs: int, total: int, top: int):
    def run(batches):
        plan = plan_bc.value
        best = Best(len(plan.item_ptr) - 1, top)
        step = max(16, min(1024, CELLS // max(plan.n_nodes, 1)))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                size = pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(part.num_rows), size)
                term = part.column(2).flatten().to_numpy().astype(np.int64)
                tf, n = part.column(3).flatten().to_numpy(), part.column(1).to_numpy()
                value = contributions(weight[term], tf, n[doc], n_docs, total)
                ids = part.column(0)
                null = ids.is_null().to_numpy(zero_copy_only=False)
                best.add(plan.scores(doc, term, value, part.num_rows), pc.fill_null(ids, 0).to_numpy(), null)
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item, pa.int32()), pa.array(best.score), pa.array(best.doc, mask=best.null)], ["item", "score", "doc_id"]
        )

    return run


def _item_blocks(items: DataFrame, block_bytes: int):
    """Lists of (item_id, text), each of at most ``block_bytes`` of text or one item."""
    block, held = [], 0
    for row in items.where("text <> ''").distinct().toLocalIterator():
        size = len(row["text"].encode())
        if block and held + size > block_bytes:
            yield block
            block, held = [], 0
        block.append((row["item_id"], row["text"]))
        held += size
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, top: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select("item_id", F.col("text").cast("string").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    results = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in _item_blocks(items, block_bytes):
        plan = Plan([Counter(terms_of(text)) for _, text in block])
        plan_bc = spark.sparkContext.broadcast(plan)
        shape = "doc_id long, n long, term array<int>, tf array<long>"
        held = _written(texts.mapInArrow(_map_postings(plan_bc), shape), "lexical-postings")
        n_docs, total = held.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        if not n_docs:
            break
        df = held.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        weight = np.zeros(max(len(plan.vocabulary), 1), np.int64)
        for row in df.collect():  # at most the block's terms
            weight[row["term"]] = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * row["df"] + 1)))
        found = held.mapInArrow(_map_best(plan_bc, weight, n_docs, total, top), "item int, score long, doc_id long")
        names = spark.createDataFrame([(i, x[0]) for i, x in enumerate(block)], f"item int, item_id {kind}")
        ranked = first_rows(found, ["item"], order, top, F.spark_partition_id()).join(F.broadcast(names), "item")
        results = results.unionAll(ranked.select("item_id", "rank", "doc_id", "score"))
    return results


def query(spark, sf_dir):
    """The ten best documents for each benchmark item."""
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
stat AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS total FROM docs),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY r, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), stat),
items AS (
  SELECT item_id, text, t, count(*) AS q
  FROM (SELECT item_id, text, unnest({_WORDS}) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY item_id, text, t),
scored AS (
  SELECT i.item_id, i.text, f.r,
         sum(q * g.w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(d.w) * n_docs) // total)))) AS score
  FROM items i JOIN tf f ON f.t = i.t JOIN weights g ON g.t = i.t JOIN docs d ON d.r = f.r CROSS JOIN stat
  GROUP BY i.item_id, i.text, f.r),
ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id, s.text ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored s JOIN docs USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10
"""
