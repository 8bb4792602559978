"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints: bit i of a text's fingerprint is set if it is set in over half of
the XXH64 values of its shingles, repeats included.  Equal fingerprints are one
*class*, so copies are never compared.

Candidates: the 64 bits are cut into ``parts`` pieces.  Two fingerprints that
differ in at most ``radius`` bits agree on at least ``parts - radius`` whole
pieces, so for every choice of that many pieces (a *table*) the classes are
grouped by those bits; each linked pair meets in some group.

Comparison: a task reads its groups in order and stores them as bit planes, one
machine word for 64 fingerprints.  A fingerprint is compared with 64 others at a
time: the planes that the table doesn't fix are XORed with its own bit, and
carry-save adders count the differences in vertical counters (ones, twos, fours,
overflow).  After every eight planes the words whose 64 counts have all passed the
radius are given up; what is left at the end are links.  Links of a group are
reduced to a spanning forest before they leave the task; components of the
forests follow.

A group of more than ``block`` classes is cut into blocks by a hash of the
fingerprint, and every pair of blocks is a group of its own for some task, so no
task holds more than two blocks and no pair is left out.

Results for odd input: a null or empty text, or one without words, has
fingerprint zero and is linked like any other.  With fewer words than a shingle
has, the whole sequence is the only shingle.  Repeated rows give repeated result
rows.  A null doc_id takes part in linking but never names a component; a
component of null ids only has a null name.  A very long text is a block of its
own, hashed and counted 65,536 shingles at a time.  An empty table gives no rows;
other columns are not read.  There are no ties: a count of exactly half leaves the
bit unset.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import _written, components
from tidemark.llm.textblocks import NOT_SPACE, U64, Block, blocks
from tidemark.sources.tables import read_table

SEED = 42
STEP = 1 << 16  # shingles, or words to compare, handled at a time
ALL = U64(0xFFFFFFFFFFFFFFFF)


def _spaced(block: Block):
    """(bytes of all words, each followed by one space; starts and ends of the
    words in it; word pointers of the texts)."""
    starts, ends, ptr = block.words(NOT_SPACE)
    sizes = ends - starts
    to = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes + 1, out=to[1:])
    out = np.full(to[-1], 0x20, np.uint8)
    letters = block.data[NOT_SPACE[block.data]]
    out[np.arange(len(letters)) + np.repeat(np.arange(len(starts)), sizes)] = letters
    return out, to[:-1], to[:-1] + sizes, ptr


def fingerprints(column, k: int = 4) -> np.ndarray:
    """The fingerprint (unsigned) of every text."""
    block = Block(column, lower=True)
    spaced, starts, ends, ptr = _spaced(block)
    view = memoryview(spaced)
    words = np.diff(ptr)
    total = np.maximum(words - k + 1, words > 0).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(total)])
    counts = np.zeros((block.n, 64), np.int64)
    for a in range(0, int(first[-1]), STEP):
        b = min(a + STEP, int(first[-1]))
        at = np.arange(a, b)
        owner = np.searchsorted(first, at, "right") - 1
        begin = ptr[owner] + at - first[owner]
        spans = zip(starts[begin].tolist(), ends[np.minimum(begin + k, ptr[owner + 1]) - 1].tolist(), strict=True)
        h = np.fromiter((xxhash.xxh64_intdigest(view[s:e], SEED) for s, e in spans), U64, b - a)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        there, cut = np.unique(owner, return_index=True)
        counts[there] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > total[:, None], axis=1, bitorder="little").view("<u8").reshape(-1).astype(U64)


def _map_prints(k: int):
    def run(batches):
        for part in blocks(batches):
            found = fingerprints(part.column(1), k).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(found)], ["doc_id", "print"])

    return run


def tables(parts: int, radius: int) -> list[int]:
    """Masks of the bits that each table groups by."""
    edges = [64 * i // parts for i in range(parts + 1)]
    piece = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(parts)]
    return [sum(piece[i] for i in some) for some in combinations(range(parts), parts - radius)]


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 x words: bit j of word w of plane p is bit p of fingerprint 64 w + j."""
    padded = np.zeros(-(-len(prints) // 64) * 64, "<u8")
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8").astype(U64)


def _add(a, b, c):
    """Carry-save adder: (sum, carry) of three bits, in every place."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def within(planes, prints, query, word, alive, use: list[int], radius: int):
    """Of the comparisons (fingerprint ``query`` with the 64 of ``word``, places
    ``alive``): those with places left whose distance over the planes ``use`` is
    at most ``radius`` (under 8), as (query, word, alive)."""
    ones = twos = fours = over = np.zeros(len(query), U64)
    for at in range(0, len(use), 8):
        own = prints[query]
        zero = np.zeros(len(query), U64)
        diff = [planes[p][word] ^ (U64(0) - (own >> U64(p) & U64(1))) for p in use[at : at + 8]]
        diff += [zero] * (8 - len(diff))
        four = []
        for i in (0, 4):
            ones, a = _add(ones, diff[i], diff[i + 1])
            ones, b = _add(ones, diff[i + 2], diff[i + 3])
            twos, c = _add(twos, a, b)
            four.append(c)
        fours, eight = _add(fours, *four)
        over = over | eight
        more, same = over, ~over
        for bit, count in ((4, fours), (2, twos), (1, ones)):
            if radius & bit:
                same = same & count
            else:
                more, same = more | (same & count), same & ~count
        alive = alive & ~more
        stay = np.flatnonzero(alive)
        if len(stay) < 0.75 * len(alive):  # whole words have passed the radius
            query, word, alive = query[stay], word[stay], alive[stay]
            ones, twos, fours, over = ones[stay], twos[stay], fours[stay], over[stay]
        if not len(alive):
            break
    return query, word, alive


def _join(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels (the least member) after joining the groups of u and v."""
    while True:
        a, b = label[u], label[v]
        differ = a != b
        if not differ.any():
            return label
        u, v, a, b = u[differ], v[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != label[label]).any():
            label = label[label]


def forest(prints: np.ndarray, lo: np.ndarray, hi: np.ndarray, use: list[int], radius: int) -> np.ndarray:
    """For each fingerprint i, compared with those at lo[i] to hi[i] (end
    exclusive): the least place that links lead to."""
    planes = bit_planes(prints)
    label = np.arange(len(prints))
    asks = np.flatnonzero(lo < hi)
    first, last = lo[asks] >> 6, (hi[asks] - 1) >> 6
    ends = np.cumsum(last - first + 1)
    done = 0
    while done < len(asks):
        base = ends[done - 1] if done else 0
        stop = max(done + 1, int(np.searchsorted(ends, base + STEP, "right")))
        some = slice(done, stop)
        n = (last - first + 1)[some]
        at = np.repeat(np.arange(done, stop), n)
        word = first[at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        query = asks[at]
        low = np.clip(lo[query] - (word << 6), 0, 63).astype(U64)
        high = np.clip((word << 6) + 64 - hi[query], 0, 63).astype(U64)
        alive = (ALL << low) & (ALL >> high)
        query, word, alive = within(planes, prints, query, word, alive, use, radius)
        if len(alive):
            hit, place = np.nonzero(np.unpackbits(alive.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            label = _join(label, query[hit], (word[hit] << 6) + place)
        done = stop
    return label


def _map_links(masks: list[int], radius: int):
    """Spanning links of the groups (table, bits, a, b), which come in order;
    ``side`` tells the blocks a and b apart."""

    def linked(held: pa.Table):
        names = ("table", "bits", "a", "b", "side", "print")
        table, bits, a, b, side, prints = (held.column(n).to_numpy() for n in names)
        prints = prints.view(U64)
        new = np.ones(len(prints), bool)
        new[1:] = (table[1:] != table[:-1]) | (bits[1:] != bits[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(prints))
        group = np.cumsum(new) - 1
        across = a != b
        mine = side == a  # in a pair of blocks, the first one's members ask
        split = begin + np.add.reduceat(mine.astype(np.int64), begin)
        lo = np.where(across, np.where(mine, split[group], len(prints)), np.arange(len(prints)) + 1)
        hi = end[group]
        for t in np.unique(table):
            s, e = np.searchsorted(table, [t, t + 1])
            free = [p for p in range(64) if not masks[t] >> p & 1]
            label = forest(prints[s:e], lo[s:e] - s, hi[s:e] - s, free, radius)
            moved = np.flatnonzero(label != np.arange(e - s))
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints[s:e][moved].view(np.int64)), pa.array(prints[s:e][label[moved]].view(np.int64))], ["u", "v"]
            )

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = pa.Table.from_batches([batch])
            held = batch if held is None else pa.concat_tables([held, batch])
            last = {n: held.column(n)[-1].as_py() for n in ("table", "bits", "a", "b")}
            open_rows = np.ones(held.num_rows, bool)
            for n, x in last.items():
                open_rows &= held.column(n).to_numpy() == x
            start = int(np.argmax(open_rows))  # the last group may go on in the next batch
            if start:
                yield from linked(held.slice(0, start))
                held = held.slice(start)
        if held is not None:
            yield from linked(held)

    return run


def link_prints(classes: DataFrame, radius: int = 4, parts: int = 6, block: int = 1024) -> DataFrame:
    """(u, v): links among the distinct values of ``print``, enough of them to
    connect all that are connected by distances of at most ``radius``."""
    if not 0 <= radius < min(8, parts):
        raise ValueError("radius must be under 8 and under parts")
    masks = tables(parts, radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    kinds = [F.struct(F.lit(t).alias("table"), F.col("print").bitwiseAND(F.lit(m).cast("long")).alias("bits")) for t, m in enumerate(signed)]
    entries = classes.select("print", F.explode(F.array(*kinds)).alias("g")).select("g.table", "g.bits", "print")
    large = entries.groupBy("table", "bits").agg(F.count("*").alias("c")).where(F.col("c") > block)
    large = large.select("table", "bits", F.ceil(F.col("c") / block).cast("int").alias("cuts"))
    cut = entries.join(large, ["table", "bits"], "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    cut = cut.withColumn("side", F.pmod(F.xxhash64("print"), F.col("cuts")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.expr("sequence(0, cuts - 1)")))
    cells = cut.select("table", "bits", F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b"), "side", "print")
    dealt = cells.repartition("table", "bits", "a", "b").sortWithinPartitions("table", "bits", "a", "b", "side", "print")
    return dealt.mapInArrow(_map_links(masks, radius), "u long, v long")


def near_duplicates(docs: DataFrame, k: int = 4, radius: int = 4, parts: int = 6, block: int = 1024) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id
    (the smallest doc_id reachable by links, itself included) and class_id (the
    smallest doc_id with the same fingerprint)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = _written(texts.mapInArrow(_map_prints(k), "doc_id long, print long"), "simhash-prints")
    classes = _written(prints.groupBy("print").agg(F.min("doc_id").alias("class_id")), "simhash-classes")
    links = link_prints(classes.select("print"), radius, parts, block)
    roots = components(links, "simhash-links").withColumnRenamed("node", "print")
    grouped = _written(classes.join(roots, "print"), "simhash-grouped")
    named = grouped.join(grouped.groupBy("root").agg(F.min("class_id").alias("component_id")), "root")
    classes = classes.join(named.select("print", "component_id"), "print", "left")
    classes = classes.select("print", "class_id", F.when(F.col("component_id").isNull(), F.col("class_id")).otherwise(F.col("component_id")).alias("component_id"))
    return prints.join(classes, "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id", "class_id"
    )


def query(spark, sf_dir):
    """Fingerprints and near-duplicate components of all documents."""
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
