"""Lexical search, SimHash near-duplicates and hard negatives against
brute-force versions, and on odd input."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF
from tidemark.llm import hard_negatives, lexical, simhash
from tidemark.sources.tables import read_table

LONG = " ".join(f"word{i % 5000}" for i in range(60_000))
CLASH = "key long, node long, score double, rank int, term string, n int, print string, label string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, an id with two texts,
    ties, and columns whose names clash with the operators' own."""
    rows = [
        (1, None),
        (2, ""),
        (3, "alpha Beta gamma"),
        (3, "alpha Beta gamma"),
        (None, "one two three four five six"),
        (4, "one two three four five six"),
        (4, "another text of the same id: alpha"),
        (5, LONG),
        (6, "  \n\t "),
        (7, "ÄPFEL äpfel Äpfel 12a 12A"),
        (9, "beta alpha gamma"),
        (8, "gamma beta alpha"),
    ]
    return spark.createDataFrame([(*r, 1, 2, 0.5, 3, "t", 4, "p", "l") for r in rows], f"doc_id long, text string, {CLASH}")


# ------------------------------------------------------------------ op11

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def search_by_hand(docs, items, top):
    texts = [(d, [lowered(w) for w in TERM.findall(t or "")]) for d, t in docs]
    n_docs, total = sum(bool(w) for _, w in texts), sum(len(w) for _, w in texts)
    df = Counter(t for _, w in texts for t in set(w))
    out = []
    for item, text in set(items):
        asked = Counter(lowered(t) for t in TERM.findall(text or ""))
        found = []
        for doc, words in texts:
            tf, score = Counter(words), 0
            for t, q in asked.items():
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + (75 * len(words) * n_docs) // total
                    score += q * w * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:top])]
    return Counter(out)


def searched(spark, docs, items, **options):
    rows = lexical.search(docs, spark.createDataFrame(items, "item_id long, text string, score string"), **options).collect()
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in rows)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40, 1])
def test_search_of_odd_rows(spark, odd, block_bytes):
    items = [(1, "alpha gamma"), (2, "äpfel ALPHA alpha two"), (3, None), (4, ""), (5, "unheard of"), (6, "alpha gamma beta"), (6, "word7 six"), (None, "12a word1 word2 alpha gamma"), (1, "alpha gamma")]
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = searched(spark, odd, [(*i, "s") for i in items], top=3, block_bytes=block_bytes)
    assert got == search_by_hand(docs, items, 3)
    assert {d for i, _, d, _ in got if i == 1} == {3, 8}  # ties: the smaller ids


def test_search_of_empty_tables(spark, odd):
    assert not searched(spark, odd.where("false"), [(1, "alpha", "s")])
    assert not searched(spark, odd.where("doc_id = 2"), [(1, "alpha", "s")])
    assert not searched(spark, odd, [(1, None, "s")])
    assert lexical.search(odd, odd.where("false").select(F.col("doc_id").alias("item_id"), "text")).columns == ["item_id", "rank", "doc_id", "score"]


def test_shared_nodes_add_up():
    rng = random.Random(1)
    words = [b"w%d" % i for i in range(60)]
    for n_items in (1, 2, 40):
        asked = [Counter(rng.choices(words[: 10 + i % 50], k=rng.randint(0, 40))) for i in range(n_items)]
        plan = lexical.Plan(asked)
        doc, term = np.divmod(np.arange(7 * len(plan.vocabulary)), max(len(plan.vocabulary), 1))
        value = np.array([rng.randint(0, 1 << 40) for _ in doc], np.int64)
        got = plan.scores(doc, term, value, 7)
        for i, terms in enumerate(asked):
            for d in range(7):
                want = sum(q * value[d * len(plan.vocabulary) + plan.vocabulary.index(t)] for t, q in terms.items())
                assert got[i, d] == want
    assert len(plan.left) > 5  # forty items share more than single sets
    assert len(plan.item_nodes) < sum(len(t) for t in asked)


# ------------------------------------------------------------------ op12

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def print_by_hand(text, k=4):
    words = WORD.findall(lowered(text))
    shingles = [" ".join(words[i : i + k]) for i in range(max(len(words) - k + 1, min(len(words), 1)))]
    counts = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1)
    return sum(1 << b for b, c in counts.items() if 2 * c > len(shingles))


def components_by_hand(prints, radius):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash_query_by_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").orderBy("doc_id").collect()]
    prints = [print_by_hand(t) for _, t in docs]
    roots = components_by_hand(prints, 4)
    want = {d: (f"{p:016x}", docs[r][0]) for (d, _), p, r in zip(docs, prints, roots, strict=True)}
    rows = simhash.query(spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want and len(rows) == len(want)


def test_simhash_odd_rows(spark, odd):
    rows = simhash.near_duplicates(odd).collect()
    docs = odd.select("doc_id", "text").collect()
    assert Counter((r.doc_id, r.fingerprint) for r in rows) == Counter((d.doc_id, f"{print_by_hand(d.text):016x}") for d in docs)
    got = {(r.doc_id, r.fingerprint): r.component_id for r in rows}
    assert got[1, "0" * 16] == got[2, "0" * 16] == got[6, "0" * 16] == 1
    assert got[None, f"{print_by_hand('one two three four five six'):016x}"] == 4
    assert simhash.near_duplicates(odd.where("false")).collect() == []
    assert [r.component_id for r in simhash.near_duplicates(odd.where("doc_id IS NULL")).collect()] == [None]


@pytest.mark.parametrize("block,radius,parts", [(1024, 4, 6), (16, 4, 6), (16, 2, 4), (64, 4, 5), (16, 0, 1), (32, 7, 8)])
def test_links_connect_what_is_connected(spark, block, radius, parts):
    """Clusters of near fingerprints that share most tables' bits, cut in blocks."""
    rng = random.Random(block * 100 + radius)
    prints = {rng.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1}
    for centre in [rng.getrandbits(64) for _ in range(3)]:
        for _ in range(120):
            p = centre
            for b in rng.sample(range(64), rng.randint(0, radius + 3)):
                p ^= 1 << b
            prints.add(p)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    classes = spark.createDataFrame([(p,) for p in signed], "print long").repartition(5)
    links = {(r.u & (1 << 64) - 1, r.v & (1 << 64) - 1) for r in simhash.link_prints(classes, radius, parts, block).collect()}
    assert all(0 < (u ^ v).bit_count() for u, v in links)
    place = {p: i for i, p in enumerate(prints)}
    label = simhash._join(np.arange(len(prints)), *(np.array([place[x[i]] for x in links], np.int64) for i in (0, 1)))
    assert label.tolist() == components_by_hand(prints, radius)


def test_counters_agree_with_popcount():
    rng = np.random.RandomState(3)
    prints = rng.randint(0, 1 << 63, 300, dtype=np.int64).astype(np.uint64)
    prints[1::2] = prints[::2] ^ np.uint64(0b1011) << np.arange(150, dtype=np.uint64) % np.uint64(60)
    planes = simhash.bit_planes(prints)
    query, word = (x.ravel() for x in np.meshgrid(np.arange(300), np.arange(5), indexing="ij"))
    use = list(range(64))
    for radius in range(8):
        q, w, alive = simhash.within(planes, prints, query, word, np.full(1500, simhash.ALL), use, radius)
        got = {(int(a), int(b) * 64 + j) for a, b, m in zip(q, w, alive, strict=True) for j in range(64) if int(m) >> j & 1}
        near = np.bitwise_count(prints[:, None] ^ np.append(prints, np.zeros(20, np.uint64))[None, :]) <= radius
        assert got == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


# ------------------------------------------------------------------ op13


def mined_by_hand(rows):
    rows = {(i, (y + 1) % 10 if i % 7 == 0 else y, tuple(math.floor(256 * x) for x in e)) for i, y, e in rows}
    rows = sorted(rows)
    out = []
    for i, y, a in rows:
        if i % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(a, b, strict=False)), j, z) for j, z, b in rows)
        for s, j, _ in [x for x in scored if x[2] == y and x[1] != i][:5]:
            hard = [(t, k) for t, k, z in scored if z != y and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(hard)]
    return Counter(out)


def mined(df, **options):
    return Counter(tuple(r) for r in hard_negatives.mine(df, **options).collect())


@pytest.mark.parametrize("groups", [{}, {"group_rows": 16, "group_anchors": 2}, {"group_rows": 1, "group_anchors": 1}])
def test_hard_negatives_by_brute_force(spark, groups):
    rng = random.Random(5)
    rows = [(i * 20, rng.randint(0, 3), [float(np.float32(rng.choice([0.0, 0.25, 0.5, -0.25, rng.gauss(0, 1)]))) for _ in range(12)]) for i in range(60)]
    rows += [rows[0], rows[5], (100, 2, [0.5, 0.25]), (400, 1, []), (401, 1, [1.0] * 12), (400, 1, [1.0] * 14)]
    bad = [(500, None, [1.0] * 12), (600, 1, None), (700, 1, [1.0, None]), (800, 1, [float("nan")] * 12), (900, 1, [float("inf")] * 12), (None, 1, [9.0] * 12)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows + bad], "vec_id long, label int, embedding array<float>, rank int, anchor string")
    assert mined(df, **groups) == mined_by_hand(rows)


def test_hard_negatives_odd_tables(spark):
    kinds = "vec_id long, label int, embedding array<float>"
    assert not mined(spark.createDataFrame([], kinds))
    assert not mined(spark.createDataFrame([(100, 1, [1.0])], kinds))
    same = [(100 + i, i % 2, [1.0, 0.5]) for i in range(40)]  # all scores tie: none within 90 percent
    assert not mined(spark.createDataFrame(same, kinds))
    zero = [(1 + i, i % 2, [0.0, 0.0]) for i in range(100)]
    assert mined(spark.createDataFrame(zero, kinds)) == mined_by_hand(zero)


def test_hard_negatives_bounds_drop_rows():
    """The scan reads few rows to the end when scores differ widely."""
    rng = np.random.RandomState(1)
    v = rng.randint(-64, 64, (4096, 32)) * np.where(np.arange(32) % 8 == 0, 32, 1)
    cell = hard_negatives.Cell(pa.table({"vec_id": np.arange(4096), "label": np.sort(rng.randint(0, 4, 4096)), "v": pa.array(v.tolist(), pa.list_(pa.int64()))}))
    left = []
    rows, score = cell.scan(v[0].astype(np.int64), np.arange(4096), lambda lo, hi: (left.append(len(lo)), hi >= hard_negatives._nth(lo, 5))[1])
    assert left[0] > left[-1] and set(rows[cell.first(rows, score, 5)]) == set(np.lexsort((cell.id, -(cell.columns.T @ v[0])))[:5])
