"""Plans and operators that must hold for large groups and odd input."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins as J
from tidemark.sources import backfill as B
from tidemark.sources import catalog as C


@pytest.mark.parametrize("rows_per_task", [1, 3, 1000])
def test_cooccurrence_any_salting(spark, rows_per_task):
    rnd = random.Random(3)
    links = [(g, f"t{rnd.randrange(25)}") for g in [0] * 60 + list(range(1, 12)) * 4] + [(None, "t1"), (None, "t2"), (1, None)]
    got = J.cooccurrence_edges(spark.createDataFrame(links, "g long, t string"), "g", "t", rows_per_task).collect()
    want = {}
    for g in {g for g, _ in links if g is not None}:
        items = sorted({t for h, t in links if h == g and t is not None})
        for i, a in enumerate(items):
            for b in items[i + 1 :]:
                want[a, b] = want.get((a, b), 0) + 1
    assert {(r.source, r.target): r.shared_groups for r in got} == want and len(got) == len(want)


def test_target_check_joins_by_key(spark):
    cand = spark.createDataFrame([("Orders",), ("orders",), ("Mixed",), ("gone",), ("1bad",), (None,)], "candidate string")
    have = spark.createDataFrame([("public", "orders"), ("public", "Mixed"), ("old", "GONE"), ("a", "gone")], "schema_name string, table_name string")
    out = C.target_check(cand, have)
    got = {r.candidate: (r.exists, r.other_schema) for r in out.collect()}
    assert got == {"Orders": (True, None), "orders": (True, None), "Mixed": (True, None), "gone": (False, "a"), "1bad": (False, None), None: (False, None)}
    assert "NestedLoop" not in out._jdf.queryExecution().toString()


@pytest.mark.parametrize("kind", ["string", "bigint", "double"])
def test_offset_page_ties_and_nulls(spark, kind):
    rnd = random.Random(8)
    rows = [(None if rnd.random() < 0.1 else rnd.choice([7, 7, 7, rnd.randrange(5000)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, i bigint").withColumn("k", F.col("k").cast(kind)).repartition(6)
    whole = [tuple(r) for r in df.orderBy("k", "i").collect()]
    for offset, size in [(0, 10), (250, 900), (2990, 50), (1500, 3000), (5000, 10)]:
        assert sorted(map(repr, B.offset_page(df, offset, size).collect())) == sorted(
            map(repr, df.orderBy("k", "i").offset(offset).limit(size).collect())
        ), (offset, size)
    assert len(whole) == 3000


def test_runs_of_many_ties_are_found_by_array_steps():
    """A slice of attempts at one time, all acknowledged, and one of a single run."""
    import numpy as np

    from tidemark.operators import runs as R

    n = 300_000
    same = np.zeros(n, np.int64)
    jump = R.openings(same, same + 10, np.ones(n, bool), np.ones(n, bool), R.NONE)
    assert jump[0] == 0 and R.reached(jump[1:], 0).all() and R.ends(jump[1:])[1][0] == n
    jump = R.openings(same, same + 10, np.ones(n, bool), np.zeros(n, bool), R.NONE)
    assert R.reached(jump[1:], 0).sum() == 1 and (R.ends(jump[1:])[1] == 1).all()


def test_key_search_removes_its_shuffles(spark):
    """The exact counts of a key search hold the disk of one of them at a time."""
    import time

    from tidemark.session import SHUFFLE_CLEANUP
    from tidemark.sources import catalog as C

    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName().split("_") for i in range(files.size()))
        return {n[1] for n in names if n[0] == "shuffle"}

    before, conf = shuffles(), spark.conf.get(SHUFFLE_CLEANUP, None)
    df = spark.range(20_000).selectExpr("if(id = 7, 8, id) AS a", "if(id = 5, 8, id) AS b", "if(id = 3, 8, id) AS c")
    assert C.least_keys(df) == [("a", "b"), ("a", "c"), ("b", "c")]
    for _ in range(20):
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == conf


def test_key_search_settles_sets_by_rows_that_agree(spark):
    """Two equal rows settle every set of columns; none is counted on its own."""
    df = spark.range(4000).select(*[F.xxhash64(F.expr("if(id = 7, 9, id)"), F.lit(i)).alias(f"c{i}") for i in range(8)])
    sc = spark.sparkContext
    try:
        sc.setJobGroup("key-search-rows", "")
        assert C.least_keys(df) == []
        jobs = len(sc.statusTracker().getJobIdsForGroup("key-search-rows"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    assert jobs < 40, jobs  # 92 sets


def _least_keys_by_hand(columns, rows, max_width=3):
    for width in range(1, max_width + 1):
        found = [
            some
            for some in combinations(columns, width)
            if rows and not any(r[c] is None for r in rows for c in some) and len({tuple(r[c] for c in some) for r in rows}) == len(rows)
        ]
        if found:
            return found
    return []


@pytest.mark.parametrize("many,collide", [(1 << 20, False), (0, True)])
def test_key_search_beyond_its_part(spark, monkeypatch, many, collide):
    """Keys of tables much larger than the part looked at first, by brute force; also
    with many repeats and with hashes that collide."""
    monkeypatch.setattr(C, "MANY", many)
    monkeypatch.setattr(C, "BUCKET", 64)
    monkeypatch.setattr(C, "SLICES", 4)
    if collide:
        hashed = C._hash
        monkeypatch.setattr(C, "_hash", lambda some: F.when(hashed(some) % 16 == 0, 48).otherwise(hashed(some)))
    rng = random.Random(4)
    pairs = list(combinations(range(6), 2))
    alone = [(2 * i + 1, 2 * i + 2, (i % 6,)) for i in range(12)]  # rows made equal in some columns
    both = [(2 * i + 1, 2 * i + 2, pairs[i % 15]) for i in range(240)]
    for of, equal, width in [
        ([10**9, 40, 10**9, 700, 3, 50], [], 1),
        ([10**9, 600, 2, 10**9, 600, 5], alone, 2),
        ([10**9] * 6, both, 3),
        ([10**9] * 6, both[:15], 3),
        ([10**9] * 6, both[:15] + [(41, 42, range(6))], 0),
        ([2, 3, 3, 2, 4, 2], [], 0),
    ]:
        rows = [[rng.randrange(k) for k in of] for _ in range(600)]
        for a, b, some in equal:
            for c in some:
                rows[b][c] = rows[a][c]
        rows = [dict(zip("abcdef", [r[0], f"s{r[1]}", r[2], r[3] / 4, r[4], r[5]])) for r in rows]
        rows[0]["f"] = None
        df = spark.createDataFrame([tuple(r.values()) for r in rows], "a long, b string, c int, d double, e long, f int")
        want = _least_keys_by_hand("abcdef", rows)
        assert (len(want[0]) if want else 0) == width
        assert C.least_keys(df, part_rows=60) == want
        assert collide or C.least_keys(df) == want


def test_repeated_hashes(spark):
    df = spark.range(0, 300_000, 1, 3).selectExpr("if(id % 2 = 0 AND id < 200000, 1, id) AS a", "id AS b")
    df = df.union(spark.createDataFrame([(250_001, 0)], "a long, b long"))
    want = sorted(r["h"] for r in spark.sql("SELECT explode(array(xxhash64(1L), xxhash64(250001L))) AS h").collect())
    for n in (300_001, 40 * C.BUCKET):
        assert sorted(r["h"] for r in C.repeated_hashes(df, ("a",), n).collect()) == want
        assert C.repeated_hashes(df, ("a", "b"), n).count() == 0
