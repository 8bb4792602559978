"""Greedy runs, split over partitions, against a plain fold of each group."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import runs as R


def folded(rows, rule):
    """rows: (group, order, value, eligible, always) -> {(group, order): (run, place)}"""
    out, state = {}, {}
    for g, o, v, eligible, always in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        n, total, covered, run, place = state.get(g, (0, 0, R.NONE, 0, 0))
        total += v
        at = {"index": n, "value": v, "sum": total}[rule.by]
        if n == 0 or always or (eligible and at > covered):
            begin = total - v if rule.by == "sum" else at
            covered, run, place = max(begin + rule.reach, at), run + 1, 0
        state[g] = (n + 1, total, covered, run, place + 1)
        out[g, o] = (run, place + 1)
    return out


def random_rows(rng, by, sizes, p_eligible, p_always):
    rows = []
    for g, n in sizes.items():
        t = 0
        for o in range(n):
            t += rng.choice([0, 0, 1, 1, 2, 9])
            v = t if by == "value" else rng.choice([1, 1, 2, 3, 20])
            rows.append((g, o, v, rng.random() < p_eligible, rng.random() < p_always))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("by,reach", [("sum", 7), ("sum", 200), ("index", 2), ("index", 0), ("index", 150), ("value", 6), ("value", 400), ("value", 5000)])
@pytest.mark.parametrize("p_eligible,p_always", [(1.0, 0.0), (0.4, 0.02), (0.02, 0.0)])
def test_runs_equal_the_fold(spark, by, reach, p_eligible, p_always):
    """One group of nearly all rows lies in many slices, runs cover whole slices."""
    rng = random.Random(reach * 7 + int(p_eligible * 100))
    rows = random_rows(rng, by, {"big": 700, "a": 1, "b": 40, "c": 130, "z": 3, None: 9}, p_eligible, p_always)
    rule = R.Rule(by, reach)
    df = spark.createDataFrame([(*r, "kept") for r in rows], "g string, o int, v long, e boolean, f boolean, x string")
    got = R.greedy_runs(df, ["g"], ["o"], rule, "v", "e", "f", partitions=9).collect()
    assert {(r.g, r.o): (r.run_no, r.place) for r in got} == folded(rows, rule)
    assert len(got) == len(rows) and all(r.x == "kept" for r in got)


def test_batches_within_a_partition(spark):
    """A partition that comes in many batches, with groups across their edges."""
    rng = random.Random(4)
    rows = random_rows(rng, "sum", {f"g{i:02}": rng.randint(1, 30) for i in range(60)}, 0.7, 0.05)
    rule = R.Rule("sum", 11)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame(rows, "g string, o int, v long, e boolean, f boolean")
        got = R.greedy_runs(df, ["g"], ["o"], rule, "v", "e", "f", partitions=3).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert {(r.g, r.o): (r.run_no, r.place) for r in got} == folded(rows, rule)


def test_empty_and_null_values(spark):
    rule = R.Rule("value", 5)
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("a", 3, 10), ("a", 4, 14)], "g string, o int, v long")
    assert R.greedy_runs(df.where("false"), ["g"], ["o"], rule, "v").collect() == []
    got = {r.o: r.run_no for r in R.greedy_runs(df, ["g"], ["o"], rule, "v").collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 2}


def test_jump_helpers():
    jump = np.array([2, 3, 5, 4, 6, 6])
    assert R.reached(jump, 0).tolist() == [True, False, True, False, False, True]
    last, count = R.ends(jump)
    assert last.tolist() == [5, 4, 5, 4, 4, 5] and count.tolist() == [3, 3, 2, 2, 1, 1]
