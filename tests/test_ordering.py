from tidemark.operators import ordering as O


def test_group_rank_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 2)], "g string, x int")
    got = sorted(((r.g, r.x, r.rank) for r in O.group_rank(df, ["g"], "x").collect()), key=str)
    assert got == [("a", 2, 1), (None, 1, 2), (None, 3, 1)]


def _first_by_hand(rows, n, descending):
    import collections

    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[0], r[1]].append(r)
    out = []
    for group in groups.values():
        known = sorted((r for r in group if r[2] is not None), key=lambda r: r[2], reverse=descending)
        out += [r[2] for r in (known + [r for r in group if r[2] is None])[:n]]
    return collections.Counter(map(str, out))


def test_first_n_by_selection(spark):
    """Skewed groups, NULL keys and values, ties beyond the window, extreme values."""
    import collections
    import random

    from tidemark.operators import ordering as O

    rng = random.Random(5)
    rows = [("big", 1, rng.choice([rng.randint(-(2**63), 2**63 - 1), rng.randint(0, 3000), 77]), i) for i in range(1500)]
    rows += [("big", 1, -(2**63), -1), ("big", 1, 2**63 - 1, -2), ("one", 2, 9, 0)]
    rows += [("ties", 1, 5, i) for i in range(400)] + [("same", 1, 5, 0)] * 300
    rows += [(None, None, i, i) for i in range(100)] + [("null", 1, None, i) for i in range(40)] + [("null", 1, 3, 1)]
    df = spark.createDataFrame(rows, "g string, h int, v long, x long").repartition(6)
    for n, descending, window_rows in ((50, True, 20), (50, False, 20), (7, True, 1), (350, False, 10), (100_000, True, 10), (0, True, 5), (1, False, 100_000)):
        got = O.first_n(df, ["g", "h"], "v", n, descending, window_rows).collect()
        assert collections.Counter(str(r.v) for r in got) == _first_by_hand(rows, n, descending), (n, descending)
        per = collections.Counter((r.g, r.h) for r in got)
        have = collections.Counter((r[0], r[1]) for r in rows)
        assert per == {k: min(n, c) for k, c in have.items() if n}
    plan = O.first_n(df, ["g", "h"], "v", 50, True, 20)._jdf.queryExecution().toString()
    assert "checkpoint" not in plan.lower()
