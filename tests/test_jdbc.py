import pytest

from tidemark.sources import jdbc as J


def test_range_options():
    o = J.range_read_options("jdbc:postgresql://db/x", "public.orders", "o_orderkey", 1, 1_000_000, 64)
    assert o["partitionColumn"] == "o_orderkey" and o["numPartitions"] == "64" and o["lowerBound"] == "1"
    with pytest.raises(ValueError):
        J.range_read_options("u", "t", "c", 10, 1, 4)


def test_predicates_cover_and_are_disjoint():
    preds = J.key_predicates("k", [30, 10, 20])
    assert preds == ["k IS NULL", "k < 10", "k >= 10 AND k < 20", "k >= 20 AND k < 30", "k >= 30"]
    # every integer falls in exactly one range predicate
    for v in range(-5, 40):
        hits = [p for p in preds[1:] if eval(p.replace("k", str(v)).replace("AND", "and"))]
        assert len(hits) == 1
