import pytest
from pyspark.sql import functions as F

from tidemark.functions import filters as FL


@pytest.fixture(scope="module")
def df(spark):
    rows = [(1, "a", 5.0, True), (2, "b", None, False), (3, None, 7.5, None), (4, "ab", 1.0, True)]
    return spark.createDataFrame(rows, "id long, s string, x double, flag boolean")


def ids(d):
    return sorted(r.id for r in d.select("id").collect())


def test_precedence_and_binds_tighter(df):
    spec = {
        "version": 2,
        "groups": [
            {"conditions": [{"column": "id", "operator": "=", "value": "1"}]},
            {"conditions": [{"column": "id", "operator": "=", "value": "2"}]},
            {"conditions": [{"column": "s", "operator": "=", "value": "zzz"}]},
        ],
        "interLogic": ["OR", "AND"],
    }
    # id=1 OR (id=2 AND s='zzz')  ->  only 1
    assert ids(FL.apply_filter(df, spec, unknown="drop")) == [1]


def test_empty_group_shifts_connectives(df):
    spec = {
        "version": 2,
        "groups": [
            {"conditions": [{"column": "id", "operator": "=", "value": "1"}]},
            {"conditions": [{"column": "s", "operator": "=", "value": ""}]},
            {"conditions": [{"column": "id", "operator": "=", "value": "4"}]},
        ],
        "interLogic": ["OR", "AND"],
    }
    assert ids(FL.apply_filter(df, spec, unknown="drop")) == [1, 4]


def test_null_rules(df):
    spec = {"version": 2, "groups": [{"conditions": [{"column": "x", "operator": ">", "value": "4"}]}], "interLogic": []}
    assert ids(FL.apply_filter(df, spec, unknown="keep")) == [1, 2, 3]
    assert ids(FL.apply_filter(df, spec, unknown="drop")) == [1, 3]


def test_typed_literals_and_in(df):
    spec = {"version": 2, "groups": [{"conditions": [{"column": "id", "operator": "IN", "value": "001, ,3"}]}], "interLogic": []}
    assert ids(FL.apply_filter(df, spec, unknown="drop")) == [1, 3]


def test_like_contains_and_backfill_like(df):
    spec = {"version": 2, "groups": [{"conditions": [{"column": "s", "operator": "LIKE", "value": "b"}]}], "interLogic": []}
    assert ids(FL.apply_filter(df, spec, unknown="drop")) == [2, 4]
    pred = FL.backfill_predicate([{"column": "s", "operator": "LIKE", "value": "b"}], df.schema)
    assert ids(df.filter(pred)) == [2]


def test_between_needs_two_values(df):
    with pytest.raises(FL.FilterError):
        FL.condition("x", "BETWEEN", "1", "", df.schema)


def test_backfill_limit(df):
    with pytest.raises(FL.FilterError):
        FL.backfill_predicate([{"column": "id", "operator": "=", "value": "1"}] * 6, df.schema, FL.MAX_BACKFILL_CONDITIONS)


def test_operator_validation(df):
    FL.validate_operator("x", ">", df.schema)
    FL.validate_operator("s", "ILIKE", df.schema)
    with pytest.raises(FL.FilterError):
        FL.validate_operator("flag", ">", df.schema)
    with pytest.raises(FL.FilterError):
        FL.validate_operator("x", "LIKE", df.schema)


def test_legacy(df):
    assert ids(FL.apply_filter(df, "id > 1; flag = true", unknown="drop")) == [4]


def test_validation_in_compile(df):
    spec = {"version": 2, "groups": [{"conditions": [{"column": "flag", "operator": ">", "value": "1"}]}], "interLogic": []}
    with pytest.raises(FL.FilterError):
        FL.apply_filter(df, spec, validate=True)
    ok = {"version": 2, "groups": [{"conditions": [{"column": "s", "operator": "ILIKE", "value": "A"}]}], "interLogic": []}
    assert ids(FL.apply_filter(df, ok, unknown="drop", validate=True)) == [1, 4]
