"""Filters against plain Python comparison of the decoded values."""

import itertools
import json

import pytest
from pyspark.sql import types as T

from findry.functions import filters
from findry.operators import corpus as ops

METADATA = [
    {"v": 10}, {"v": 50}, {"v": 100}, {"v": 10.5}, {"v": -3}, {"v": "10"}, {"v": "x"}, {"v": "y"},
    {"v": True}, {"v": False}, {"v": None}, {}, {"other": 10}, {"v": [1, 2]}, {"v": {"a": 1}},
    {"v": 1e3}, {"v": 2 ** 53 + 1}, {"v": ""}, {"v": "2024-01-05"},
]
OPERANDS = [10, 10.0, 10.5, 1, 0, True, "10", "x", "", None, 2 ** 53, 2 ** 53 + 1, 1000,
            "2024-01-01", -3.0]
RANGES = {"$gt": lambda a, b: a > b, "$gte": lambda a, b: a >= b,
          "$lt": lambda a, b: a < b, "$lte": lambda a, b: a <= b}


def expected(metadata, op, operand):
    value = metadata.get("v")
    if op == "$eq":
        return value == operand
    if op == "$ne":
        return value != operand
    if op == "$in":
        return value in operand
    if op == "$nin":
        return value not in operand
    if value is None or operand is None:
        return False
    try:
        return RANGES[op](value, operand)
    except TypeError:
        return False


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, json.dumps(m)) for i, m in enumerate(METADATA)]
    return spark.createDataFrame(rows, "id int, metadata string").cache()


def test_every_operator_and_type(table):
    cases = [(op, o) for op, o in itertools.product(["$eq", "$ne", *RANGES], OPERANDS)]
    members = [[], [10], ["x", "10"], [None], [10, "x", None], [True], [10.5, 1000], (0, "y")]
    cases += [(op, m) for op in ("$in", "$nin") for m in members]
    columns = [filters.predicate({"v": {op: operand}}).alias(f"c{i}")
               for i, (op, operand) in enumerate(cases)]
    got = table.select("id", *columns).orderBy("id").collect()
    wrong = [(METADATA[row["id"]], case, row[f"c{i}"])
             for row in got for i, case in enumerate(cases)
             if row[f"c{i}"] != expected(METADATA[row["id"]], *case)]
    assert wrong == []


def test_bare_value_is_equality(table):
    for value in (10, "x", None, True):
        rows = filters.keep(table, {"v": value}).collect()
        assert {r["id"] for r in rows} == {
            i for i, m in enumerate(METADATA) if m.get("v") == value}


def test_conjunction(spark):
    rows = [(i, json.dumps({"v": v, "t": t})) for i, (v, t) in enumerate(
        itertools.product([10, 50, 100], ["x", "y"]))]
    table = spark.createDataFrame(rows, "id int, metadata string")
    kept = filters.keep(table, {"v": {"$gt": 10, "$lte": 50}, "t": {"$ne": "x"}})
    assert [r["id"] for r in kept.collect()] == [3]


@pytest.mark.parametrize("bad", ["{broken", "", "null", "[1]", "5", None])
def test_metadata_without_keys(spark, bad):
    table = spark.createDataFrame([(1, bad)], "id int, metadata string")
    assert filters.keep(table, {"v": 10}).count() == 0
    assert filters.keep(table, {"v": {"$gt": 0}}).count() == 0
    assert filters.keep(table, {"v": {"$ne": 10}}).count() == 1
    assert filters.keep(table, {"v": {"$nin": [10]}}).count() == 1
    assert filters.keep(table, {"v": None}).count() == 1


@pytest.mark.parametrize("bad", [
    {"t": {"$like": "x"}}, {"t": {"$in": "abc"}}, {"a b": 1}, {"a.b": 1}, {"t": [1]},
    {"t": {"$gt": [1]}}, {"t": {"$in": [[1]]}},
])
def test_refused_before_any_job(bad):
    with pytest.raises(ValueError):
        filters.predicate(bad)


def test_no_clause_never_deletes(table):
    for empty in ({}, None, {"v": {}}):
        assert ops.delete_by_filter(table, empty).count() == len(METADATA)
        assert filters.keep(table, empty).count() == len(METADATA)


def test_delete_is_the_complement(table):
    for condition in ({"v": {"$gt": 10}}, {"v": {"$ne": "x"}}, {"v": None}):
        kept = filters.keep(table, condition).count()
        assert ops.delete_by_filter(table, condition).count() == len(METADATA) - kept


def test_promoted_key_reaches_the_scan(spark, tmp_path):
    rows = [(i, "en" if i % 3 else None, i, json.dumps({})) for i in range(30)]
    spark.createDataFrame(rows, "id int, lang string, views long, metadata string").write.parquet(
        str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    keys = {"lang": "lang", "views": "views"}
    kept = filters.keep(table, {"lang": "en", "views": {"$gte": 10}}, promoted_keys=keys)
    assert {r["id"] for r in kept.collect()} == {i for i in range(10, 30) if i % 3}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(lang,en)" in plan and "GreaterThanOrEqual(views,10)" in plan
    for condition, want in [
        ({"lang": {"$ne": "en"}}, {i for i in range(30) if i % 3 == 0}),
        ({"lang": {"$nin": ["en"]}}, {i for i in range(30) if i % 3 == 0}),
        ({"lang": None}, {i for i in range(30) if i % 3 == 0}),
        ({"views": {"$in": [1, 2.0, 2.5, "3"]}}, {1, 2}),
        ({"views": "7"}, set()),
        ({"views": 7.5}, set()),
        ({"lang": 7}, set()),
    ]:
        found = filters.keep(table, condition, promoted_keys=keys)
        assert {r["id"] for r in found.collect()} == want, condition


def test_promoted_type_is_checked():
    condition = filters.predicate({"a": {"$lt": "x"}}, promoted={"a": ("a", T.LongType())})
    assert condition is not None
