"""Conditions: folding, nulls, JSON paths, and random trees against DuckDB."""

from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkloom.operators.table import MultipleResultsFound, NoResultFound, Table
from sparkloom.plans import predicates as P

USERS = [(1, "userWITHmixedCASEname_A", 1), (2, "userWITHmixedCASEname_B", 2), (3, "Forbes", None), (4, None, 42)]


@pytest.fixture(scope="module")
def users(spark):
    return Table(spark.createDataFrame(USERS, "id long, screen_name string, age int"))


def ids(query):
    return sorted(r["id"] for r in query.all().collect())


def test_folding_settles_constants_before_nulls(users):
    assert ids(users.find({"age": P.any_of([])})) == []
    assert ids(users.find({"age": P.all_of([])})) == [1, 2, 3, 4]
    assert ids(users.find({"age": P.all_of([1, 2])})) == []
    assert ids(users.find({"age": P.negate(P.all_of([1, 2]))})) == [1, 2, 3, 4]
    assert ids(users.find({"age": P.any_of([P.negate(1), P.negate(2)])})) == [1, 2, 3, 4]
    assert ids(users.find({"age": P.all_of([P.negate(1), P.negate(3)])})) == [2, 4]
    assert ids(users.find({"age": P.negate(None)})) == [1, 2, 4]
    assert ids(users.find({"age": P.negate(1)})) == [2, 4]


def test_without_folding_nulls_stay_unknown(users):
    mysql = Table(users.rows, None, "mysql")
    assert ids(mysql.find({"age": P.any_of([P.negate(1), P.negate(2)])})) == [1, 2, 4]
    assert ids(mysql.find({"age": P.any_of([])})) == []


def test_case_insensitive_lists_and_trees(users):
    names = P.any_of([P.case_insensitive("USERwithMIXEDcaseNAME_a"), P.case_insensitive("userwithmixedcasename_B")])
    assert ids(users.find({"screen_name": names})) == [1, 2]
    tree = P.both({"screen_name": names, "age": P.any_of([P.negate(1), P.negate(2)])}, {"age": P.any_of([P.negate(P.greater_than(5)), P.negate(P.less_than(10))])})
    assert ids(users.find(tree)) == [1, 2]
    assert ids(users.find(P.either({"age": 42}, {"screen_name": "Forbes"}))) == [3, 4]
    assert ids(users.find(P.either())) == [] and ids(users.find(P.both())) == [1, 2, 3, 4]


def test_json_values_of_any_kind(spark):
    rows = [("a", '"A \\" string"'), ("b", "42"), ("c", "true"), ("d", "[1,2,3]"), ("e", '["foo","bar","baz"]'), ("f", '{"whatever":"this is GREAT"}'), ("g", '{"whatever":"this is GREAT","also":{"this":"is super GREAT"}}'), ("h", "not json"), ("i", None), ("j", '{"1": 2.0, "n": null}'), ("k", '{"1": "2"}')]
    t = Table(spark.createDataFrame(rows, "id string, doc string"))
    both = P.all_of([P.json_path(["whatever"], P.case_insensitive("this is great")), P.json_path(["also", "this"], P.case_insensitive("IS super great"))])
    assert ids(t.find({"doc": P.any_of([P.json_path(["1"], 2), both])})) == ["d", "g", "j"]
    assert ids(t.find({"doc": P.json_path(["1"], "2")})) == ["k"]
    assert ids(t.find({"doc": P.json_path(["1"], "bar")})) == ["e"]
    assert ids(t.find({"doc": P.json_path([], True)})) == ["c"]
    assert ids(t.find({"doc": P.json_path(["1"], P.less_than(3))})) == ["d", "j"]
    assert ids(t.find({"doc": P.case_insensitive(P.json_path(["whatever"], "THIS is great"))})) == ["f", "g"]


def test_sub_queries_follow_nulls(spark, users):
    keys = spark.createDataFrame([(1,), (None,)], "k int")
    none = keys.limit(0)
    assert ids(users.find({"age": P.in_results(keys)})) == [1]
    assert ids(users.find({"age": P.negate(P.in_results(keys))})) == []
    assert ids(users.find({"age": P.negate(P.in_results(keys.dropna()))})) == [2, 4]
    assert ids(users.find({"age": P.negate(P.in_results(none))})) == [1, 2, 3, 4]
    assert ids(users.find(P.either({"age": P.in_results(keys)}, {"id": 3}))) == [1, 3]
    assert ids(users.find(P.either({"age": P.negate(P.in_results(keys.dropna()))}, {"id": 3}))) == [2, 3, 4]
    assert ids(users.find({"id": P.any_of(range(3, 5000))})) == [3, 4]


def test_plans_have_no_pairs_and_push_filters(spark):
    orders = Table(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"))
    customers = Table(spark.read.parquet("/root/testdata/sf0.001/customer.parquet"))

    def plan(rows):
        return rows._jdf.queryExecution().toString()

    semi = plan(orders.find({"o_custkey": customers.key("c_custkey", {"c_mktsegment": "BUILDING"})}).select("o_orderkey").all())
    assert "LeftSemi" in semi and "Cartesian" not in semi and "EqualTo(c_mktsegment,BUILDING)" in semi
    anti = plan(orders.find({"o_custkey": P.negate(customers.key("c_custkey"))}).all())
    assert "LeftAnti" in anti and "true))" not in anti.split("LeftAnti")[1][:40]
    pushed = plan(orders.find({"o_totalprice": P.greater_than(10.0)}).select("o_orderkey").all())
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,10.0)]" in pushed and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in pushed


def _tree(r: random.Random, depth: int):
    """A random test and its SQL for column c, without folding."""
    kind = r.choice(["eq", "null", "less", "greater"] if depth == 0 else ["any", "all", "not", "eq", "less"])
    v = r.randint(0, 5)
    if kind == "eq":
        return v, f"c = {v}"
    if kind == "null":
        return None, "c IS NULL"
    if kind == "less":
        return P.less_than(v), f"c < {v}"
    if kind == "greater":
        return P.greater_than(v), f"c > {v}"
    if kind == "not":
        test, sql = _tree(r, depth - 1)
        return P.negate(test), f"NOT ({sql})"
    parts = [_tree(r, depth - 1) for _ in range(r.randint(1, 3))]
    test = (P.any_of if kind == "any" else P.all_of)([t for t, _ in parts])
    return test, "(" + (" OR " if kind == "any" else " AND ").join(f"({s})" for _, s in parts) + ")"


def test_random_trees_against_duckdb(spark):
    values = [None, 0, 1, 2, 3, 4, 5]
    frame = pd.DataFrame({"id": range(7), "c": pd.array(values, dtype="Int64")})  # noqa: F841  DuckDB reads it
    rows = spark.createDataFrame(list(enumerate(values)), "id int, c int")
    mysql = Table(rows, None, "mysql")
    r = random.Random(11)
    checks, expected = [], []
    for k in range(120):
        test, sql = _tree(r, 3)
        expected.append([x[0] for x in duckdb.sql(f"SELECT id FROM frame WHERE {sql} ORDER BY id").fetchall()])
        found = P.known({"c": test}, fold=False)
        checks.append((F.lit(found) if isinstance(found, bool) else found).alias(f"t{k}"))
    out = rows.select("id", *checks).orderBy("id").collect()
    assert [[row["id"] for row in out if row[f"t{k}"]] for k in range(120)] == expected
    assert mysql.find({"c": 1}).all().count() == 1


def test_builder_rules(users):
    with pytest.raises(ValueError, match="order"):
        users.find().limit(3)
    with pytest.raises(ValueError, match="once"):
        users.find().select("id").select("age")
    with pytest.raises(ValueError, match="distinct"):
        users.find().order_by_asc("id").order_by_asc_distinct("age")
    with pytest.raises(MultipleResultsFound):
        users.find_one({"age": P.greater_than(0)})
    with pytest.raises(NoResultFound):
        users.find_one_required({"id": 99})
    assert users.find_one({"id": 99}) is None and users.find_one_required({"id": 3})["screen_name"] == "Forbes"
    assert users.find().order_by_asc("id").limit(0).all().count() == 0


def test_null_order_of_dialects(users):
    def order(dialect, descending):
        q = Table(users.rows, None, dialect).find()
        q = q.order_by_desc("age") if descending else q.order_by_asc("age")
        return [r["age"] for r in q.all().collect()]

    assert order("pg", False) == [1, 2, 42, None] and order("pg", True) == [None, 42, 2, 1]
    assert order("mysql", False) == [None, 1, 2, 42] and order("mysql", True) == [42, 2, 1, None]


def test_pages(spark, users):
    t = Table(spark.range(1000).withColumnRenamed("id", "k"))
    rows, token = t.find().page("k", 10, 5)
    assert [r["k"] for r in rows.collect()] == [11, 12, 13, 14, 15] and token.first()[0] == 15
    pages = t.find().order_by_desc("k").pages(300).groupBy("page").count().orderBy("page").collect()
    assert [(r["page"], r["count"]) for r in pages] == [(0, 300), (1, 300), (2, 300), (3, 100)]
    assert [r["id"] for r in users.find().order_by_asc("id").stream()] == [1, 2, 3, 4]
