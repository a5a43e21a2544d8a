"""Writes, lookups, conversion, events, warehouse and streams on small hand-made tables."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions import convert as C
from sparkloom.operators import checks, events, joins, lookup, writes
from sparkloom.operators.table import filtered
from sparkloom.plans import predicates as P
from sparkloom.schema import BulkNeedsSchema, ColumnSpec, TableSpec, read_schema, spark_type
from sparkloom.sources import io, warehouse
from sparkloom.streaming import jobs

USER = TableSpec("users", (ColumnSpec("id", "int8", False), ColumnSpec("name", "text", False), ColumnSpec("bio", "text"), ColumnSpec("age", "int4", True, True, 42)), ("id",), (("name",),))


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame([(1, "Forbes", "x", 7), (2, "Ellie", None, None)], "id long, name string, bio string, age int")


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_schema():
    found = read_schema('[{"name": "t", "columns": [{"name": "a", "isNullable": false, "hasDefault": false, "typeName": "int8"}, {"name": "b", "isNullable": true, "hasDefault": false, "typeName": "_text"}]}]')["t"]
    assert found.required == ["a"] and found.struct()["b"].dataType == T.ArrayType(T.StringType())
    assert spark_type("numeric(10,2)") == T.DecimalType(10, 2) and spark_type("cidr") == T.StringType()
    with pytest.raises(ValueError, match="38"):
        spark_type("numeric(1000,2)")


def test_inserts(spark, users):
    new = spark.createDataFrame([(3, "John", ["id", "name"], None), (4, "Martin", ["id", "name", "age"], None)], "id long, name string, given array<string>, age int")
    out = writes.insert(users, new, USER, "given")
    assert rows(out.returning, "id", "bio", "age") == [(3, None, 42), (4, None, None)] and out.table.count() == 4
    bulk = writes.bulk_insert(users, new.select("id", "name"), ["id", "name", "bio"], USER)
    assert rows(bulk.returning, "id", "bio", "age") == [(3, None, 42), (4, None, 42)]
    with pytest.raises(BulkNeedsSchema):
        writes.bulk_insert(users, new, ["id"], None)
    with pytest.raises(Exception, match="may not be null"):
        writes.bulk_insert(users, new.select("id", F.lit(None).cast("string").alias("name")), ["id", "name"], USER).table.collect()


def test_insert_or_ignore_with_several_keys(spark, users):
    batch = spark.createDataFrame([(0, 3, "A"), (1, 3, "B"), (2, 4, "B"), (3, 5, "A"), (4, 6, "Forbes"), (5, None, "C"), (6, None, "D"), (7, 2, "Z"), (8, 4, "Y")], "pos int, id long, name string")
    batch = batch.withColumn("bio", F.lit(None).cast("string")).withColumn("age", F.lit(1))
    out = writes.insert_or_ignore(users, batch, [["id"], ["name"]], "pos")
    # 1 falls to 0 by id, so B is free for 2; 3 falls to 0 by name; 8 falls to 2 by id.
    assert rows(out.returning, "id", "name") == [(3, "A"), (4, "B"), (None, "C"), (None, "D")]
    empty = writes.insert_or_ignore(users, batch.limit(0), [["id"], ["name"]], "pos")
    assert empty.returning.count() == 0
    one = writes.insert_or_ignore(users, batch, [["id"]], "pos")
    assert rows(one.returning, "id", "name") == [(3, "A"), (4, "B"), (5, "A"), (6, "Forbes"), (None, "C"), (None, "D")]


@pytest.mark.parametrize("order", ["sorted", "reversed", "shuffled"])
def test_insert_or_ignore_along_chains(spark, order):
    """Chains of 1000 records, each linked to the next by one of two keys, and null keys between."""
    links = [(i, (i + 1) // 2, f"n{i // 2}") for i in range(1000)] + [(2000 + i, 9000 + i % 40 if i % 3 else None, f"m{i % 7}") for i in range(300)]
    positions = list(range(len(links)))
    if order == "reversed":
        positions.reverse()
    elif order == "shuffled":
        random.Random(3).shuffle(positions)
    batch = [(p, a, b) for p, (_, a, b) in zip(positions, links, strict=True)]
    ids, names, expected = {100}, set(), set()
    for p, a, b in sorted(batch):
        if (a is None or a not in ids) and b not in names:
            expected.add(p)
            ids.add(a)
            names.add(b)
    table = spark.createDataFrame([(-1, 100, "old")], "pos int, id long, name string")
    out = writes.insert_or_ignore(table, spark.createDataFrame(batch, "pos int, id long, name string").repartition(3), [["id"], ["name"]], "pos")
    assert {r["pos"] for r in out.returning.collect()} == expected


def test_writes_with_sub_queries(spark, users):
    some = spark.createDataFrame([(1,), (None,)], "id long")
    table = users.unionByName(spark.createDataFrame([(None, "x", None, None)], users.schema))
    out = writes.update(table, P.either({"id": P.in_results(some)}, {"name": "x"}), {"bio": "new"})
    assert rows(out.table, "name", "bio") == [("Ellie", None), ("Forbes", "new"), ("x", "new")] and out.table.columns == users.columns
    assert rows(out.returning, "name") == [("Forbes",), ("x",)]
    gone = writes.delete(table, {"id": P.in_results(some)})
    assert rows(gone.table, "name") == [("Ellie",), ("x",)] and rows(gone.returning, "name") == [("Forbes",)]


def test_jdbc_reads_in_parallel(spark, monkeypatch):
    """No database is here: the options that reach Spark's reader."""
    given = {}

    class Reader:
        def format(self, name):
            given["format"] = name
            return self

        def options(self, **values):
            given.update(values)
            return self

        def load(self):
            return "rows"

    monkeypatch.setattr(type(spark), "read", property(lambda self: Reader()))
    assert io.jdbc(spark, "jdbc:x", "t", ("id", 0, 100, 8), user="u") == "rows"
    assert given == {"format": "jdbc", "url": "jdbc:x", "dbtable": "t", "fetchsize": "10000", "user": "u", "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8"}


def test_long_lists_beside_a_null(spark, users):
    table = users.unionByName(spark.createDataFrame([(None, "x", None, None)], users.schema))
    found = filtered(table, {"id": P.any_of([*range(2, 2000), None])})
    assert rows(found, "name") == [("Ellie",), ("x",)]


def test_upsert(spark):
    schema = "name string, created int, updated int"
    empty = spark.createDataFrame([], schema)
    t1 = writes.upsert(empty, spark.createDataFrame([("A", 1, 1)], schema), ["name"]).table
    t2 = writes.upsert(t1, spark.createDataFrame([("A", 2, 2), ("B", 2, 2)], schema), ["name"], update=["updated"])
    assert rows(t2.table, "name", "created", "updated") == [("A", 1, 2), ("B", 2, 2)] == rows(t2.returning, "name", "created", "updated")
    t3 = writes.upsert(t2.table, spark.createDataFrame([("A", 3, 3), ("B", 3, 3)], schema), ["name"], keep=["created"])
    assert rows(t3.table, "name", "created", "updated") == [("A", 1, 3), ("B", 2, 3)]
    twice = spark.createDataFrame([("A", 8, 8), ("A", 9, 9)], schema)
    with pytest.raises(Exception, match="comes twice"):
        writes.upsert(t1, twice, ["name"]).table.collect()
    assert rows(writes.upsert(t1, twice, ["name"], tie_break=[F.desc("created")]).table, "created") == [(9,)]


def test_updates_and_deletes(spark, users):
    out = writes.update(users, {"age": P.less_than(10)}, {"bio": None, "age": 8})
    assert rows(out.table, "id", "bio", "age") == [(1, None, 8), (2, None, None)] and rows(out.returning, "id") == [(1,)]
    people = spark.createDataFrame([("a", 1), ("b", 2), ("c", 42), ("d", None)], "name string, age int")
    ups = spark.createDataFrame([("a", 1, 2), ("b", 2, None), ("x", 32, 9), ("d", None, 5)], "name string, age int, age_new int")
    both = {"name": "name", "age": "age"}
    assert rows(writes.bulk_update(people, ups, both, {"age": "age_new"}).table, "name", "age") == [("a", 2), ("b", None), ("c", 42), ("d", None)]
    assert rows(writes.bulk_update(people, ups, both, {"age": "age_new"}).returning, "name") == [("a",), ("b",)]
    assert rows(writes.delete(people, {"age": P.greater_than(1)}).table, "name") == [("a",), ("d",)]
    assert writes.delete(people, {}).table.count() == 0 and writes.delete(people, {"age": P.any_of([])}).table.count() == 4
    gone = writes.bulk_delete(people, ups, ["name", "age"])
    assert rows(gone.table, "name") == [("c",), ("d",)] and rows(gone.returning, "name") == [("a",), ("b",)]
    in_list = writes.delete_where_in(people, {"name": P.in_results(ups.select("name"))}, ["name"])
    assert rows(in_list.table, "name") == [("c",)]


def test_drawn_ids_are_unique(spark):
    out = writes.draw_ids(spark.range(600).withColumnRenamed("id", "k"), ["k"], spark.range(300), bits=12)
    drawn = [r["id"] for r in out.collect()]
    assert len(drawn) == 600 == len(set(drawn)) and all(300 <= x < 4096 for x in drawn)


def test_lookups(spark):
    requests = spark.createDataFrame([(0, "hello"), (1, "NOT_FOUND"), (2, "world"), (3, "hello"), (4, None)], "pos int, key string")
    source = spark.createDataFrame([("hello", 5), ("world", 6), ("other", 7)], "key string, n int")
    assert rows(lookup.lookup(requests, source, "key").select("pos", "value.n"), "pos", "n") == [(0, 5), (1, None), (2, 6), (3, 5), (4, None)]
    strict, missing = lookup.strict_lookup(requests, source, "key")
    assert rows(missing, "pos") == [(1,), (4,)]
    with pytest.raises(Exception, match="no row with key"):
        strict.collect()
    posts = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (1, "c", 2)], "author int, title string, at int")
    asked = spark.createDataFrame([(1,), (3,)], "author int")
    found = {r["author"]: [x["title"] for x in r["items"]] for r in lookup.lookup_lists(asked, posts, "author", "at", ["title"]).collect()}
    assert found == {1: ["a", "c"], 3: []}
    cut = lookup.chunks(spark.createDataFrame([(g, i) for g in (1, 2) for i in range(7)], "g int, i int"), 3, [F.col("i")], ["g"])
    assert rows(cut.where("g = 2"), "i", "chunk") == [(i, i // 3) for i in range(7)]
    assert rows(lookup.chunks(spark.range(10), 4, [F.desc("id")]), "id", "chunk") == [(i, (9 - i) // 4) for i in range(10)]


def test_functions_are_called_once_for_a_key(spark):
    calls = spark.sparkContext.accumulator(0)

    def work(key):
        calls.add(1)
        if key == "ERROR_THIS":
            raise RuntimeError("no")
        return key.upper()

    requests = spark.createDataFrame([("a",), ("a",), ("b",), ("ERROR_THIS",)] * 5, "k string")
    out, stored = lookup.call_once(requests, F.col("k"), work, T.StringType(), lambda v: v != "B")
    stored = stored.cache()
    assert rows(stored, "key", "value") == [("a", "A")] and calls.value == 3
    assert {(r["k"], r["value"], r["error"]) for r in out.collect()} == {("a", "A", None), ("b", "B", None), ("ERROR_THIS", None, "RuntimeError: no")}
    before = calls.value
    again, _ = lookup.call_once(requests, F.col("k"), work, T.StringType(), stored=stored)
    assert again.count() == 20 and again.select("value").collect() and calls.value - before <= 4


def test_conversion(spark):
    one = spark.createDataFrame([('(10.20,USD,"This is a wonderful ""description""!")', '{a,NULL,"x,y","NULL",b c}', "{{1,2},{3}}"), ("(,\"a\\\"b\",)", "{}", "{}"), (None, "no", None)], "c string, a string, n string")
    out = one.select(C.parse_composite(F.col("c")).alias("c"), C.parse_array(F.col("a")).alias("a"), C.parse_array(F.col("n"), lambda x: F.char_length(x)).alias("n")).collect()
    assert out[0]["c"] == ["10.20", "USD", 'This is a wonderful "description"!'] and out[1]["c"] == [None, 'a"b', None] and out[2]["c"] is None
    assert out[0]["a"] == ["a", None, "x,y", "NULL", "b c"] and out[1]["a"] == [] and out[2]["a"] is None
    assert out[0]["n"] == [5, 3]
    surrogate = b"\xed\xa0\xbd"
    text = spark.createDataFrame([(bytearray(b"ok \xc3\xa9"),), (bytearray(surrogate + b"a"),), (bytearray(b"a" + surrogate),), (bytearray(surrogate + b"\xed\xb8\x80"),), (None,)], "b binary")
    assert [r[0] for r in text.select(C.repaired_text(F.col("b"))).collect()] == ["ok é", "�a", "a�", "😀", None]
    assert [r[0] for r in text.select(C.valid_text(F.col("b"))).collect()] == [True, False, False, False, False]
    numbers = spark.createDataFrame([(1,), (2**53 - 1,), (9999999999999999,), (None,)], "n long")
    assert [r[0] for r in numbers.select(C.loses_digits(F.col("n"))).collect()] == [False, False, True, None]
    at = spark.createDataFrame([(datetime(2000, 6, 3, 20, 40, 10, 123000),)], "t timestamp_ntz")
    assert at.select(C.time_text(C.between_zones(F.col("t"), "UTC", "Australia/Adelaide"), 3)).first()[0] == "2000-06-04 06:10:10.123"


def test_cache_events(spark):
    t0 = datetime(2024, 1, 1)
    log = [(0, 0, "a", "x", "get"), (1, 0, "a", "x", "set"), (2, 5, "a", "x", "get"), (3, 50, "a", "x", "get"), (4, 60, "a", "x", "set"), (5, 61, "a", None, "clear"), (6, 62, "a", "x", "get"), (7, 63, "b", "x", "set"), (8, 64, "b", "x", "delete"), (9, 65, "b", "x", "get")]
    df = spark.createDataFrame([(s, t0 + timedelta(milliseconds=ms), n, k, op) for s, ms, n, k, op in log], "seq long, ts timestamp, name string, key string, op string")
    assert rows(events.ttl_reads(df, 10), "seq", "hit") == [(0, False), (2, True), (3, False), (6, False), (9, False)]
    assert dict(rows(events.ttl_reads(df), "seq", "hit"))[3] is True
    entries = spark.createDataFrame([("n", "a:1", 1), ("n", "a:2", 2), ("n", "b:3", 3), ("n", "b:4", 9), ("m", "a:1", 1)], "name string, key string, seq long")
    kinds = "name string, seq long, op string, key string, keys array<string>, prefix string"
    assert rows(events.replay_invalidation(entries, spark.createDataFrame([("n", 5, "delete_prefix", None, None, "a:")], kinds)), "name", "key") == [("m", "a:1"), ("n", "b:3"), ("n", "b:4")]
    more = spark.createDataFrame([("n", 5, "delete_multiple", None, ["a:1", "b:4"], None), ("n", 2, "delete", "b:3", None, None)], kinds)
    assert rows(events.replay_invalidation(entries, more), "name", "key") == [("m", "a:1"), ("n", "a:2"), ("n", "b:3"), ("n", "b:4")]
    assert rows(events.replay_invalidation(entries, spark.createDataFrame([("n", 5, "clear", None, None, None)], kinds)), "name", "key") == [("m", "a:1"), ("n", "b:4")]
    paths = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k1 int, k2 int, v string")
    assert rows(events.delete_by_path(paths, ["k1", "k2"], spark.createDataFrame([(["1"],)], "path array<string>")), "v") == [("c",)]
    assert rows(events.delete_by_path(paths, ["k1", "k2"], spark.createDataFrame([(["1", "2"],)], "path array<string>")), "v") == [("a",), ("c",)]
    assert rows(events.sizes(paths, ["k1"]), "k1", "size") == [(1, 2), (2, 1)]


@pytest.mark.parametrize(("size", "hours", "span"), [(3, 40, 4), (5, 40, 5), (3, 40, 100_000), (100, 1, 8), (2, 0, 7)])
def test_timed_batches_against_a_loop(spark, size, hours, span):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "user_id", "ts").withColumn("user_id", F.when(F.col("user_id") % 7 != 0, F.col("user_id") % 9))
    expected, state = {}, {}
    for r in source.orderBy("user_id", "ts", "event_id").collect():
        begin, n, batch = state.get(r["user_id"], (r["ts"], 0, 0))
        if n and (n == size or (r["ts"] - begin).total_seconds() >= 3600 * hours):
            begin, n, batch = r["ts"], 0, batch + 1
        state[r["user_id"]] = (begin, n + 1, batch)
        expected[r["event_id"]] = batch
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = {r["event_id"]: r["batch"] for r in jobs.timed_batches(source, "user_id", "ts", size, 3600 * hours * 1000, ["event_id"], span).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert out == expected and max(expected.values()) > 2


def test_warehouse(spark, tmp_path):
    schema = warehouse.struct_of([{"name": "id", "type": "INTEGER", "mode": "REQUIRED"}, {"name": "value", "type": "STRING"}, {"name": "tags", "type": "STRING", "mode": "REPEATED"}, {"name": "r", "type": "RECORD", "fields": [{"name": "d", "type": "DATE"}]}])
    assert schema.simpleString() == "struct<id:bigint,value:string,tags:array<string>,r:struct<d:date>>" and not schema["id"].nullable
    flat = warehouse.struct_of([{"name": "id", "type": "INTEGER", "mode": "REQUIRED"}, {"name": "the_date", "type": "DATE"}])
    table = warehouse.WarehouseTable(spark, f"{tmp_path}/t", flat, warehouse.RangePartition("id", 0, 1000, 5000, required=True)).create()
    good = spark.range(6000).select("id", F.lit("2024-01-02").alias("the_date"))
    assert warehouse.insert_rows(table, good).count() == 0
    bad = spark.createDataFrame([(1, "not a valid date"), (None, "2024-01-01"), (7, "2024-01-01")], "id long, the_date string")
    with pytest.raises(ValueError, match="invalid row"):
        warehouse.insert_rows(table, bad)
    assert warehouse.insert_rows(table, bad, skip_invalid=True).count() == 2
    with pytest.raises(ValueError, match="unknown"):
        warehouse.validated(bad.withColumn("x", F.lit(1)), flat)
    with pytest.raises(ValueError, match="predicate"):
        table.read()
    pruned = table.read(F.col("part") == 2000)
    assert pruned.count() == 1000 and "PartitionFilters: [isnotnull(part" in pruned._jdf.queryExecution().toString()
    assert table.read(F.col("part").isNull()).count() == 1000 and table.read(F.col("id") >= 0).count() == 6001
    other = table.append_by_suffix(good.limit(5), "_x")
    assert spark.read.parquet(other).count() == 5
    view = warehouse.MaterializedView(f"{tmp_path}/v", spark.range(3), 1000)
    t0 = datetime(2024, 1, 1)
    assert view.read(t0).count() == 3 and view.version == 1
    view.read(t0 + timedelta(milliseconds=999))
    assert view.version == 1 and view.read(t0 + timedelta(seconds=1)).count() == 3 and view.version == 2
    good.limit(3).write.csv(f"{tmp_path}/c", header=True)
    assert warehouse.external(spark, f"{tmp_path}/c", "csv", T.StructType([T.StructField("id", T.LongType()), T.StructField("the_date", T.StringType())]), header=True).count() == 3
    io.export_in_pieces(spark.range(100).coalesce(1), f"{tmp_path}/p", 30)
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 4
    (tmp_path / "q.sql").write_text("SELECT :x AS x")
    assert io.query_file(spark, f"{tmp_path}/q.sql", {"x": 5}).first()["x"] == 5
    assert [q.first()[0] for q in io.query(spark, ["SELECT 1", "SELECT :a"], {"a": "it's"})] == [1, "it's"]


def test_joins(spark):
    pairs = joins.rows_of_arrays(spark.createDataFrame([([1, 2], ["a"])], "x array<int>, y array<string>"), "x", "y")
    assert rows(pairs, "x", "y") == [(1, "a"), (2, None)]
    left, right = spark.createDataFrame([("A@x",), ("b@x",)], "email string"), spark.createDataFrame([("a@X", 1), ("a@x", 2)], "mail string, n int")
    assert rows(joins.join_ignoring_case(left, right, [("email", "mail")]), "n") == [(1,), (2,)]


def test_checks(spark):
    t = spark.createDataFrame([(1, 1, "x"), (1, 1, "y"), (None, 1, None), (None, 1, "z")], "k int, fk int, v string")
    assert rows(checks.duplicate_keys(t, ["k"]), "k", "count") == [(1, 2)]
    assert checks.orphans(t, ["fk"], spark.createDataFrame([(2,)], "id int"), ["id"]).count() == 4
    rules = {"v": checks.not_null("v"), "one": checks.one_of("v", ["x", "y"])}
    assert rows(checks.broken_rules(t, rules), "rule", "broken") == [("one", 1), ("v", 1)]
    assert rows(checks.rejects(t, rules), "reasons") == [(["one"],), (["v"],)]


def test_streams(spark, tmp_path):
    schema = "seq long, ts timestamp, name string, key string, op string"
    t0 = datetime(2024, 1, 1)
    log = [(0, 0, "set"), (1, 5, "get"), (2, 5000, "get"), (3, 5001, "set"), (4, 5002, "delete"), (5, 5003, "get"), (6, 5004, "set"), (7, 5005, "get"), (8, 5006, "clear"), (9, 5007, "get")]
    spark.createDataFrame([(s, t0 + timedelta(milliseconds=ms), "c", "k", op) for s, ms, op in log], schema).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    seen: list[pd.DataFrame] = []
    q = jobs.stream_in_batches(source, lambda df, epoch: seen.append(df.toPandas()), "seq", 4, checkpoint=f"{tmp_path}/c1", once=True)
    q.awaitTermination(120)
    assert sorted(zip(*[seen[0][c].tolist() for c in ("seq", "chunk")], strict=True)) == [(i, i // 4) for i in range(10)]

    def drained(stream, name):
        s = stream.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        s.awaitTermination(120)
        return spark.table(name)

    names = spark.createDataFrame([("c", 1)], "name string, n int")
    assert rows(drained(jobs.stream_lookup(source, names, "name").select("seq", "value.n"), "looked"), "n") == [(1,)] * 10
    assert drained(jobs.first_in_window(source, ["name", "key"], "ts", "1 hour"), "firsts").count() == 1
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    out = drained(jobs.stream_ttl_reads(source, 1000), "ttl")
    assert rows(out, "seq", "hit") == [(1, True), (2, False), (5, False), (7, True), (9, False)]
