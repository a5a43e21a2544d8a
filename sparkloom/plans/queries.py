"""Registered queries: one for each operator of the library, over the whole tables, with SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import convert as C
from ..operators import checks, events, joins, lookup, writes
from ..operators.table import Query, Table, numbered, tables
from ..schema import ColumnSpec, TableSpec, read_schema, spec_of
from ..sources import io, warehouse
from ..storage import shared_dir
from ..streaming import jobs
from . import predicates as P

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def registered(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nullable(rows: DataFrame, column: str, key: str) -> DataFrame:
    """The column with a null in every eleventh key."""
    return rows.withColumn(column, F.when(F.col(key) % 11 == 0, F.lit(None)).otherwise(F.col(column)))


_CUSTOMER_N = "(SELECT c_custkey, c_name, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey, c_acctbal, c_mktsegment FROM customer)"


def _customers(spark: SparkSession, sf_dir: str, dialect: str = "pg") -> Table:
    return Table(_nullable(read(spark, sf_dir, "customer"), "c_nationkey", "c_custkey"), None, dialect)


# --- typed reads -----------------------------------------------------------------------------------------------------


@registered(
    """SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
)
def latest_order_of_segment(spark, sf_dir):
    t = tables(spark, sf_dir)
    building = t("customer").key("c_custkey", {"c_mktsegment": "BUILDING"})
    found = t("orders").find({"o_custkey": building}).order_by_asc_distinct("o_custkey").order_by_desc("o_orderdate", "o_orderkey")
    return found.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice").all()


@registered("SELECT * FROM customer")
def s1_table_handle(spark, sf_dir):
    spec = read_schema('[{"name": "customer", "columns": [{"name": "c_custkey", "isNullable": false, "hasDefault": false, "typeName": "int8"}]}]')
    return tables(spark, sf_dir, spec)("customer").find().all()


@registered("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_totalprice > 100000 AND o_orderpriority = '1-URGENT' GROUP BY o_orderstatus")
def s2_parameterised_query(spark, sf_dir):
    text = "SELECT IDENTIFIER(:by), count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {orders} WHERE o_totalprice > :least AND o_orderpriority = :priority GROUP BY IDENTIFIER(:by)"
    return io.query(spark, text, {"by": "o_orderstatus", "least": 100000, "priority": "1-URGENT"}, orders=read(spark, sf_dir, "orders"))


@registered("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def p1_find(spark, sf_dir):
    return tables(spark, sf_dir)("orders").find({"o_orderstatus": "F"}).select("o_orderkey", "o_totalprice").all()


@registered("SELECT c_custkey, c_name FROM customer")
def p2_select(spark, sf_dir):
    return tables(spark, sf_dir)("customer").find().select("c_custkey", "c_name").all()


@registered(f"SELECT c_custkey FROM {_CUSTOMER_N} WHERE c_nationkey IS NULL AND c_mktsegment = 'BUILDING'")
def p3_value_and_null(spark, sf_dir):
    return _customers(spark, sf_dir).find({"c_nationkey": None, "c_mktsegment": "BUILDING"}).select("c_custkey").all()


@registered(f"SELECT c_custkey, c_nationkey FROM {_CUSTOMER_N} WHERE c_nationkey IS NULL OR c_nationkey IN (3, 5) OR c_nationkey > 22")
def p4_any_of(spark, sf_dir):
    return _customers(spark, sf_dir).find({"c_nationkey": P.any_of([3, None, 5, P.greater_than(22)])}).select("c_custkey", "c_nationkey").all()


@registered("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey < 9000")
def p4_any_of_long_list(spark, sf_dir):
    return tables(spark, sf_dir)("orders").find({"o_orderkey": P.any_of(range(0, 9000, 3))}).select("o_orderkey").all()


@registered(f"SELECT c_custkey, c_nationkey FROM {_CUSTOMER_N} WHERE c_nationkey > 3 AND c_nationkey < 9 AND NOT (c_nationkey IN (5, 6))")
def p5_all_of(spark, sf_dir):
    test = P.all_of([P.greater_than(3), P.less_than(9), P.negate(5), P.negate(6)])
    return _customers(spark, sf_dir).find({"c_nationkey": test}).select("c_custkey", "c_nationkey").all()


@registered(f"SELECT c_custkey, c_nationkey FROM {_CUSTOMER_N} WHERE NOT (c_nationkey = 7)")
def p6_negate(spark, sf_dir):
    return _customers(spark, sf_dir).find({"c_nationkey": P.negate(P.negate(P.negate(7)))}).select("c_custkey", "c_nationkey").all()


@registered(f"SELECT c_custkey, c_nationkey FROM {_CUSTOMER_N}")
def p6_folded_negations_keep_nulls(spark, sf_dir):
    return _customers(spark, sf_dir).find({"c_nationkey": P.any_of([P.negate(1), P.negate(2)])}).select("c_custkey", "c_nationkey").all()


@registered(f"SELECT c_custkey, c_nationkey FROM {_CUSTOMER_N} WHERE NOT (c_nationkey = 1) OR NOT (c_nationkey = 2)")
def p6_unfolded_negations(spark, sf_dir):
    return _customers(spark, sf_dir, "mysql").find({"c_nationkey": P.any_of([P.negate(1), P.negate(2)])}).select("c_custkey", "c_nationkey").all()


@registered("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 5000 OR o_totalprice > 400000")
def p7_less_and_greater(spark, sf_dir):
    return tables(spark, sf_dir)("orders").find({"o_totalprice": P.any_of([P.less_than(5000), P.greater_than(400000)])}).select("o_orderkey", "o_totalprice").all()


@registered("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'")
def p8_half_open_interval(spark, sf_dir):
    return tables(spark, sf_dir)("orders").find({"o_orderdate": P.between(datetime(1996, 1, 1), datetime(1997, 1, 1))}).select("o_orderkey", "o_orderdate").all()


@registered("SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) IN ('building', 'machinery')")
def p9_case_insensitive(spark, sf_dir):
    test = P.any_of([P.case_insensitive("buildING"), P.case_insensitive("Machinery")])
    return tables(spark, sf_dir)("customer").find({"c_mktsegment": test}).select("c_custkey", "c_mktsegment").all()


@registered("SELECT event_id, props FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) IN (7, 8) OR CAST(json_extract(props, '$.k') AS BIGINT) > 95")
def p10_json_path(spark, sf_dir):
    test = P.any_of([P.json_path(["k"], P.any_of([7, 8])), P.json_path(["k"], P.greater_than(95))])
    return tables(spark, sf_dir)("events").find({"props": test}).select("event_id", "props").all()


@registered("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')")
def p11_json_path_ignoring_case(spark, sf_dir):
    rows = read(spark, sf_dir, "events").withColumn("doc", F.to_json(F.struct(F.array(F.lit(1), F.lit(2)).alias("n"), F.struct(F.initcap("event_type").alias("type")).alias("a"))))
    test = P.all_of([P.json_path(["n", "1"], 2), P.case_insensitive(P.json_path(["a", "type"], P.any_of(["CLICK", "VIEW"])))])
    return Table(rows).find({"doc": test}).select("event_id", "event_type").all()


@registered(
    f"""SELECT c_custkey FROM {_CUSTOMER_N} WHERE (c_nationkey = 3 AND c_mktsegment = 'BUILDING') OR (c_acctbal < 0 AND (c_nationkey IS NULL OR c_acctbal > -100))
    OR (c_nationkey = 4 AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000))"""
)
def p12_and_or_trees(spark, sf_dir):
    t = tables(spark, sf_dir)
    rich = t("orders").key("o_custkey", {"o_totalprice": P.greater_than(400000)})
    tree = P.either(
        {"c_nationkey": 3, "c_mktsegment": "BUILDING"},
        P.both({"c_acctbal": P.less_than(0)}, P.either({"c_nationkey": None}, {"c_acctbal": P.greater_than(-100)})),
        {"c_nationkey": 4, "c_custkey": rich},
        {"c_nationkey": P.any_of([])},
    )
    return _customers(spark, sf_dir).find(tree).select("c_custkey").all()


@registered("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 300000")
def p13_and_where(spark, sf_dir):
    return tables(spark, sf_dir)("orders").find({"o_orderstatus": "O"}).and_where({"o_totalprice": P.greater_than(300000)}).select("o_orderkey").all()


@registered("SELECT o_orderkey, c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE c.c_acctbal > 9000 AND c.c_mktsegment <> 'BUILDING'")
def j5_filtered_join(spark, sf_dir):
    condition = P.expression({"c_acctbal": P.greater_than(9000), "c_mktsegment": P.negate("BUILDING")}, "c")
    o, c = read(spark, sf_dir, "orders").alias("o"), read(spark, sf_dir, "customer").alias("c")
    return o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey")).where(condition).select("o_orderkey", "c_name")


@registered("SELECT n_name, n FROM (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 5000 GROUP BY c_nationkey) x JOIN nation ON n_nationkey = c_nationkey")
def p15_as_sub_query(spark, sf_dir):
    found = tables(spark, sf_dir)("customer").find({"c_acctbal": P.greater_than(5000)}).select("c_nationkey").all()
    counts = found.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return counts.join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "n")


# --- joins -------------------------------------------------------------------------------------------------------------


@registered("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7)")
def j1_in_results(spark, sf_dir):
    t = tables(spark, sf_dir)
    return t("orders").find({"o_custkey": t("customer").key("c_custkey", {"c_nationkey": 7})}).select("o_orderkey").all()


@registered("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 50000)")
def j2_not_in(spark, sf_dir):
    t = tables(spark, sf_dir)
    return t("customer").find({"c_custkey": P.negate(t("orders").key("o_custkey", {"o_totalprice": P.greater_than(50000)}))}).select("c_custkey").all()


@registered("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def j2_not_in_rows_left(spark, sf_dir):
    t = tables(spark, sf_dir)
    return t("customer").find({"c_custkey": P.negate(t("orders").key("o_custkey", {"o_totalprice": P.greater_than(400000)}))}).select("c_custkey").all()


@registered(f"SELECT n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM {_CUSTOMER_N})")
def j2_not_in_with_nulls(spark, sf_dir):
    return joins.not_in_keys(read(spark, sf_dir, "nation"), "n_nationkey", _customers(spark, sf_dir).rows.select("c_nationkey")).select("n_nationkey")


@registered(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE (l_orderkey, l_linenumber) IN
    (SELECT o_orderkey, CAST(o_orderkey % 7 AS INTEGER) FROM orders WHERE o_orderkey % 5 = 0)"""
)
def j3_bulk_find(spark, sf_dir):
    keys = read(spark, sf_dir, "orders").where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderkey") % 7).cast("int").alias("l_linenumber"))
    return tables(spark, sf_dir)("lineitem").find_by_tuples(keys, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").all()


@registered("SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey")
def j4_join(spark, sf_dir):
    o, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name", "o_totalprice")


@registered("SELECT c_custkey, p.k AS asked FROM customer JOIN (SELECT o_orderkey AS k, upper('customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')) AS name FROM orders WHERE o_orderkey % 4 = 0) p ON lower(c_name) = lower(p.name)")
def j6_join_ignoring_case(spark, sf_dir):
    asked = read(spark, sf_dir, "orders").where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("asked"), F.upper(F.concat(F.lit("customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))).alias("name"))
    return joins.join_ignoring_case(read(spark, sf_dir, "customer"), asked, [("c_name", "name")]).select("c_custkey", "asked")


@registered("SELECT o_orderkey AS a, o_totalprice AS b FROM orders UNION ALL SELECT o_orderkey + 1 AS a, NULL AS b FROM orders")
def j7_array_pairs(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return joins.rows_of_arrays(o.select(F.array("o_orderkey", F.col("o_orderkey") + 1).alias("a"), F.array("o_totalprice").alias("b")), "a", "b")


# --- lookups -----------------------------------------------------------------------------------------------------------


def _requests(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pos"), (F.col("o_custkey") * 2).alias("c_custkey"))


@registered("SELECT o_orderkey AS pos, o_custkey * 2 AS c_custkey, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey * 2")
def j8_lookup(spark, sf_dir):
    return lookup.lookup(_requests(spark, sf_dir), read(spark, sf_dir, "customer"), "c_custkey").select("pos", "c_custkey", "value.c_name")


@registered("SELECT o_orderkey AS pos, o_custkey * 2 AS c_custkey FROM orders WHERE o_custkey * 2 NOT IN (SELECT c_custkey FROM customer)")
def j9_missing_keys(spark, sf_dir):
    return lookup.strict_lookup(_requests(spark, sf_dir), read(spark, sf_dir, "customer"), "c_custkey")[1].select("pos", "c_custkey")


@registered("SELECT o.o_orderkey AS pos, o.o_custkey, p.o_totalprice AS answer FROM orders o LEFT JOIN (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 0) p ON o.o_orderkey = p.o_orderkey")
def j10_positional_answer(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    answers = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("pos"), F.col("o_totalprice").alias("answer"))
    return lookup.by_position(o.select(F.col("o_orderkey").alias("pos"), "o_custkey"), answers)


@registered(
    """SELECT o_orderkey AS pos, o_orderstatus AS grp, o_custkey AS key, n FROM orders LEFT JOIN
    (SELECT o_orderstatus AS s, o_custkey AS k, count(*) AS n FROM orders WHERE o_totalprice > 200000 GROUP BY ALL) x ON s = o_orderstatus AND k = o_custkey"""
)
def j11_grouped_lookup(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    source = o.where("o_totalprice > 200000").groupBy(F.col("o_orderstatus").alias("grp"), F.col("o_custkey").alias("key")).agg(F.count("*").alias("n"))
    return lookup.lookup(o.select(F.col("o_orderkey").alias("pos"), F.col("o_orderstatus").alias("grp"), F.col("o_custkey").alias("key")), source, "key", ["grp"]).select("pos", "grp", "key", "value.n")


@registered("SELECT c_custkey, coalesce(x.n, 0) AS n, coalesce(x.items, '') AS items FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS items FROM orders GROUP BY 1) x ON o_custkey = c_custkey")
def j12_lookup_lists(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderkey").cast("string").alias("k"))
    found = lookup.lookup_lists(read(spark, sf_dir, "customer").select("c_custkey"), rows, "c_custkey", "o_orderkey", ["k"])
    return found.select("c_custkey", F.size("items").cast("long").alias("n"), F.array_join(F.transform("items", lambda x: x["k"]), ",").alias("items"))


# --- aggregation, order, pages -----------------------------------------------------------------------------------------


@registered("SELECT count(*) AS count FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def a1_count(spark, sf_dir):
    return tables(spark, sf_dir)("orders").count({"o_orderstatus": "F", "o_totalprice": P.greater_than(100000)})


@registered(f"SELECT DISTINCT c_nationkey, c_mktsegment FROM {_CUSTOMER_N}")
def a2_distinct(spark, sf_dir):
    return _customers(spark, sf_dir).find().select("c_nationkey", "c_mktsegment").distinct().all()


@registered("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def a3_distinct_on_any(spark, sf_dir):
    return tables(spark, sf_dir)("orders").find().distinct("o_custkey", "o_orderstatus").select("o_custkey", "o_orderstatus").all()


@registered("SELECT DISTINCT ON (l_orderkey) l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem ORDER BY l_orderkey DESC, l_extendedprice DESC, l_partkey, l_linenumber")
def a4_distinct_on_best(spark, sf_dir):
    found = tables(spark, sf_dir)("lineitem").find().order_by_desc_distinct("l_orderkey").order_by_desc("l_extendedprice").order_by_asc("l_partkey", "l_linenumber")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").all()


@registered(f"SELECT count(*) AS count FROM (SELECT DISTINCT c_nationkey FROM {_CUSTOMER_N})")
def a5_count_distinct_rows(spark, sf_dir):
    return _customers(spark, sf_dir).find().select("c_nationkey").distinct().count()


@registered("SELECT l_orderkey, string_agg(l_partkey || ':' || l_linenumber, ',' ORDER BY l_linenumber, l_partkey) AS items FROM lineitem GROUP BY l_orderkey")
def a6_grouped_lists(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey").alias("pos"), F.concat_ws(":", "l_partkey", "l_linenumber").alias("item"))
    return lookup.grouped_lists(rows, "l_orderkey", "pos", ["item"]).select("l_orderkey", F.array_join(F.transform("items", lambda x: x["item"]), ",").alias("items"))


@registered("SELECT event_id, user_id, CAST(floor((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) / 10) AS BIGINT) AS chunk FROM events")
def a7_chunks(spark, sf_dir):
    return lookup.chunks(read(spark, sf_dir, "events").select("event_id", "user_id"), 10, [F.col("event_id")], ["user_id"])


@registered("SELECT event_id, CAST(floor((row_number() OVER (ORDER BY ts, event_id) - 1) / 100) AS BIGINT) AS chunk FROM events")
def a7_chunks_of_all(spark, sf_dir):
    return lookup.chunks(read(spark, sf_dir, "events").select("event_id", "ts"), 100, [F.col("ts"), F.col("event_id")]).drop("ts")


_LOG = """(SELECT event_id AS seq, ts, 'cache' || (user_id % 3) AS name, CAST(user_id AS VARCHAR) AS key,
  CASE WHEN event_type = 'signup' THEN 'set' WHEN event_type = 'purchase' AND event_id % 5 = 0 THEN 'delete' WHEN event_type = 'error' AND event_id % 40 = 0 THEN 'clear' ELSE 'get' END AS op FROM events)"""


def _as_log(rows: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    op = F.when(kind == "signup", "set").when((kind == "purchase") & (F.col("event_id") % 5 == 0), "delete").when((kind == "error") & (F.col("event_id") % 40 == 0), "clear").otherwise("get")
    return rows.select(F.col("event_id").alias("seq"), "ts", F.concat(F.lit("cache"), F.col("user_id") % 3).alias("name"), F.col("user_id").cast("string").alias("key"), op.alias("op"))


def _log(spark, sf_dir):
    return _as_log(read(spark, sf_dir, "events"))


_READS = f"""(SELECT g.seq, g.name, g.key, coalesce((SELECT max_by(CASE WHEN e.op = 'set' AND epoch_ms(g.ts) < epoch_ms(e.ts) + 172800000 THEN 1 ELSE 0 END, e.seq)
  FROM {_LOG} e WHERE e.name = g.name AND e.seq < g.seq AND (e.op = 'clear' OR (e.key = g.key AND e.op IN ('set', 'delete')))), 0) = 1 AS hit FROM {_LOG} g WHERE g.op = 'get')"""


@registered(f"SELECT seq, name, key, hit FROM {_READS}")
def t4_ttl_reads(spark, sf_dir):
    return events.ttl_reads(_log(spark, sf_dir), 172_800_000).select("seq", "name", "key", "hit")


@registered(
    f"""SELECT name, CAST(block AS BIGINT) AS block, 100.0 * hits / 100 AS hit_percent FROM (SELECT name, block, count(*) AS n, CAST(sum(CAST(hit AS INTEGER)) AS DOUBLE) AS hits FROM
    (SELECT name, hit, floor((row_number() OVER (PARTITION BY name ORDER BY seq) - 1) / 100) AS block FROM {_READS}) GROUP BY ALL) WHERE n = 100"""
)
def a8_hit_rates(spark, sf_dir):
    return events.hit_rates(events.ttl_reads(_log(spark, sf_dir), 172_800_000))


@registered(f"SELECT c_custkey, c_nationkey, row_number() OVER (ORDER BY c_nationkey DESC NULLS FIRST, c_acctbal NULLS LAST, c_custkey) - 1 AS at FROM {_CUSTOMER_N}")
def o1_order(spark, sf_dir):
    q = _customers(spark, sf_dir).find().order_by_desc("c_nationkey").order_by_asc("c_acctbal", "c_custkey")
    return numbered(q.rows, q._keys(), "at").select("c_custkey", "c_nationkey", "at")


@registered("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def o2_limit(spark, sf_dir):
    return tables(spark, sf_dir)("orders").find().order_by_desc("o_totalprice").order_by_asc("o_orderkey").limit(50).select("o_orderkey", "o_totalprice").all()


@registered("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice, o_orderkey LIMIT 1")
def o3_first(spark, sf_dir):
    return tables(spark, sf_dir)("orders").find({"o_orderstatus": "O"}).order_by_asc("o_totalprice", "o_orderkey").select("o_orderkey", "o_totalprice").first()


@registered("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 777 ORDER BY o_orderkey LIMIT 100")
def o4_keyset_page(spark, sf_dir):
    return tables(spark, sf_dir)("orders").find().select("o_orderkey", "o_custkey").page("o_orderkey", 777, 100)[0]


@registered("SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) / 100) AS BIGINT) AS page FROM orders")
def o6_all_pages(spark, sf_dir):
    return tables(spark, sf_dir)("orders").find().order_by_asc("o_orderdate", "o_orderkey").pages(100).select("o_orderkey", "page")


@registered("SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_name = (SELECT min(c_name) FROM customer)")
def o5_one(spark, sf_dir):
    c = tables(spark, sf_dir)("customer")
    name = c.find().order_by_asc("c_name", "c_custkey").select("c_name").limit(1).one()["c_name"]
    row = c.find({"c_name": name}).select("c_custkey", "c_name", "c_nationkey").one_required()
    return spark.createDataFrame([row], c.rows.select("c_custkey", "c_name", "c_nationkey").schema)


# --- writes ------------------------------------------------------------------------------------------------------------


def _customer_spec(rows: DataFrame) -> TableSpec:
    return spec_of("customer", rows.schema, ["c_custkey"], required=["c_custkey", "c_name"], defaults={"c_mktsegment": "NONE", "c_acctbal": 0.0})


@registered(
    """SELECT * FROM customer UNION ALL SELECT c_custkey + 1000000, c_name, c_nationkey, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal ELSE 0.0 END, 'NONE' FROM customer WHERE c_custkey % 7 = 0"""
)
def w1_insert(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    named = F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit("c_custkey"), F.lit("c_name"), F.lit("c_nationkey"), F.lit("c_acctbal"))).otherwise(F.array(F.lit("c_custkey"), F.lit("c_name"), F.lit("c_nationkey")))
    new = c.where("c_custkey % 7 = 0").select((F.col("c_custkey") + 1000000).alias("c_custkey"), "c_name", "c_nationkey", "c_acctbal", named.alias("named"))
    return writes.insert(c, new, _customer_spec(c), "named").table


@registered("SELECT * FROM customer UNION ALL SELECT c_custkey + 1000000, c_name, NULL, c_acctbal, 'NONE' FROM customer WHERE c_custkey % 7 = 0")
def w2_bulk_insert(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    new = c.where("c_custkey % 7 = 0").select((F.col("c_custkey") + 1000000).alias("c_custkey"), "c_name", "c_acctbal")
    return writes.bulk_insert(c, new, ["c_acctbal", "c_nationkey"], _customer_spec(c)).table


@registered(
    """SELECT * FROM customer UNION ALL SELECT k, c_name, c_nationkey, c_acctbal, c_mktsegment FROM (SELECT *, (c_custkey // 2) + (SELECT max(c_custkey) FROM customer) - 10 AS k FROM customer WHERE c_custkey % 3 = 0)
    WHERE k NOT IN (SELECT c_custkey FROM customer) QUALIFY row_number() OVER (PARTITION BY k ORDER BY c_custkey) = 1"""
)
def w3_insert_or_ignore(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    top = c.agg(F.max("c_custkey").alias("top"))
    new = c.where("c_custkey % 3 = 0").crossJoin(F.broadcast(top)).select(F.expr("c_custkey div 2 + top - 10").alias("k"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", F.col("c_custkey").alias("pos")).withColumnRenamed("k", "c_custkey")
    return writes.insert_or_ignore(c, new, [["c_custkey"]], "pos").table


_TWO_KEYS = "(SELECT c_custkey AS pos, c_custkey + 1000000 AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(floor(c_acctbal / 100) AS BIGINT) AS cents FROM customer WHERE c_custkey % 4 <> 0)"


@registered(
    f"""WITH RECURSIVE old AS (SELECT list(DISTINCT c_nationkey || '|' || CAST(floor(c_acctbal / 100) AS BIGINT)) AS a, list(DISTINCT c_mktsegment || '|' || CAST(floor(c_acctbal / 100) AS BIGINT)) AS b FROM customer WHERE c_custkey % 16 = 0),
    new AS (SELECT *, row_number() OVER (ORDER BY pos) AS i, c_nationkey || '|' || cents AS a, c_mktsegment || '|' || cents AS b FROM {_TWO_KEYS}),
    step(i, a, b, kept) AS (SELECT CAST(0 AS BIGINT), a, b, CAST([] AS BIGINT[]) FROM old UNION ALL
      SELECT n.i, CASE WHEN ok THEN list_append(sa, n.a) ELSE sa END, CASE WHEN ok THEN list_append(sb, n.b) ELSE sb END, CASE WHEN ok THEN list_append(kept, n.pos) ELSE kept END
      FROM (SELECT n.i, n.a, n.b, n.pos, s.a AS sa, s.b AS sb, s.kept, NOT list_contains(s.a, n.a) AND NOT list_contains(s.b, n.b) AS ok FROM step s JOIN new n ON n.i = s.i + 1) n),
    last AS (SELECT kept FROM step ORDER BY i DESC LIMIT 1)
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(floor(c_acctbal / 100) AS BIGINT) AS cents FROM customer WHERE c_custkey % 16 = 0 UNION ALL
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, cents FROM {_TWO_KEYS} WHERE list_contains((SELECT kept FROM last), pos)"""
)
def w3_insert_or_ignore_two_keys(spark, sf_dir):
    c = read(spark, sf_dir, "customer").withColumn("cents", F.floor(F.col("c_acctbal") / 100))
    new = c.where("c_custkey % 4 <> 0").withColumn("pos", F.col("c_custkey")).withColumn("c_custkey", F.col("c_custkey") + 1000000)
    return writes.insert_or_ignore(c.where("c_custkey % 16 = 0"), new, [["c_nationkey", "cents"], ["c_mktsegment", "cents"]], "pos").table


_UPSERTS = "(SELECT c_custkey + CASE WHEN c_custkey % 4 = 0 THEN 1000000 ELSE 0 END AS c_custkey, c_name || '!' AS c_name, 99 AS c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 2 = 0)"


def _upserts(c: DataFrame) -> DataFrame:
    key = F.col("c_custkey") + F.when(F.col("c_custkey") % 4 == 0, 1000000).otherwise(0)
    return c.where("c_custkey % 2 = 0").select(key.alias("c_custkey"), F.concat("c_name", F.lit("!")).alias("c_name"), F.lit(99).alias("c_nationkey"), (F.col("c_acctbal") + 1).alias("c_acctbal"), "c_mktsegment")


@registered(
    f"""SELECT coalesce(c.c_custkey, u.c_custkey) AS c_custkey, CASE WHEN u.c_custkey IS NULL THEN c.c_name ELSE u.c_name END AS c_name, CASE WHEN c.c_custkey IS NULL THEN u.c_nationkey ELSE c.c_nationkey END AS c_nationkey,
    CASE WHEN u.c_custkey IS NULL THEN c.c_acctbal ELSE u.c_acctbal END AS c_acctbal, CASE WHEN u.c_custkey IS NULL THEN c.c_mktsegment ELSE u.c_mktsegment END AS c_mktsegment
    FROM customer c FULL JOIN {_UPSERTS} u ON c.c_custkey = u.c_custkey"""
)
def w4_upsert(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    return writes.upsert(c, _upserts(c), ["c_custkey"], keep=["c_nationkey"]).table


@registered(
    f"""SELECT u.c_custkey, CASE WHEN c.c_custkey IS NULL THEN u.c_name ELSE c.c_name END AS c_name, CASE WHEN c.c_custkey IS NULL THEN u.c_nationkey ELSE c.c_nationkey END AS c_nationkey, u.c_acctbal,
    CASE WHEN c.c_custkey IS NULL THEN u.c_mktsegment ELSE c.c_mktsegment END AS c_mktsegment FROM {_UPSERTS} u LEFT JOIN customer c ON c.c_custkey = u.c_custkey"""
)
def w5_bulk_upsert_returning(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    return writes.bulk_upsert(c, _upserts(c), c.columns, ["c_custkey"], ["c_acctbal"], _customer_spec(c)).returning


@registered("SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 300000 AND o_orderstatus = 'O' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders")
def w6_update(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return writes.update(o, {"o_totalprice": P.greater_than(300000), "o_orderstatus": "O"}, {"o_orderstatus": "X"}).table


@registered(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_custkey + 5 ELSE o_custkey END AS o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'U' END ELSE o_orderstatus END AS o_orderstatus FROM orders"""
)
def w7_bulk_update(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    updates = o.where("o_orderkey % 7 = 0").select("o_orderkey", "o_custkey", (F.col("o_custkey") + 5).alias("new_custkey"), F.when(F.col("o_orderkey") % 11 == 0, F.lit(None)).otherwise("U").alias("status"))
    return writes.bulk_update(o, updates, {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey"}, {"o_custkey": "new_custkey", "o_orderstatus": "status"}).table


@registered(f"SELECT * FROM {_CUSTOMER_N} WHERE NOT coalesce(c_nationkey > 10, false)")
def w8_delete(spark, sf_dir):
    return writes.delete(_customers(spark, sf_dir).rows, {"c_nationkey": P.greater_than(10)}).table


@registered("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT (l_linenumber = l_orderkey % 7 AND l_orderkey % 5 = 0)")
def w9_bulk_delete(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    keys = rows.where("l_orderkey % 5 = 0").select("l_orderkey", (F.col("l_orderkey") % 7).cast("int").alias("l_linenumber")).distinct()
    return writes.bulk_delete(rows, keys, ["l_orderkey", "l_linenumber"]).table


@registered("SELECT count(*) AS n, count(*) AS different, CAST(0 AS BIGINT) AS clashes, true AS in_range FROM orders")
def w10_draw_ids(spark, sf_dir):
    o, taken = read(spark, sf_dir, "orders").select("o_orderkey"), read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    drawn = writes.draw_ids(o, ["o_orderkey"], taken, bits=40).join(taken.withColumn("taken", F.lit(1)), "id", "left")
    in_range = F.min((F.col("id") >= 0) & (F.col("id") < 1 << 40)).alias("in_range")
    return drawn.agg(F.count("*").alias("n"), F.count_distinct("id").alias("different"), F.count("taken").alias("clashes"), in_range)


# --- conversion --------------------------------------------------------------------------------------------------------


@registered("SELECT o_orderkey, '\"' || o_orderpriority || '\"' AS priority, '{\"status\":\"' || o_orderstatus || '\",\"key\":' || o_custkey || '}' AS doc FROM orders")
def c1_serialized(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"), F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("key")).alias("doc"))
    spec = TableSpec("orders", (ColumnSpec("o_orderkey", "int8"), ColumnSpec("priority", "json"), ColumnSpec("doc", "jsonb")))
    return C.serialized(rows, spec)


@registered("SELECT o_orderkey, CAST(v AS VARCHAR) AS as_text, CAST(v AS DOUBLE) AS as_number, abs(v) > 9007199254740991 AS loses FROM (SELECT o_orderkey, o_orderkey * 1000000000000 + o_custkey AS v FROM orders)")
def c2_big_integers(spark, sf_dir):
    v = F.col("o_orderkey") * F.lit(1000000000000) + F.col("o_custkey")
    return read(spark, sf_dir, "orders").select("o_orderkey", C.big_integer(v, "string").alias("as_text"), C.big_integer(v, "number").alias("as_number"), C.loses_digits(v).alias("loses"))


@registered(f"SELECT c_custkey, (c_nationkey % 3) <> 0 AS flag FROM {_CUSTOMER_N}")
def c3_tiny_integers(spark, sf_dir):
    return _customers(spark, sf_dir).rows.select("c_custkey", C.tiny_integer(F.col("c_nationkey") % 3).alias("flag"))


@registered("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS at_ms FROM events")
def c4_date_text(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", C.date_text(F.col("ts")).alias("day"), C.time_text(F.col("ts")).alias("at"), C.time_text(F.col("ts"), 3).alias("at_ms"))


@registered("SELECT event_id, strftime(timezone('Australia/Adelaide', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') AS local FROM events")
def c5_between_zones(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", C.time_text(C.between_zones(F.col("ts"), "UTC", "Australia/Adelaide")).alias("local"))


@registered("SELECT p_partkey, p_name AS a, CAST(p_size AS INTEGER) AS b, p_type || ' \"q\", x' AS c, NULL::VARCHAR AS d FROM part")
def c6_parse_composite(spark, sf_dir):
    text = F.concat(F.lit("("), "p_name", F.lit(","), "p_size", F.lit(',"'), "p_type", F.lit(' ""q"", x",)'))
    parsed = C.parse_composite(text)
    return read(spark, sf_dir, "part").select("p_partkey", parsed.alias("x")).select("p_partkey", F.col("x")[0].alias("a"), F.col("x")[1].cast("int").alias("b"), F.col("x")[2].alias("c"), F.col("x")[3].alias("d"))


@registered("SELECT p_partkey, CAST(p_size + 20 AS BIGINT) AS total, 3 AS n, p_name || ',y' AS quoted FROM part")
def c7_parse_array(spark, sf_dir):
    numbers = C.parse_array(F.concat(F.lit("{"), "p_size", F.lit(",NULL,20}")), lambda x: x.cast("long"))
    words = C.parse_array(F.concat(F.lit('{"'), "p_name", F.lit(',y",z}')))
    total = F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0).cast("long")))
    return read(spark, sf_dir, "part").select("p_partkey", total.alias("total"), F.size(numbers).alias("n"), words[0].alias("quoted"))


@registered("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN chr(65533) || text ELSE text END AS text FROM documents")
def c8_repaired_text(spark, sf_dir):
    broken = F.when(F.col("doc_id") % 3 == 0, F.concat(F.unhex(F.lit("EDA080")), F.col("text").cast("binary"))).otherwise(F.col("text").cast("binary"))
    return read(spark, sf_dir, "documents").select("doc_id", C.repaired_text(broken).alias("text"))


@registered("SELECT doc_id, doc_id % 3 <> 0 AS valid FROM documents")
def c9_valid_text(spark, sf_dir):
    text = F.when(F.col("doc_id") % 3 == 0, F.concat(F.unhex(F.lit("FF")), F.col("text").cast("binary"))).otherwise(F.col("text").cast("binary"))
    return read(spark, sf_dir, "documents").select("doc_id", C.valid_text(text).alias("valid"))


@registered("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS user_id, CASE WHEN event_id % 5 = 0 THEN 'user_id' ELSE '' END AS reasons FROM events")
def c10_typed(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select(F.col("event_id").cast("string"), F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.col("user_id").cast("string")).alias("user_id"))
    spec = TableSpec("events", (ColumnSpec("event_id", "int8"), ColumnSpec("user_id", "int8")))
    return C.typed(rows, spec).withColumn("reasons", F.array_join("reasons", ","))


@registered("SELECT p_partkey, p_size * 2 AS doubled FROM part")
def u3_own_parser(spark, sf_dir):
    rows = read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("string").alias("doubled"))
    spec = TableSpec("part", (ColumnSpec("p_partkey", "int8"), ColumnSpec("doubled", "int4")))
    return C.typed(rows.withColumn("p_partkey", F.col("p_partkey").cast("string")), spec, {"int4": lambda c: c.cast("int") * 2}).drop("reasons")


# --- user functions ----------------------------------------------------------------------------------------------------


@registered(
    """SELECT event_id, CASE WHEN user_id % 9 = 0 THEN NULL ELSE user_id * 10 END AS value, CASE WHEN user_id % 9 = 0 THEN 'ValueError: ninth' END AS error FROM events"""
)
def u1_call_once(spark, sf_dir):
    def work(key):
        if key % 9 == 0:
            raise ValueError("ninth")
        return key * 10

    rows, _ = lookup.call_once(read(spark, sf_dir, "events").select("event_id", "user_id"), F.col("user_id"), work, T.LongType())
    return rows.select("event_id", "value", "error")


@registered("SELECT DISTINCT o_custkey AS key, o_custkey * o_custkey AS square FROM orders")
def u2_load_in_batches(spark, sf_dir):
    keys = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"))
    return lookup.load_in_batches(keys, lambda chunk: chunk.assign(square=chunk["key"] ** 2), "key long, square long", 100)


# --- events ------------------------------------------------------------------------------------------------------------


@registered(
    """WITH RECURSIVE r AS (SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
    lists AS (SELECT user_id, list(epoch_us(ts) ORDER BY i) AS t FROM r GROUP BY user_id),
    begins(user_id, i, batch) AS (SELECT user_id, CAST(1 AS BIGINT), CAST(0 AS BIGINT) FROM lists UNION ALL
      SELECT user_id, j, batch + 1 FROM (SELECT b.user_id, b.batch, len(l.t) AS n, b.i + CASE WHEN l.t[b.i + 1] < l.t[b.i] + 21600000000 THEN CASE WHEN l.t[b.i + 2] < l.t[b.i] + 21600000000 THEN CASE WHEN l.t[b.i + 3] < l.t[b.i] + 21600000000
        THEN CASE WHEN l.t[b.i + 4] < l.t[b.i] + 21600000000 THEN 5 ELSE 4 END ELSE 3 END ELSE 2 END ELSE 1 END AS j FROM begins b JOIN lists l USING (user_id)) WHERE j <= n)
    SELECT r.event_id, r.user_id, r.ts, max(b.batch) AS batch FROM r JOIN begins b ON b.user_id IS NOT DISTINCT FROM r.user_id AND b.i <= r.i GROUP BY ALL"""
)
def t1_timed_batches(spark, sf_dir):
    return jobs.timed_batches(read(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "user_id", "ts", 5, 6 * 3_600_000, ["event_id"])


def _drained(stream: DataFrame) -> DataFrame:
    """What a stream gives for all that is there now, through files in the shared folder."""
    spark = stream.sparkSession
    path = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/state").trigger(availableNow=True)
    writer.start(f"{path}/rows").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def _stream(spark, sf_dir, name) -> DataFrame:
    """The files of the folder that have the table's name, as a stream."""
    return spark.readStream.schema(read(spark, sf_dir, name).schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


@registered("SELECT event_id, user_id, c_name FROM events LEFT JOIN customer ON c_custkey = user_id")
def t2_stream_lookup(spark, sf_dir):
    source = read(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "user_id")
    found = jobs.stream_lookup(_stream(spark, sf_dir, "events").select("event_id", "user_id"), source, "user_id")
    return _drained(found.select("event_id", "user_id", F.col("value.c_name").alias("c_name")))


@registered("SELECT DISTINCT user_id, event_type FROM events")
def t3_stream_first_in_window(spark, sf_dir):
    rows = _stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return _drained(jobs.first_in_window(rows, ["user_id", "event_type"], "ts", "365 days").select("user_id", "event_type"))


@registered(f"SELECT seq, name, key, hit FROM {_READS}")
def t4_stream_ttl_reads(spark, sf_dir):
    log = _as_log(_stream(spark, sf_dir, "events")).withColumn("ts", F.col("ts").cast("timestamp"))
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return _drained(jobs.stream_ttl_reads(log, 172_800_000, late="365 days").select("name", "key", "seq", "hit"))
    finally:
        spark.conf.set(name, before)


_EVENTS = """(SELECT event_id AS seq, 'n' || (event_id % 4) AS name, CASE WHEN event_type = 'error' THEN 'delete' WHEN event_type = 'view' THEN 'delete_prefix' WHEN event_type = 'click' AND event_id % 50 = 0 THEN 'clear' WHEN event_type = 'click' THEN 'delete_multiple' END AS op,
  'u:' || user_id AS key, ['u:' || (user_id + 1), 'u:' || (user_id + 2)] AS keys, CASE WHEN event_id % 997 = 0 THEN '' ELSE 'u:' || substr(CAST(user_id AS VARCHAR), 1, CAST(1 + event_id % 2 AS INTEGER)) END AS prefix FROM events)"""


@registered(
    f"""SELECT s.name, s.key, s.seq FROM (SELECT 'n' || (event_id % 4) AS name, 'u:' || user_id AS key, event_id AS seq FROM events WHERE event_type = 'signup') s WHERE NOT EXISTS (
    SELECT 1 FROM {_EVENTS} e WHERE e.name = s.name AND e.seq >= s.seq AND (e.op = 'clear' OR (e.op = 'delete' AND e.key = s.key) OR (e.op = 'delete_multiple' AND list_contains(e.keys, s.key))
    OR (e.op = 'delete_prefix' AND starts_with(s.key, e.prefix) AND (e.seq % 100 = 1 OR e.prefix = ''))))"""
)
def t5_replay_invalidation(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    name, key = F.concat(F.lit("n"), F.col("event_id") % 4).alias("name"), F.concat(F.lit("u:"), F.col("user_id")).alias("key")
    kind = F.col("event_type")
    op = F.when(kind == "error", "delete").when((kind == "view") & ((F.col("event_id") % 100 == 1) | (F.col("event_id") % 997 == 0)), "delete_prefix").when((kind == "click") & (F.col("event_id") % 50 == 0), "clear").when(kind == "click", "delete_multiple")
    start = F.concat(F.lit("u:"), F.substr(F.col("user_id").cast("string"), F.lit(1), (1 + F.col("event_id") % 2).cast("int")))
    prefix = F.when(F.col("event_id") % 997 == 0, "").otherwise(start).alias("prefix")
    keys = F.array(*[F.concat(F.lit("u:"), F.col("user_id") + k) for k in (1, 2)]).alias("keys")
    log = e.select(F.col("event_id").alias("seq"), name, op.alias("op"), key, keys, prefix)
    entries = e.where("event_type = 'signup'").select(name, key, F.col("event_id").alias("seq"))
    return events.replay_invalidation(entries, log)


@registered("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey % 10 <> 0 AND NOT (l_orderkey % 10 = 1 AND l_linenumber = 2)")
def t6_delete_by_path(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = read(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    one = orders.where("l_orderkey % 10 = 0").select(F.array(F.col("l_orderkey").cast("string")).alias("path"))
    two = orders.where("l_orderkey % 10 = 1").select(F.array(F.col("l_orderkey").cast("string"), F.lit("2")).alias("path"))
    return events.delete_by_path(rows, ["l_orderkey", "l_linenumber"], one.unionByName(two))


@registered("SELECT c_custkey, c_name FROM customer WHERE NOT (c_name LIKE 'Customer#00000001%' OR c_name LIKE 'Customer#0000000003%')")
def t6_delete_by_prefix(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    prefixes = c.where("c_custkey IN (10, 3)").select(F.when(F.col("c_custkey") == 10, F.substring("c_name", 1, 17)).otherwise(F.concat(F.substring("c_name", 1, 9), F.lit("0000000003"))).alias("p"))
    return events.delete_by_prefix(c.select("c_custkey", "c_name"), "c_name", prefixes)


# --- checks ------------------------------------------------------------------------------------------------------------


@registered("SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def m1_duplicate_keys(spark, sf_dir):
    return checks.duplicate_keys(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@registered("SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def m2_orphans(spark, sf_dir):
    parents = read(spark, sf_dir, "supplier").where("s_acctbal > 0")
    return checks.orphans(read(spark, sf_dir, "lineitem"), ["l_suppkey"], parents, ["s_suppkey"]).select("l_orderkey", "l_linenumber", "l_suppkey")


@registered(
    f"""SELECT 'nation' AS rule, count(*) FILTER (c_nationkey IS NULL) AS broken FROM {_CUSTOMER_N} UNION ALL SELECT 'segment', count(*) FILTER (c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')) FROM customer
    UNION ALL SELECT 'balance', count(*) FILTER (NOT (c_acctbal >= 0)) FROM customer"""
)
def m3_broken_rules(spark, sf_dir):
    rules = {"nation": checks.not_null("c_nationkey"), "segment": checks.one_of("c_mktsegment", ["BUILDING", "MACHINERY", "HOUSEHOLD"]), "balance": F.col("c_acctbal") >= 0}
    return checks.broken_rules(_customers(spark, sf_dir).rows, rules)


@registered(f"SELECT c_custkey, concat_ws(',', CASE WHEN c_nationkey IS NULL THEN 'nation' END, CASE WHEN c_acctbal < 0 THEN 'balance' END) AS reasons FROM {_CUSTOMER_N} WHERE c_nationkey IS NULL OR c_acctbal < 0")
def m3_rejects(spark, sf_dir):
    found = checks.rejects(_customers(spark, sf_dir).rows, {"nation": checks.not_null("c_nationkey"), "balance": F.col("c_acctbal") >= 0})
    return found.select("c_custkey", F.array_join("reasons", ",").alias("reasons"))


# --- warehouse ---------------------------------------------------------------------------------------------------------


@registered("SELECT event_id, date_trunc('day', ts) AS part FROM events")
def s6_time_partition(spark, sf_dir):
    return warehouse.with_partition(read(spark, sf_dir, "events"), warehouse.TimePartition("DAY", "ts")).select("event_id", F.col("part").cast("timestamp_ntz").alias("part"))


@registered("SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey >= 100 AND l_orderkey < 9000 THEN 100 + CAST(floor((l_orderkey - 100) / 1000) AS BIGINT) * 1000 END AS part FROM lineitem")
def s7_range_partition(spark, sf_dir):
    return warehouse.with_partition(read(spark, sf_dir, "lineitem"), warehouse.RangePartition("l_orderkey", 100, 1000, 9000)).select("l_orderkey", "l_linenumber", "part")


@registered("SELECT event_id, user_id FROM events")
def s8_clustered(spark, sf_dir):
    return warehouse.clustered(read(spark, sf_dir, "events").select("event_id", "user_id", "ts"), ["user_id", "event_id"], warehouse.TimePartition("DAY", "ts")).select("event_id", "user_id")


@registered("SELECT event_id FROM events WHERE date_trunc('day', ts) + INTERVAL 10 DAY > TIMESTAMP '2024-01-25 12:00:00'")
def s9_without_expired(spark, sf_dir):
    rows = warehouse.with_partition(read(spark, sf_dir, "events"), warehouse.TimePartition("DAY", "ts"))
    return warehouse.without_expired(rows, 10 * 86_400_000, datetime(2024, 1, 25, 12)).select("event_id")


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@registered("SELECT o_orderkey, o_custkey, true AS fits FROM orders")
def s4_pieces(spark, sf_dir):
    folder = _folder(spark, "pieces")
    io.export_in_pieces(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), folder, 1000)
    rows = spark.read.parquet(folder).withColumn("file", F.input_file_name())
    fits = rows.groupBy("file").agg((F.count("*") <= 1000).alias("fits"))
    return rows.join(fits, "file").select("o_orderkey", "o_custkey", "fits")


@registered("SELECT o_orderkey AS id, [o_orderstatus, o_orderpriority] AS tags, o_custkey AS customer, date_trunc('month', o_orderdate) AS part FROM orders")
def s5_created_table(spark, sf_dir):
    fields = [{"name": "id", "type": "INT64", "mode": "REQUIRED"}, {"name": "at", "type": "DATETIME"}, {"name": "tags", "type": "STRING", "mode": "REPEATED"}, {"name": "who", "type": "RECORD", "fields": [{"name": "customer", "type": "INT64"}]}]
    table = warehouse.WarehouseTable(spark, _folder(spark, "table"), warehouse.struct_of(fields), warehouse.TimePartition("MONTH", "at")).create()
    o = read(spark, sf_dir, "orders")
    table.append(o.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp_ntz").alias("at"), F.array("o_orderstatus", "o_orderpriority").alias("tags"), F.struct(F.col("o_custkey").alias("customer")).alias("who")))
    return table.read().select("id", "tags", "who.customer", F.col("part").cast("timestamp_ntz").alias("part"))


@registered("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey >= 2000 AND l_orderkey < 3000")
def s10_required_filter(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    table = warehouse.WarehouseTable(spark, _folder(spark, "table"), rows.schema, warehouse.RangePartition("l_orderkey", 0, 1000, 10_000_000, required=True)).create()
    table.append(rows)
    return table.read(F.col("part") == 2000, ["l_orderkey", "l_linenumber"])


@registered("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey = 7")
def s13_external(spark, sf_dir):
    rows, folder = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal"), _folder(spark, "files")
    rows.write.csv(folder, header=True)
    return warehouse.external(spark, folder, "csv", rows.schema, header=True).where("c_nationkey = 7").select("c_custkey", "c_name", "c_acctbal")


@registered("SELECT n_nationkey, n_name, 'a' AS suffix FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT n_nationkey, n_name, 'b' FROM nation WHERE n_nationkey % 2 = 1")
def s15_append_by_suffix(spark, sf_dir):
    rows = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = warehouse.WarehouseTable(spark, _folder(spark, "table"), rows.schema)
    parts = [base.append_by_suffix(rows.where(F.col("n_nationkey") % 2 == k), f"_{name}") for k, name in enumerate("ab")]
    return spark.read.parquet(parts[0]).withColumn("suffix", F.lit("a")).unionByName(spark.read.parquet(parts[1]).withColumn("suffix", F.lit("b")))


@registered("SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_nationkey")
def s11_view(spark, sf_dir):
    warehouse.view(tables(spark, sf_dir)("customer").find({"c_acctbal": P.greater_than(0)}).all(), "positive_customers")
    return spark.sql("SELECT c_nationkey, count(*) AS n FROM positive_customers GROUP BY c_nationkey")


@registered("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def s12_materialized_view(spark, sf_dir):
    folder = f"{shared_dir(spark)}/view-{uuid.uuid4().hex}"
    counts = read(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return warehouse.MaterializedView(folder, counts).read(datetime(2024, 1, 1))


@registered("SELECT event_id, CAST(value AS DOUBLE) AS value FROM events WHERE event_id % 6 <> 0")
def s14_validated(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select(F.col("event_id").cast("string"), F.when(F.col("event_id") % 6 == 0, "bad").otherwise(F.col("value").cast("string")).alias("value"), F.lit(1).alias("extra"))
    schema = warehouse.struct_of([{"name": "event_id", "type": "INT64", "mode": "REQUIRED"}, {"name": "value", "type": "FLOAT64"}])
    return warehouse.validated(rows, schema, ignore_unknown=True)[0]


@registered("SELECT event_id, 'value: not a double' AS reasons FROM events WHERE event_id % 6 = 0")
def s14_rejected(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select(F.col("event_id"), F.when(F.col("event_id") % 6 == 0, "bad").otherwise(F.col("value").cast("string")).alias("value"))
    schema = warehouse.struct_of([{"name": "event_id", "type": "INT64", "mode": "REQUIRED"}, {"name": "value", "type": "FLOAT64"}])
    return warehouse.validated(rows, schema)[1].select("event_id", F.array_join("reasons", ",").alias("reasons"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_order_of_segment(spark, sf_dir)


__all__ = ["ORACLE_SQL", "QUERIES", "Query", "flagship"]
