"""The typed read API: find, select, distinct, order, limit, pages, counts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..plans import predicates as P
from ..schema import TableSpec
from ..storage import settled
from . import joins

#: Longer lists of plain values become a table that is joined.
LONG_LIST = 1000


class MultipleResultsFound(Exception):
    pass


class NoResultFound(Exception):
    pass


def ordering(column: str, descending: bool, dialect: str) -> Column:
    """Null order of the dialect: pg has nulls as the largest values, mysql as the smallest."""
    c = F.col(f"`{column}`")
    if dialect == "pg":
        return c.desc_nulls_first() if descending else c.asc_nulls_last()
    return c.desc_nulls_last() if descending else c.asc_nulls_first()


def numbered(rows: DataFrame, order: Sequence[Column], name: str = "_row", group: Sequence[str] = ()) -> DataFrame:
    """rows with their position from 0 in a total order (of their group), without a window over all of them in one task.

    Rows are dealt by ranges of group and order, counted in each range, and numbered in their range after the sum of the
    ranges before. One row for each group and range is summed up. The dealt rows are a checkpoint, as ranges come from a sample.
    """
    keys = [*[F.col(f"`{g}`") for g in group], *order]
    dealt = settled(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")))
    starts = dealt.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    ahead = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = starts.select(*[F.col(f"`{g}`").alias(f"_g{i}") for i, g in enumerate(group)], F.col("_part").alias("_p"), "_first", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    on = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        on = on & F.col(f"`{g}`").eqNullSafe(F.col(f"_g{i}"))
    return dealt.join(before if group else F.broadcast(before), on).select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_before") + F.col("_at") - F.col("_first")).alias(name))


@dataclass(frozen=True)
class Query:
    """A lazy selection. Immutable: every step gives a new one."""

    rows: DataFrame
    dialect: str = "pg"
    fold: bool = True
    columns: tuple[str, ...] | None = None
    distinct_on: tuple[str, ...] | None = None
    order: tuple[tuple[str, bool, bool], ...] = ()  # column, descending, distinct
    take: int | None = None

    def and_where(self, condition: P.Condition) -> Query:
        return replace(self, rows=filtered(self.rows, condition, self.fold))

    def select(self, *columns: str) -> Query:
        if self.columns is not None:
            raise ValueError("select can be called once")
        return replace(self, columns=columns)

    def distinct(self, *columns: str) -> Query:
        return replace(self, distinct_on=columns)

    def _ordered(self, columns: Sequence[str], descending: bool, distinct: bool) -> Query:
        if distinct and any(not d for _, _, d in self.order):
            raise ValueError("distinct order keys come before all others")
        return replace(self, order=self.order + tuple((c, descending, distinct) for c in columns))

    def order_by_asc(self, *columns: str) -> Query:
        return self._ordered(columns, False, False)

    def order_by_desc(self, *columns: str) -> Query:
        return self._ordered(columns, True, False)

    def order_by_asc_distinct(self, *columns: str) -> Query:
        return self._ordered(columns, False, True)

    def order_by_desc_distinct(self, *columns: str) -> Query:
        return self._ordered(columns, True, True)

    def limit(self, n: int) -> Query:
        if not self.order:
            raise ValueError("limit needs an order")
        return replace(self, take=n)

    def _keys(self) -> list[Column]:
        return [ordering(c, d, self.dialect) for c, d, _ in self.order]

    def all(self) -> DataFrame:
        """The rows, as a lazy DataFrame; it serves as a sub-query as well."""
        rows = self.rows
        keys = [c for c, _, distinct in self.order if distinct]
        if keys:
            best = [ordering(c, d, self.dialect) for c, d, distinct in self.order if not distinct] or [F.lit(1)]
            rows = rows.withColumn("_best", F.row_number().over(Window.partitionBy(*keys).orderBy(*best))).where("_best = 1").drop("_best")
        if self.distinct_on:
            rows = rows.dropDuplicates(list(self.distinct_on))
        if self.distinct_on == ():
            rows = rows.select(*self.columns).distinct() if self.columns else rows.distinct()
        if self.order:
            rows = rows.orderBy(*self._keys())
        if self.take is not None:
            rows = rows.limit(self.take)
        return rows.select(*self.columns) if self.columns else rows

    def first(self) -> DataFrame:
        return self.limit(1).all()

    def count(self) -> DataFrame:
        return self.all().agg(F.count("*").alias("count"))

    def one(self) -> Row | None:
        found = self.all().limit(2).collect()
        if len(found) > 1:
            raise MultipleResultsFound("more than one row matches")
        return found[0] if found else None

    def one_required(self) -> Row:
        found = self.one()
        if found is None:
            raise NoResultFound("no row matches")
        return found

    def page(self, key: str, token: Any, size: int) -> tuple[DataFrame, DataFrame]:
        """The rows after the token in key order, and a one-row frame with the next token."""
        after = self.and_where({key: P.greater_than(token)}) if token is not None else self
        rows = after.order_by_asc(key).limit(size).all()
        return rows, rows.agg(F.max(key).alias("next_token"))

    def pages(self, size: int) -> DataFrame:
        """All rows with their page number from 0."""
        if not self.order:
            raise ValueError("pages need an order")
        return numbered(replace(self, order=()).all(), self._keys()).withColumn("page", F.floor(F.col("_row") / size)).drop("_row")

    def stream(self) -> Iterator[Row]:
        return self.all().toLocalIterator(prefetchPartitions=True)


def filtered(rows: DataFrame, condition: P.Condition, fold: bool = True) -> DataFrame:
    """rows where the condition is true; sub-queries become joins.

    A sub-query that must hold, or must not, is a semi or anti join; one inside another condition becomes a three-valued column by a
    left join on its distinct keys.
    """
    if isinstance(condition, dict):
        rest = {}
        for column, value in condition.items():
            test = P.as_test(value)
            if test.kind == "in":
                rows = joins.in_keys(rows, column, test.value)
            elif test.kind == "not" and test.parts[0].kind == "in":
                rows = joins.not_in_keys(rows, column, test.parts[0].value)
            elif test.kind == "any" and sum(p.kind == "eq" for p in test.parts) > LONG_LIST:
                field = rows.schema[column]
                listed = rows.sparkSession.createDataFrame([(p.value,) for p in test.parts if p.kind == "eq"], f"v {field.dataType.simpleString()}")
                others = [p for p in test.parts if p.kind != "eq"]
                if others:  # a null or another test beside a long list
                    rest[column] = P.any_of([P.in_results(listed), *others])
                else:
                    rows = joins.in_keys(rows, column, listed)
            else:
                rest[column] = value
        condition = rest
    names: list[str] = []
    wide = rows

    def members(column: Column, test: P.Test) -> Column:
        nonlocal wide
        names.append(f"_member{len(names)}")
        wide = joins.member_flag(wide, column, test.value, names[-1])
        return F.col(names[-1])

    found = P.known(condition, fold=fold, members=members)
    if isinstance(found, bool):
        return rows if found else rows.limit(0)
    return wide.where(found).select(*[F.col(f"`{c}`") for c in rows.columns])


@dataclass(frozen=True)
class Table:
    """A named table bound to its rows, with an optional description."""

    rows: DataFrame
    spec: TableSpec | None = None
    dialect: str = "pg"

    def find(self, condition: P.Condition | None = None) -> Query:
        rows = filtered(self.rows, condition, self.dialect == "pg") if condition else self.rows
        return Query(rows, self.dialect, self.dialect == "pg")

    def find_by_tuples(self, conditions: DataFrame, columns: Sequence[str]) -> Query:
        return Query(joins.find_by_tuples(self.rows, conditions, columns), self.dialect, self.dialect == "pg")

    def find_one(self, condition: P.Condition) -> Row | None:
        return self.find(condition).one()

    def find_one_required(self, condition: P.Condition) -> Row:
        return self.find(condition).one_required()

    def count(self, condition: P.Condition | None = None) -> DataFrame:
        return self.find(condition).count()

    def key(self, column: str, condition: P.Condition | None = None) -> P.Test:
        """Test: the value is in this table's column, among rows of the condition."""
        return P.in_results(self.find(condition).all().select(column))


def tables(spark: SparkSession, folder: str, specs: dict[str, TableSpec] | None = None, dialect: str = "pg"):
    """A function from a table's name to the Table of folder/name.parquet."""

    def bound(name: str) -> Table:
        return Table(spark.read.parquet(f"{folder}/{name}.parquet"), (specs or {}).get(name), dialect)

    return bound
