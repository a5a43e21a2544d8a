"""Conditions on columns as values, and their Spark expressions.

A condition is a mapping from column to test, a Column, or an and / or of conditions. A test is a plain value, None
(is null) or one of the functions below. With folding (the default), constant parts are settled before Spark sees them, by
the rules that follow; `fold=False` leaves every part to three-valued logic, but any_of([]) is still false.

* any_of([]) is false and all_of([]) is true;
* all_of of two or more different plain values is false;
* the negated parts of an any_of are one negated all_of, and the other way round; so
  any_of([negate(1), negate(2)]) is true for every row, null included.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Test:
    """kind: any, all, not, less, greater, folded (case), path, in, eq, null."""

    kind: str
    parts: tuple = ()
    value: Any = None


@dataclass(frozen=True)
class Combined:
    kind: str
    parts: tuple


Condition = Union[Mapping[str, Any], Column, Combined]
Known = Union[bool, Column]


def as_test(value: Any) -> Test:
    if isinstance(value, Test):
        return value
    return Test("null") if value is None else Test("eq", value=value)


def any_of(values: Iterable[Any]) -> Test:
    return Test("any", tuple(map(as_test, values)))


def all_of(values: Iterable[Any]) -> Test:
    return Test("all", tuple(map(as_test, values)))


def negate(value: Any) -> Test:
    test = as_test(value)
    return test.parts[0] if test.kind == "not" else Test("not", (test,))


def less_than(value: Any) -> Test:
    return Test("less", value=value)


def greater_than(value: Any) -> Test:
    return Test("greater", value=value)


def between(low: Any, high: Any) -> Test:
    """low <= column < high."""
    return all_of([any_of([greater_than(low), low]), less_than(high)])


def case_insensitive(value: Any) -> Test:
    test = as_test(value)
    if test.kind == "path":
        return Test("path", (case_insensitive(test.parts[0]),), test.value)
    return Test("folded", (test,))


def json_path(path: Sequence[str], value: Any) -> Test:
    return Test("path", (as_test(value),), tuple(map(str, path)))


def in_results(rows: DataFrame) -> Test:
    """The column's value is in the only column of rows. Table.find turns it into a join."""
    if len(rows.columns) != 1:
        raise ValueError("in_results takes a DataFrame of one column")
    return Test("in", value=rows)


def both(*conditions: Condition) -> Combined:
    return Combined("all", conditions)


def either(*conditions: Condition) -> Combined:
    return Combined("any", conditions)


def _hashable(value: Any) -> Any:
    return (type(value).__name__, json.dumps(value, sort_keys=True, default=str)) if isinstance(value, (list, dict)) else value


def normal(test: Test) -> Test:
    """The test with negated parts gathered and plain values of one kind brought together."""
    if test.kind not in ("any", "all"):
        return Test(test.kind, tuple(map(normal, test.parts)), test.value)
    dual = {"any": "all", "all": "any"}[test.kind]
    negated = [p.parts[0] for p in test.parts if p.kind == "not"]
    rest = [p for p in test.parts if p.kind != "not"]
    if test.kind == "any":
        folded = [p.parts[0] for p in rest if p.kind == "folded"]
        if len(folded) > 1:
            rest = [p for p in rest if p.kind != "folded"] + [Test("folded", (Test("any", tuple(folded)),))]
    elif len({_hashable(p.value) if p.kind == "eq" else None for p in rest if p.kind in ("eq", "null")}) > 1:
        return Test("any")  # no value equals two different ones
    if negated:
        rest.append(Test("not", (Test(dual, tuple(negated)),)))
    return Test(test.kind, tuple(map(normal, rest)))


class Subject:
    """What a test is about: a column, its text in lower case, or the JSON value at a path of it."""

    def __init__(self, column: Column, path: tuple[str, ...] | None = None, lower: bool = False, parsed: Column | None = None):
        self.column, self.path, self.lower, self.parsed = column, path, lower, parsed

    def variant(self) -> Column:
        found = F.try_parse_json(self.column) if self.parsed is None else self.parsed
        for step in self.path or ():
            quoted = step.replace("\\", "\\\\").replace("'", "\\'")
            by_name = F.try_variant_get(found, f"$['{quoted}']", "variant")
            found = F.coalesce(by_name, F.try_variant_get(found, f"$[{int(step)}]", "variant")) if step.isdecimal() else by_name
        return found

    def text(self) -> Column:
        text = F.to_json(self.variant()) if self.path is not None else self.column.cast("string")
        return F.lower(text) if self.lower else text

    def literal(self, value: Any) -> Any:
        if self.path is not None:
            value = json.dumps(value, separators=(",", ":"), sort_keys=True, ensure_ascii=False)
        return str(value).lower() if self.lower else value

    def operand(self) -> Column:
        return self.text() if self.lower or self.path is not None else self.column

    def equals(self, value: Any) -> Column:
        if self.path is not None and isinstance(value, (int, float)) and not isinstance(value, bool):
            at = self.variant()
            number = F.schema_of_variant(at).rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
            return number & (F.try_variant_get(at, "$", "double") == float(value))
        return self.operand() == F.lit(self.literal(value))

    def compare(self, kind: str, value: Any) -> Column:
        if self.path is not None and isinstance(value, (int, float)) and not isinstance(value, bool):
            at = self.variant()
            left = F.when(F.schema_of_variant(at).rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(at, "$", "double"))
        else:
            left = self.operand()
        right = F.lit(self.literal(value) if self.lower else value)
        return left < right if kind == "less" else left > right


def _join(kind: str, parts: Iterable[Known], fold: bool) -> Known:
    """any: false parts go, a true one settles; all: the other way round. Columns are joined by | or &."""
    settles = kind == "any"
    left: list[Column] = []
    for part in parts:
        if part is settles and fold:
            return settles
        if not (isinstance(part, bool) and part is not settles):
            left.append(F.lit(part) if isinstance(part, bool) else part)
    if not left:
        return not settles
    joined = left[0]
    for part in left[1:]:
        joined = (joined | part) if kind == "any" else (joined & part)
    return joined


def _test(test: Test, on: Subject, fold: bool, members) -> Known:
    if test.kind == "eq":
        return on.equals(test.value)
    if test.kind == "null":
        return (on.variant() if on.path is not None else on.column).isNull()
    if test.kind in ("less", "greater"):
        return on.compare(test.kind, test.value)
    if test.kind == "folded":
        return _test(test.parts[0], Subject(on.column, on.path, True, on.parsed), fold, members)
    if test.kind == "path":
        return _test(test.parts[0], Subject(on.column, (on.path or ()) + test.value, on.lower, on.parsed), fold, members)
    if test.kind == "in":
        if members is None:
            raise ValueError("a sub-query needs Table.find, which joins it")
        return members(on.column, test)
    if test.kind == "not":
        inner = _test(test.parts[0], on, fold, members)
        return (not inner) if isinstance(inner, bool) else ~inner
    parts = test.parts
    plain = [p for p in parts if p.kind == "eq"]
    if test.kind == "any" and len(plain) > 1 and on.path is None:
        values = list({_hashable(p.value): on.literal(p.value) for p in plain}.values())
        known = [_test(p, on, fold, members) for p in parts if p.kind != "eq"]
        return _join("any", [*known, on.operand().isin(values)], fold)
    return _join(test.kind, [_test(p, on, fold, members) for p in parts], fold)


def _kinds(test: Test) -> set[str]:
    return {test.kind}.union(*map(_kinds, test.parts))


def _of_column(test: Test, column: Column, fold: bool, members) -> Known:
    """The test on a column. Tests of JSON paths are made on one parsed value: it is the element of an array, so that it is parsed once for each row."""
    kinds = _kinds(test)
    found = _test(test, Subject(column), fold, members)
    if "path" in kinds and "in" not in kinds and not isinstance(found, bool):
        return F.exists(F.array(F.try_parse_json(column)), lambda x: _test(test, Subject(column, parsed=x), fold, members))
    return found


def known(condition: Condition, alias: str | None = None, fold: bool = True, members=None) -> Known:
    """True, False or a Column."""
    if isinstance(condition, Column):
        return condition
    if isinstance(condition, Combined):
        return _join(condition.kind, [known(c, alias, fold, members) for c in condition.parts], True)
    parts = []
    for name, value in condition.items():
        column = F.col(f"{alias}.`{name}`" if alias else f"`{name}`")
        test = as_test(value)
        parts.append(_of_column(normal(test) if fold else test, column, fold, members))
    return _join("all", parts, True)


def expression(condition: Condition, alias: str | None = None, fold: bool = True) -> Column:
    """The condition as a Column, bound to a join alias if there is one."""
    found = known(condition, alias, fold)
    return F.lit(found) if isinstance(found, bool) else found


def tests_in(condition: Condition) -> Iterable[Test]:
    """All tests of kind "in" of a condition."""
    if isinstance(condition, Combined):
        for part in condition.parts:
            yield from tests_in(part)
    elif isinstance(condition, Mapping):
        stack = [as_test(v) for v in condition.values()]
        while stack:
            test = stack.pop()
            if test.kind == "in":
                yield test
            stack += test.parts
