"""Conversion of values and checks of text."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import JSON_TYPES, TableSpec

#: Integers beyond it lose digits as doubles.
SAFE_INTEGER = 2**53 - 1


def json_text(column: str, kind: T.DataType) -> Column:
    """The JSON text of a column; null stays null."""
    c = F.col(f"`{column}`")
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(c)
    return F.to_json(c.cast("variant"))


def serialized(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """rows with its json columns as JSON text, and json array columns as arrays of JSON text."""
    out = []
    for f in rows.schema.fields:
        name = spec[f.name].type_name.lower()
        if name in JSON_TYPES:
            out.append(json_text(f.name, f.dataType).alias(f.name))
        elif name.removeprefix("_").removesuffix("[]") in JSON_TYPES and isinstance(f.dataType, T.ArrayType):
            nested = isinstance(f.dataType.elementType, (T.StructType, T.ArrayType, T.MapType))
            out.append(F.transform(f"`{f.name}`", lambda x, n=nested: F.to_json(x) if n else F.to_json(x.cast("variant"))).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return rows.select(*out)


def big_integer(column: Column, mode: str) -> Column:
    """mode: bigint (exact), string, or number (a double)."""
    return column.cast({"bigint": "bigint", "string": "string", "number": "double"}[mode])


def loses_digits(column: Column) -> Column:
    return F.abs(column.cast("decimal(20,0)")) > SAFE_INTEGER


def tiny_integer(column: Column, mode: str = "boolean") -> Column:
    return column != 0 if mode == "boolean" else column


def date_text(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def time_text(column: Column, digits: int = 0) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss" + ("." + "S" * digits if digits else ""))


def between_zones(column: Column, server: str, client: str) -> Column:
    """A time without zone that the server means in its zone, as the client's clock shows it; the day can change."""
    return F.convert_timezone(F.lit(server), F.lit(client), column.cast("timestamp_ntz"))


def _split(text: str | None, opening: str, closing: str, doubled: bool) -> list[str | None] | None:
    """Items between the brackets. Quoted items may hold commas and brackets; a backslash takes the next character as
    it is, and where `doubled`, so does a quote before a quote. An array has no items between bare brackets."""
    if text is None or len(text) < 2 or text[0] != opening or text[-1] != closing:
        return None
    body = text[1:-1]
    if '"' not in body and "\\" not in body and "{" not in body:
        if not body and not doubled:
            return []
        return [None if (not x if doubled else x.strip().upper() == "NULL") else x if doubled else x.strip() for x in body.split(",")]
    out, item, quoted, was_quoted, depth, k = [], [], False, False, 0, 0
    while k <= len(body):
        ch = body[k] if k < len(body) else None
        if ch is None or ch == "," and not quoted and not depth:
            raw = "".join(item)
            empty = not raw if doubled else raw.strip().upper() == "NULL"
            out.append(raw if was_quoted else None if empty else raw if doubled else raw.strip())
            item, was_quoted = [], False
        elif ch == "\\" and k + 1 < len(body) and not depth:
            k += 1
            item.append(body[k])
        elif ch == '"' and depth:
            quoted = not quoted
            item.append(ch)
        elif ch == '"':
            if quoted and doubled and body[k + 1 : k + 2] == '"':
                item.append(ch)
                k += 1
            else:
                quoted, was_quoted = not quoted, True
        else:
            if not doubled and not quoted:
                depth += (ch == "{") - (ch == "}")
            item.append(ch)
        k += 1
    return out


def parse_composite(column: Column) -> Column:
    """`(a,"b, c",)` as an array of texts; an item that is not there is null. Text of another shape gives null."""
    return _udf_of("(", ")", True)(column)


def parse_array(column: Column, item: Callable[[Column], Column] | None = None) -> Column:
    """`{a,NULL,"x,y"}` as an array; item converts each. An inner array stays text, to be parsed by item."""
    parsed = _udf_of("{", "}", False)(column)
    return F.transform(parsed, item) if item else parsed


def _udf_of(opening: str, closing: str, doubled: bool):
    def parse(texts: pd.Series) -> pd.Series:
        return pd.Series([_split(x, opening, closing, doubled) for x in texts], dtype=object)

    return F.pandas_udf(parse, T.ArrayType(T.StringType()))


def valid_text(column: Column) -> Column:
    """Whether bytes are valid UTF-8; null is not."""
    return F.coalesce(F.is_valid_utf8(column), F.lit(False))


def asserted_text(column: Column) -> Column:
    """The text, or an error when the job meets an invalid one."""
    return F.validate_utf8(column)


def repaired_text(column: Column) -> Column:
    """Bytes as text: encoded surrogates are joined in pairs, and each single one becomes one U+FFFD. Valid rows are
    not sent to Python's decoder."""

    def repair(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else bytes(v).decode("utf-8", "surrogatepass").encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace") for v in values], dtype=object)

    broken = F.when(~F.is_valid_utf8(column), column)
    return F.when(F.is_valid_utf8(column), column.cast("string")).otherwise(F.pandas_udf(repair, "string")(broken))


def typed(rows: DataFrame, spec: TableSpec, parsers: Mapping[str, Callable[[Column], Column]] | None = None, reasons: str = "reasons") -> DataFrame:
    """Text columns as their declared types; `reasons` names the columns whose text doesn't fit (their value is null).

    parsers: own conversions by type name, which take the place of the built-in one for every column of that type.
    """
    out, bad = [], []
    for c in spec.columns:
        if c.name not in rows.columns:
            continue
        text = F.col(f"`{c.name}`")
        own = (parsers or {}).get(c.type_name.lower())
        value = own(text) if own else text.try_cast(c.type)
        out.append(value.alias(c.name))
        bad.append(F.when(text.isNotNull() & value.isNull(), F.lit(c.name)))
    return rows.select(*out, F.array_compact(F.array(*bad)).alias(reasons))
