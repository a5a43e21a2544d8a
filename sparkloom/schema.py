"""Table descriptions: columns, types, defaults, required columns and keys."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Database type names and the Spark types that hold them.
TYPES: dict[str, T.DataType] = {
    "bool": T.BooleanType(), "boolean": T.BooleanType(),
    "int2": T.ShortType(), "smallint": T.ShortType(), "tinyint": T.ByteType(),
    "int4": T.IntegerType(), "int": T.IntegerType(), "integer": T.IntegerType(), "mediumint": T.IntegerType(), "serial": T.IntegerType(),
    "int8": T.LongType(), "bigint": T.LongType(), "int64": T.LongType(), "bigserial": T.LongType(),
    "float4": T.FloatType(), "real": T.FloatType(), "float": T.FloatType(),
    "float8": T.DoubleType(), "double": T.DoubleType(), "double precision": T.DoubleType(), "float64": T.DoubleType(),
    "numeric": T.DecimalType(38, 9), "decimal": T.DecimalType(38, 9),
    "text": T.StringType(), "varchar": T.StringType(), "bpchar": T.StringType(), "char": T.StringType(), "string": T.StringType(), "citext": T.StringType(), "uuid": T.StringType(), "enum": T.StringType(),
    "bytea": T.BinaryType(), "blob": T.BinaryType(), "bytes": T.BinaryType(),
    "date": T.DateType(),
    "timestamptz": T.TimestampType(),
    "timestamp": T.TimestampNTZType(), "datetime": T.TimestampNTZType(),
    "time": T.StringType(), "timetz": T.StringType(),
    "json": T.StringType(), "jsonb": T.StringType(),
}
JSON_TYPES = {"json", "jsonb"}


class BulkNeedsSchema(ValueError):
    """A bulk job was asked of a table without a description."""


def spark_type(name: str) -> T.DataType:
    """The Spark type of a database type name: `_int4` and `int4[]` are arrays, `numeric(10,2)` has its digits.

    Unknown names (network addresses, ranges, geometry) are text. More than 38 digits don't fit and raise.
    """
    name = name.strip().lower()
    if name.startswith("_") or name.endswith("[]"):
        return T.ArrayType(spark_type(name.removeprefix("_").removesuffix("[]")))
    base, _, digits = name.partition("(")
    if digits and base.strip() in ("numeric", "decimal"):
        precision, _, scale = digits.rstrip(")").partition(",")
        if int(precision) > 38:
            raise ValueError(f"{name} has more than 38 digits; declare it as text")
        return T.DecimalType(int(precision), int(scale or 0))
    return TYPES.get(base.strip(), T.StringType())


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type_name: str
    nullable: bool = True
    has_default: bool = False
    default: Any = None  # a value, a Column, or a function that makes a Column

    @property
    def type(self) -> T.DataType:
        return spark_type(self.type_name)

    @property
    def required(self) -> bool:
        return not self.nullable and not self.has_default

    def default_column(self) -> Column:
        value = self.default() if callable(self.default) and not isinstance(self.default, Column) else self.default
        return (value if isinstance(value, Column) else F.lit(value)).cast(self.type)


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = field(default=())

    def __getitem__(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"{self.name} has no column {name}")

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def keys(self) -> list[tuple[str, ...]]:
        return [k for k in (self.primary_key, *self.unique) if k]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, c.nullable) for c in self.columns])


def read_schema(text: str, keys: Mapping[str, Sequence[str]] | None = None, defaults: Mapping[str, Mapping[str, Any]] | None = None) -> dict[str, TableSpec]:
    """Tables of a schema.json: a list of {name, columns: [{name, isNullable, hasDefault, typeName}]}."""
    found = {}
    for table in json.loads(text):
        own = (defaults or {}).get(table["name"], {})
        columns = tuple(ColumnSpec(c["name"], c.get("typeName", "text"), c["isNullable"], c["hasDefault"], own.get(c["name"])) for c in table["columns"])
        found[table["name"]] = TableSpec(table["name"], columns, tuple((keys or {}).get(table["name"], ())))
    return found


def spec_of(name: str, struct: T.StructType, primary_key: Sequence[str] = (), unique: Sequence[Sequence[str]] = (), required: Sequence[str] = (), defaults: Mapping[str, Any | Callable[[], Column]] | None = None) -> TableSpec:
    """A description of a table that Spark already knows."""
    defaults = defaults or {}
    names = {"bigint": "int8", "int": "int4", "smallint": "int2", "tinyint": "tinyint", "timestamp": "timestamptz", "timestamp_ntz": "timestamp"}
    columns = tuple(
        ColumnSpec(f.name, names.get(f.dataType.simpleString(), f.dataType.simpleString()), f.name not in required, f.name in defaults, defaults.get(f.name)) for f in struct.fields
    )
    return TableSpec(name, columns, tuple(primary_key), tuple(map(tuple, unique)))
