"""Writes as table transforms. Each returns a Change: the new table and the rows that a RETURNING clause would give.

A join with the changes is one shuffle on the key of each side; Spark broadcasts a small batch by its own size rule.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans import predicates as P
from ..schema import BulkNeedsSchema, TableSpec
from ..storage import settled
from .components import components
from . import joins
from .table import filtered


@dataclass(frozen=True)
class Change:
    table: DataFrame
    returning: DataFrame


class DuplicateKeys(ValueError):
    """A batch holds a key twice and no order says which row counts."""


def _q(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _fail_if(found: Column, message: str) -> Column:
    return F.when(found, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))


def completed(records: DataFrame, spec: TableSpec, present: str | None = None) -> DataFrame:
    """records in the table's columns. A column that is not there takes its default; so does one that the array
    column `present` of a record does not name. A required column that is missing raises."""
    missing = [c for c in spec.required if c not in records.columns]
    if missing:
        raise ValueError(f"{spec.name}: required columns are missing: {', '.join(missing)}")
    out = []
    for c in spec.columns:
        if c.name not in records.columns:
            value = c.default_column()
        elif present:
            value = F.when(F.array_contains(present, c.name), F.col(f"`{c.name}`").cast(c.type)).otherwise(c.default_column())
        else:
            value = F.col(f"`{c.name}`").cast(c.type)
        out.append(value.alias(c.name))
    return records.select(*out)


def insert(table: DataFrame, records: DataFrame, spec: TableSpec, present: str | None = None) -> Change:
    """Appends records; columns that they lack take defaults."""
    new = completed(records, spec, present).select(*_q(table.columns))
    return Change(table.unionByName(new), new)


def bulk_insert(table: DataFrame, records: DataFrame, columns: Sequence[str], spec: TableSpec | None) -> Change:
    """Appends the listed and the required columns; a listed one that records lack is null, an unlisted one its default.
    A null in a column that may not be null raises when the job runs."""
    if spec is None:
        raise BulkNeedsSchema("bulk_insert needs a TableSpec")
    listed = sorted({*columns, *spec.required})
    rows = records.select(*[F.col(f"`{c}`") if c in records.columns else F.lit(None).cast(spec[c].type).alias(c) for c in listed])
    new = completed(rows, spec)
    broken = F.lit(False)
    for c in spec.columns:
        if not c.nullable:
            broken = broken | F.col(f"`{c.name}`").isNull()
    new = new.where(_fail_if(broken, f"{spec.name}: null in a column that may not be null")).select(*_q(table.columns))
    return Change(table.unionByName(new), new)


def _first_of_key(rows: DataFrame, key: Sequence[str], position: str) -> DataFrame:
    """The first row of each key; rows with a null in the key all stay."""
    n = F.row_number().over(Window.partitionBy(*_q(key)).orderBy(position))
    null = F.greatest(*[F.col(f"`{k}`").isNull() for k in key], F.lit(False))
    whole = rows.where(~null).withColumn("_n", n).where("_n = 1").drop("_n")
    return whole.unionByName(rows.where(null))


def insert_or_ignore(table: DataFrame, records: DataFrame, keys: Sequence[Sequence[str]], position: str) -> Change:
    """Appends the records that clash with no unique key of the table or of an earlier record that was appended.

    One key: the first record of each key, less those in the table. Several: see _settled, which runs jobs.
    """
    free = records
    for key in keys:
        whole = table.select(*_q(key)).dropna("any").distinct()
        free = free.join(whole, list(key), "left_anti").select(*_q(records.columns))
    if len(keys) == 1:
        new = _first_of_key(free, keys[0], position)
    else:
        new = _settled(free, keys, position)
    new = new.select(*_q(table.columns))
    return Change(table.unionByName(new), new)


#: Records that are the first of all their keys are settled together in so many rounds; the rest is then settled in order.
ROUNDS = 3


def _settled(rows: DataFrame, keys: Sequence[Sequence[str]], position: str) -> DataFrame:
    """The records that are appended, whatever the order and length of chains of linked records.

    A record that is the first open one of each of its keys is in, and those that share a key with it are out. What a few such rounds leave open is dealt by
    component of linked records and gone through in order; a task keeps the keys of one component's appended records. position is unlike in all records.
    """
    at = F.col(f"`{position}`").cast("long").alias("_at")
    columns = sorted({c for key in keys for c in key})
    open_ = settled(rows.select(at, *_q(columns)))
    heads = [f"_head{i}" for i in range(len(keys))]
    kept = open_.select("_at").limit(0)
    for _ in range(ROUNDS):
        if open_.isEmpty():
            break
        marked = settled(_with_heads(open_, keys, heads))
        first = F.lit(True)
        for head in heads:
            first = first & F.coalesce(F.col(head) == F.col("_at"), F.lit(True))
        rest = marked.where(~first)
        for head in heads:
            rest = rest.join(marked.where(first & F.col(head).isNotNull()).select(head), head, "left_anti")
        kept = kept.unionByName(marked.where(first).select("_at"))
        open_ = settled(rest.select("_at", *_q(columns)))
    if not open_.isEmpty():
        marked = settled(_with_heads(open_, keys, heads))
        links = None
        for head in heads:
            own = marked.where(F.col(head) != F.col("_at")).select(F.col(head).alias("a"), F.col("_at").alias("b"))
            links = own if links is None else links.unionByName(own)
        label = F.coalesce("component", "_at").alias("_label")
        linked = marked.join(components(links), F.col("node") == F.col("_at"), "left").select(label, "_at", *heads)
        ordered = linked.repartition("_label").sortWithinPartitions("_label", "_at")
        kept = kept.unionByName(settled(ordered.mapInPandas(lambda it: _in_order(it, heads), "_at long")))
    return rows.join(kept, F.col(f"`{position}`").cast("long") == F.col("_at"), "left_semi")


def _with_heads(rows: DataFrame, keys: Sequence[Sequence[str]], heads: Sequence[str]) -> DataFrame:
    """rows with the first position of each key, null where a part of the key is null."""
    for key, head in zip(keys, heads, strict=True):
        rows = rows.join(rows.groupBy(*_q(key)).agg(F.min("_at").alias(head)), list(key), "left")
    return rows


def _in_order(batches: Iterator[pd.DataFrame], heads: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Positions of the records that share no key with an earlier one that is kept. A key is told by its first position."""
    label, taken = None, [set() for _ in heads]
    for batch in batches:
        out = []
        own = [batch[h].astype("Int64").array for h in heads]
        for i, (one, at) in enumerate(zip(batch["_label"].tolist(), batch["_at"].tolist(), strict=True)):
            if one != label:
                label, taken = one, [set() for _ in heads]
            values = [column[i] for column in own]
            if not any(v is not pd.NA and v in seen for v, seen in zip(values, taken, strict=True)):
                out.append(at)
                for v, seen in zip(values, taken, strict=True):
                    if v is not pd.NA:
                        seen.add(v)
        yield pd.DataFrame({"_at": pd.array(out, dtype="int64")})


def _once(batch: DataFrame, key: Sequence[str], order: Sequence[Column] | None) -> DataFrame:
    """One row for each key: the first in order, or an error if a key comes twice and there is no order."""
    window = Window.partitionBy(*_q(key))
    if order:
        return batch.withColumn("_n", F.row_number().over(window.orderBy(*order))).where("_n = 1").drop("_n")
    twice = (F.count("*").over(window) > 1) & ~F.greatest(*[F.col(f"`{k}`").isNull() for k in key], F.lit(False))
    return batch.withColumn("_ok", _fail_if(twice, "a key comes twice in the batch; give tie_break")).where("_ok").drop("_ok")


def upsert(table: DataFrame, records: DataFrame, key: Sequence[str], update: Sequence[str] | None = None, keep: Sequence[str] = (), tie_break: Sequence[Column] | None = None) -> Change:
    """Appends new keys and overwrites the columns `update` (all of records' by default, less `keep`) of known ones.

    Records with a null in the key are always appended. A key twice in the batch raises without tie_break.
    """
    chosen = [c for c in (update if update is not None else records.columns) if c not in keep and c not in key]
    new = _once(records, key, tie_break).select(*[F.col(f"`{c}`").alias(f"_new_{c}") for c in table.columns], F.lit(True).alias("_new"))
    old = table.withColumn("_old", F.lit(True))
    on = F.lit(True)
    for k in key:
        on = on & (old[k] == new[f"_new_{k}"])
    joined = old.join(new, on, "full_outer")
    there, fresh = F.coalesce("_old", F.lit(False)), F.coalesce("_new", F.lit(False))
    columns = []
    for c in table.columns:
        replaced = fresh if c in chosen else fresh & ~there
        columns.append(F.when(replaced, F.col(f"`_new_{c}`")).otherwise(F.col(f"`{c}`")).alias(c))
    out = joined.select(*columns, fresh.alias("_changed"))
    return Change(out.drop("_changed"), out.where("_changed").drop("_changed"))


def bulk_upsert(table: DataFrame, records: DataFrame, columns: Sequence[str], key: Sequence[str], update: Sequence[str], spec: TableSpec, tie_break: Sequence[Column] | None = None) -> Change:
    listed = sorted({*columns, *spec.required})
    rows = completed(records.select(*[c for c in listed if c in records.columns]), spec)
    return upsert(table, rows, key, update, (), tie_break)


def _flagged(table: DataFrame, condition: P.Condition) -> DataFrame:
    """table with a column _hit: whether the condition is true. A sub-query is a left join on its distinct keys."""
    names: list[str] = []
    wide = table

    def members(column: Column, test: P.Test) -> Column:
        nonlocal wide
        names.append(f"_member{len(names)}")
        wide = joins.member_flag(wide, column, test.value, names[-1])
        return F.col(names[-1])

    found = P.known(condition, members=members)
    hit = F.lit(found) if isinstance(found, bool) else F.coalesce(found, F.lit(False))
    return wide.withColumn("_hit", hit).drop(*names)


def update(table: DataFrame, condition: P.Condition, values: Mapping[str, Any]) -> Change:
    """Sets constants (or Columns) in the rows for which the condition is true."""
    kinds = {f.name: f.dataType for f in table.schema.fields}
    flagged = _flagged(table, condition)
    out = flagged.select(*[F.when(F.col("_hit"), (values[c] if isinstance(values[c], Column) else F.lit(values[c])).cast(kinds[c])).otherwise(F.col(f"`{c}`")).alias(c) if c in values else F.col(f"`{c}`") for c in table.columns], "_hit")
    return Change(out.drop("_hit"), out.where("_hit").drop("_hit"))


def bulk_update(table: DataFrame, updates: DataFrame, where: Mapping[str, str], set_: Mapping[str, str], tie_break: Sequence[Column] | None = None) -> Change:
    """Sets columns to other values for each key tuple, in one pass. where and set_ name, for columns of table, the
    columns of updates. A column may be in both: old values are matched, new ones are written, and a new null counts."""
    batch = _once(updates, list(where.values()), tie_break).dropna("any", subset=list(where.values()))
    right = batch.select(*[F.col(f"`{u}`").alias(f"_where_{t}") for t, u in where.items()], *[F.col(f"`{u}`").alias(f"_set_{t}") for t, u in set_.items()], F.lit(True).alias("_hit"))
    on = F.lit(True)
    for t in where:
        on = on & (table[t] == right[f"_where_{t}"])
    joined = table.join(right, on, "left")
    hit = F.coalesce("_hit", F.lit(False))
    kinds = {f.name: f.dataType for f in table.schema.fields}
    out = joined.select(*[F.when(hit, F.col(f"`_set_{c}`").cast(kinds[c])).otherwise(F.col(f"`{c}`")).alias(c) if c in set_ else F.col(f"`{c}`") for c in table.columns], hit.alias("_changed"))
    return Change(out.drop("_changed"), out.where("_changed").drop("_changed"))


def delete(table: DataFrame, condition: P.Condition) -> Change:
    """Drops the rows for which the condition is true; an empty condition drops all."""
    flagged = _flagged(table, condition)
    return Change(flagged.where("NOT _hit").drop("_hit"), flagged.where("_hit").drop("_hit"))


def delete_where_in(table: DataFrame, condition: P.Condition, key: Sequence[str]) -> Change:
    """As delete, for conditions with sub-queries; key tells rows apart."""
    gone = filtered(table, condition)
    return Change(table.join(gone.select(*_q(key)).distinct(), list(key), "left_anti").select(*_q(table.columns)), gone)


def bulk_delete(table: DataFrame, conditions: DataFrame, columns: Sequence[str]) -> Change:
    """Drops the rows that match any key tuple; rows with a null in the key stay."""
    keys = conditions.select(*_q(columns)).dropna("any").distinct()
    return Change(table.join(keys, list(columns), "left_anti").select(*_q(table.columns)), table.join(keys, list(columns), "left_semi").select(*_q(table.columns)))


def draw_ids(rows: DataFrame, key: Sequence[str], taken: DataFrame, bits: int = 63, seed: int = 0, rounds: int = 20) -> DataFrame:
    """rows with a column `id` of pseudo-random numbers under 2**bits, unlike each other and those of the only column of taken.

    An id is a hash of the row's key, the seed and the round, so a task that runs again draws the same. Only rows that clash
    draw again; of rows that clash with each other the smallest key keeps its id. Each round is a checkpoint.
    """
    known = taken.toDF("id").distinct()
    waiting, done = rows, None
    for k in range(rounds):
        drawn = waiting.withColumn("id", F.shiftrightunsigned(F.xxhash64(*_q(key), F.lit(seed), F.lit(k)), 64 - bits))
        first = drawn.withColumn("_n", F.row_number().over(Window.partitionBy("id").orderBy(*_q(key))))
        used = known if done is None else known.unionByName(done.select("id"))
        marked = settled(first.join(used.withColumn("_used", F.lit(True)), "id", "left"))
        good = marked.where("_n = 1 AND _used IS NULL").select(*_q(rows.columns), "id")
        done = good if done is None else done.unionByName(good)
        waiting = marked.where("_n > 1 OR _used").select(*_q(rows.columns))
        if waiting.isEmpty():
            return done
    raise RuntimeError(f"ids still clash after {rounds} rounds; use more bits")
