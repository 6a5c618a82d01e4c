"""Folds of ordered tokens into columns, as conditional aggregates: one shuffle, with partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def last_write(value: Column, when: Column, order: Column) -> Column:
    """The last value written, a null included: a later null overwrites."""
    return F.max_by(F.struct(value.alias("x")), F.when(when, order))["x"]


def first_write(value: Column, when: Column, order: Column) -> Column:
    """The first value that isn't null."""
    known = when & value.isNotNull()
    return F.min_by(F.struct(value.alias("x")), F.when(known, order))["x"]


def slots(df: DataFrame, keys: Sequence[str], value: str, order: Sequence, size: int, prefix: str) -> DataFrame:
    """The first ``size`` distinct values of each group, in order of first appearance, as columns prefix1, prefix2, ..."""
    w = W.partitionBy(*keys).orderBy(*order)
    seen = df.where(F.col(value).isNotNull()).withColumn("_n", F.row_number().over(w))
    first = seen.groupBy(*keys, value).agg(F.min("_n").alias("_n"))
    placed = first.withColumn("_slot", F.row_number().over(W.partitionBy(*keys).orderBy("_n"))).where(F.col("_slot") <= size)
    return placed.groupBy(*keys).agg(*(F.max(F.when(F.col("_slot") == k, F.col(value))).alias(f"{prefix}{k}") for k in range(1, size + 1)))


def slots_exact(entries: Column, size: int) -> Column:
    """Array of up to ``size`` players of an ordered array of structs (id, name): an entry goes to the first free slot
    unless its id is in an earlier one. An entry without an id takes no slot."""
    empty = F.array().cast("array<struct<id:string,name:string>>")
    return F.aggregate(
        entries, empty,
        lambda filled, e: F.when(
            (F.size(filled) < size) & e["id"].isNotNull() & ~F.exists(filled, lambda f: f["id"] == e["id"]),
            F.concat(filled, F.array(F.struct(e["id"].cast("string").alias("id"), e["name"].cast("string").alias("name"))))
        ).otherwise(filled),
    )


def slots_by_field(entries: str, size: int, fields: Sequence[str]) -> str:
    """Struct of arrays, one for each field, of ``size`` slots filled from an ordered array of structs with ``fields``,
    the first of which identifies the player; Spark SQL, as is ``entries``. Each field goes on by its own: an entry's value goes to the first slot of
    the field that is still null, unless the entry's player is in an earlier player slot; a null value leaves its slot
    free. So fields of one slot can come from different entries, as they do in the feed's own tables."""
    who = fields[0]

    def put(field: str, players: str) -> str:
        free = f"int(array_position(transform(state.{field}, x -> x IS NULL), true))"  # 0: none is free
        taken = f"coalesce(exists(slice({players}, 1, greatest({free} - 1, 0)), x -> x = string(e.{who})), false)"
        return f"""CASE WHEN {free} = 0 OR {taken} THEN state.{field}
          ELSE transform(state.{field}, (x, k) -> CASE WHEN k + 1 = {free} THEN string(e.{field}) ELSE x END) END"""

    rest = ", ".join(f"'{f}', {put(f, 'now')}" for f in fields[1:])
    step = f"transform(array({put(who, f'state.{who}')}), now -> named_struct('{who}', now, {rest}))[0]"
    empty = f"transform(sequence(1, {size}), i -> string(null))"
    return f"aggregate({entries}, named_struct({', '.join(f"'{f}', {empty}" for f in fields)}), (state, e) -> {step})"
