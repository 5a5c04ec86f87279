"""Control over where column expressions are evaluated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STRETCH = 256


def add_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns whose expressions are evaluated exactly once per row.

    An ordinary derived column is substituted into the filters and expressions that use it, so a long rule
    chain would run, and be compiled, several times over. A generator's output is not substituted; one that
    always yields a single row costs next to nothing and stays inside whole-stage code generation.
    """
    row = F.struct(*[expression.alias(name) for name, expression in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))


def scanned(items: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]], output: str) -> Column:
    """What a fold over an array emits: ``step(state, item)`` gives the next state and an output of the named type.

    Outputs are gathered by stretches of items, since an array that grows item by item is copied each time.
    """
    empty = F.array().cast(f"array<{output}>")
    pair = lambda state, found: F.struct(state.alias("state"), found.alias("found"))

    def one(held: Column, item: Column) -> Column:
        state, found = step(held["state"], item)
        return pair(state, F.array_append(held["found"], found))

    def stretch(held: Column, part: Column) -> Column:
        own = F.transform(F.array(F.aggregate(part, pair(held["state"], empty), one)), lambda o: pair(o["state"], F.array_append(held["found"], o["found"])))
        return F.get(own, F.lit(0))

    numbers = F.filter(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _STRETCH).cast("int")), lambda i: i * _STRETCH < F.size(items))
    parts = F.transform(numbers, lambda i: F.slice(items, i * _STRETCH + 1, F.lit(_STRETCH)))
    return F.flatten(F.aggregate(parts, pair(start, F.array().cast(f"array<array<{output}>>")), stretch)["found"])
