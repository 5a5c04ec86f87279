"""Columns of an HTML table by the grid of its header, cells spread over rows and columns included."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicledger.functions.text import NBSP, decode_entities, from_index, let, strip_ws

#: What HTML allows a cell to span.
MOST_SPAN = 1000

_ROW_OPEN, _CELL_OPEN = r"(?i)<tr(?=[\s>])", r"(?i)<t[dh](?=[\s>])"
_COLUMN = "struct<free:int,path:array<string>>"


def _span(cell: Column, name: str) -> Column:
    digits = F.regexp_extract(cell, rf"""(?i)^[^>]*?\s{name}\s*=\s*["']?\s*([0-9]{{1,4}})""", 1)
    return F.greatest(F.least(F.coalesce(digits.try_cast("int"), F.lit(1)), F.lit(MOST_SPAN)), F.lit(1))


def _text(cell: Column) -> Column:
    inner = F.regexp_replace(F.regexp_replace(cell, r"^[^>]*>?", ""), r"<[^>]*>", " ")
    return F.regexp_replace(strip_ws(decode_entities(F.replace(inner, F.lit("&nbsp;"), F.lit(NBSP)))), r"[\s\x{A0}]+", " ")


def header_rows(html: Column, first: str, last: str) -> Column:
    """Rows of cells (``text``, ``across``, ``down``), from the row that contains ``first`` to the one with ``last``."""
    before = F.substring_index(html, last, 1)
    ending = F.regexp_extract(F.substr(html, F.length(before) + 1), r"(?is)^.*?(?=<tr[\s>]|\z)", 0)
    rows = F.split(F.concat(before, ending), _ROW_OPEN)
    begun = F.filter(F.sequence(F.lit(0), F.size(rows) - 1), lambda i: F.get(rows, i).contains(first))
    cell = lambda c: F.struct(_text(c).alias("text"), _span(c, "colspan").alias("across"), _span(c, "rowspan").alias("down"))
    wanted = F.slice(rows, F.coalesce(F.get(begun, F.lit(0)), F.size(rows)) + 1, F.size(rows))
    return F.when(html.contains(last), F.transform(wanted, lambda row: F.transform(from_index(F.split(row, _CELL_OPEN), 1), cell)))


def column_paths(rows: Column) -> Column:
    """For each column of the grid the texts of the header cells above it, from the top.

    The cells of a row take the columns that no cell from above spans, in order, each as many as it spans.
    """
    start = F.struct(F.array().cast(f"array<{_COLUMN}>").alias("columns"), F.lit(0).alias("row"))

    def step(state: Column, cells: Column) -> Column:
        columns, row = state["columns"], state["row"]
        units = F.flatten(F.transform(cells, lambda c: F.array_repeat(F.struct(c["text"].alias("text"), (row + c["down"]).alias("free")), c["across"])))

        def placed(units: Column) -> Column:
            every = F.sequence(F.lit(0), F.size(columns) + F.size(units) - 1)
            free = F.filter(every, lambda i: F.coalesce(F.get(columns, i)["free"], F.lit(0)) <= row)
            taken = lambda free: F.slice(F.array_append(free, F.lit(-1)), F.lit(1), F.size(units))

            def column(i: Column, mine: Column) -> Column:
                held = F.struct(F.coalesce(F.get(columns, i)["free"], F.lit(0)).alias("free"), F.coalesce(F.get(columns, i)["path"], F.array().cast("array<string>")).alias("path"))
                unit = F.get(units, F.array_position(mine, i).cast("int") - 1)
                return F.when(F.array_contains(mine, i), F.struct(unit["free"].alias("free"), F.array_append(held["path"], unit["text"]).alias("path"))).otherwise(held)

            def laid(mine: Column) -> Column:
                width = F.greatest(F.size(columns), F.coalesce(F.array_max(mine), F.lit(-1)) + 1)
                return F.struct(F.transform(F.slice(every, F.lit(1), width), lambda i: column(i, mine)).alias("columns"), (row + 1).alias("row"))

            return F.when(F.size(units) == 0, F.struct(columns.alias("columns"), (row + 1).alias("row"))).otherwise(let(taken(free), laid))

        return let(units, placed)

    return F.transform(F.aggregate(rows, start, step)["columns"], lambda c: c["path"])
