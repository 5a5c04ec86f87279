"""JSON inside a text column, judged and walked by structure.

No parser with limits is involved: sizes, nesting and repeated keys are of no matter. What counts as JSON is the
grammar of RFC 8259 (plus the literals NaN and Infinity, which many writers emit) over the whole text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicledger.functions.text import let

# Possessive quantifiers keep matching iterative, so long strings and lists cannot exhaust the stack.
_STRING = r'"[^"\\\x00-\x1F]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1F]*+)*+"'
_SCALAR = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+\-]?[0-9]++)?+|true|false|null|NaN|-?Infinity"
_CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
_BLANKS = r"[ \t\r\n]+"

# In the skeleton of a text every string is one mark, every other scalar and every closed container another.
_TEXT, _VALUE = "\u0001", "\u0002"
_ANY = f"[{_TEXT}{_VALUE}]"
_CLOSED = rf"\{{(?:{_TEXT}:{_ANY}(?:,{_TEXT}:{_ANY})*+)?+\}}|\[(?:{_ANY}(?:,{_ANY})*+)?+\]"

_TOKEN = rf'{_STRING}[ \t\r\n]*+:?+|[{{}}\[\],]|[^\s"{{}}\[\],:]++'
_FRAME = "struct<prefix:string,index:int>"
_FOUND = "struct<path:string,value:string>"
_TOKENS_A_STRETCH = 256


def _skeleton(text: Column) -> Column:
    marked = F.regexp_replace(F.regexp_replace(text, _STRING, _TEXT), _SCALAR, _VALUE)
    return F.regexp_replace(marked, _BLANKS, "")


def is_json(text: Column) -> Column:
    """Is the whole text one JSON value?

    Strings and scalars become marks; then all innermost containers that are well formed become one mark each, level
    by level, until a single mark is left (JSON) or nothing changes (not JSON).
    """

    def closed(skeleton: Column) -> Column:
        levels = F.length(F.regexp_replace(skeleton, r"[^\[{]", ""))
        start = F.struct(skeleton.alias("text"), F.lit(True).alias("goes_on"))

        def step(state: Column, _: Column) -> Column:
            once = let(F.regexp_replace(state["text"], _CLOSED, _VALUE), lambda t: F.struct(t.alias("text"), (t != state["text"]).alias("goes_on")))
            return F.when(state["goes_on"] & (F.length(state["text"]) > 1), once).otherwise(state)

        return F.when(levels == 0, skeleton).otherwise(F.aggregate(F.sequence(F.lit(1), levels), start, step)["text"])

    return ~text.rlike(_CONTROL) & let(_skeleton(text), closed).isin(_TEXT, _VALUE)


def json_string(literal: Column) -> Column:
    """The text that a JSON string literal stands for."""
    escaped = F.get_json_object(F.concat(F.lit("["), literal, F.lit("]")), "$[0]")
    return F.when(literal.contains("\\"), escaped).otherwise(F.substring(literal, F.lit(2), F.length(literal) - 2))


def json_scalars(text: Column) -> Column:
    """Every scalar of a JSON text as an array of (path, value) in order; null if the text is not JSON.

    A fold over the tokens with a stack of the open objects and arrays, each with the path that leads to it and, in an
    array, the place reached. Paths look like ``$["key"][0]``, with keys as they are written. Strings are decoded,
    other scalars stay as written; a repeated key gives a path several times. Found scalars are gathered by stretches
    of tokens, so that long texts don't copy what has been found for every token.
    """
    empty = F.array().cast(f"array<{_FOUND}>")
    top = lambda s: F.try_element_at(s["stack"], F.lit(-1))
    state = lambda stack, at, found: F.struct(stack.alias("stack"), at.alias("at"), found.alias("found"))
    frame = lambda prefix, index: F.struct(prefix.alias("prefix"), F.lit(index).cast("int").alias("index"))

    def step(s: Column, token: Column) -> Column:
        outer = F.slice(s["stack"], F.lit(1), F.size(s["stack"]) - 1)
        place = top(s)["index"] + 1
        moved = F.struct(top(s)["prefix"].alias("prefix"), place.alias("index"))
        key = F.regexp_replace(token, r"[ \t\r\n]*:\z", "")
        value = F.when(token.startswith('"'), json_string(token)).otherwise(token)
        scalar = F.struct(s["at"].alias("path"), value.alias("value"))
        return (
            F.when(token.endswith(":") & token.startswith('"'), state(s["stack"], F.concat(top(s)["prefix"], F.lit("["), key, F.lit("]")), s["found"]))
            .when(token == "{", state(F.array_append(s["stack"], frame(s["at"], -1)), s["at"], s["found"]))
            .when(token == "[", state(F.array_append(s["stack"], frame(s["at"], 0)), F.concat(s["at"], F.lit("[0]")), s["found"]))
            .when(token.isin("}", "]"), state(outer, s["at"], s["found"]))
            .when((token == ",") & (top(s)["index"] < 0), s)
            .when(token == ",", state(F.array_append(outer, moved), F.concat(top(s)["prefix"], F.lit("["), place.cast("string"), F.lit("]")), s["found"]))
            .otherwise(state(s["stack"], s["at"], F.array_append(s["found"], scalar)))
        )

    def stretch(s: Column, tokens: Column) -> Column:
        own = F.aggregate(tokens, state(s["stack"], s["at"], empty), step)
        return let(own, lambda o: state(o["stack"], o["at"], F.array_append(s["found"], o["found"])))

    def walk(tokens: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(tokens) - 1) / _TOKENS_A_STRETCH).cast("int"))
        stretches = F.transform(starts, lambda i: F.slice(tokens, i * _TOKENS_A_STRETCH + 1, F.lit(_TOKENS_A_STRETCH)))
        start = state(F.array().cast(f"array<{_FRAME}>"), F.lit("$"), F.array().cast(f"array<array<{_FOUND}>>"))
        return F.flatten(F.aggregate(stretches, start, stretch)["found"])

    return F.when(is_json(text), let(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), walk))
