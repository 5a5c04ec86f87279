"""Column helpers for HTML text."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

NBSP = "\u00a0"
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

_ENTITY_OR_TEXT = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);|[^&]+|&"
_NAMED_ENTITIES = json.dumps({name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"})


def first_match(rules: list[tuple[Column, object]], default: Column | None = None) -> Column:
    """One CASE expression: the value of the first rule whose condition holds."""
    chain = F
    for condition, value in rules:
        chain = chain.when(condition, value if isinstance(value, Column) else F.lit(value))
    return chain if default is None else chain.otherwise(default)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def contains_any(col: Column, needles: list[str]) -> Column:
    found = F.lit(False)
    for needle in needles:
        found = found | col.contains(needle)
    return found


def strip_ws(col: Column) -> Column:
    """Trim every kind of Unicode whitespace, no-break spaces included."""
    return F.trim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    return F.when(col != "", col)


def from_index(array: Column, index: int) -> Column:
    """The elements from ``index`` (0-based) on."""
    return F.filter(array, lambda _, i: i >= index)


def _significant(digits: Column) -> Column:
    """Digits without leading zeros; those of a code that no character has are cut to one that is none either."""
    plain = F.regexp_replace(digits, r"^0+(?=.)", "")
    return F.when(F.length(plain) > 7, F.lit("9999999")).otherwise(plain)


def _character(code: Column) -> Column:
    valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")


def decode_entities(col: Column) -> Column:
    """Replace numeric and named character references; unknown names stay as they are."""
    names = F.from_json(F.lit(_NAMED_ENTITIES), "map<string,string>")

    def one(token: Column) -> Column:
        body = F.substring(token, 2, F.length(token) - 2)
        return (
            F.when(token.rlike(r"^&#[0-9]+;$"), _character(_significant(F.substr(body, F.lit(2))).cast("long")))
            .when(
                token.rlike(r"^&#[xX]"),
                _character(F.conv(_significant(F.substr(body, F.lit(3))), 16, 10).cast("long")),
            )
            .when(token.rlike(r"^&.+;$"), F.coalesce(F.try_element_at(names, body), token))
            .otherwise(token)
        )

    tokens = F.regexp_extract_all(col, F.lit(_ENTITY_OR_TEXT), F.lit(0))
    return F.when(col.contains("&"), F.array_join(F.transform(tokens, one), "")).otherwise(col)


def html_text(col: Column) -> Column:
    """Text of an HTML fragment: tags dropped, each text node trimmed, nodes joined."""
    nodes = F.split(col, r"<[^>]*>")
    return F.array_join(F.transform(nodes, lambda node: strip_ws(decode_entities(node))), "")


def without_hidden_markup(html: Column) -> Column:
    """HTML without comments, scripts and styles, whose content is not markup."""
    hidden = html.rlike("(?i)<!--|<script|<style")
    return F.when(hidden, F.regexp_replace(html, r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)", "")).otherwise(html)
