"""Money and rate cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicledger.functions.text import let, strip_ws

MONEY = "decimal(20,2)"
# Printed numbers of up to 30 digits; scaled by a thousand and summed they still fit a decimal.
WHOLE = "decimal(30,0)"
SCALED = "decimal(38,2)"

_PLAIN = r"(?:[0-9]{1,3}(?:,[0-9]{3})*|[0-9]+)"
_NUMBER = rf"^(?:-?{_PLAIN}|\({_PLAIN}\))$"
_NOTHING = r"^[\-\s\x{A0}]*$"


def exact(col: Column, kind: str = "decimal(12,2)") -> Column:
    """A binary floating amount as a decimal, so sums do not depend on their order."""
    return col.cast(kind)


def cell_is_blank(raw: Column) -> Column:
    return F.coalesce(strip_ws(raw) == "", F.lit(True))


def parse_amount(cell: Column, kind: str = WHOLE) -> Column:
    """Whole number of a trimmed cell; null if it is missing, unreadable or has more digits than ``kind``."""
    sign = F.when(cell.startswith("-") | cell.startswith("("), "-").otherwise("")
    value = F.concat(sign, F.translate(cell, "-(),", "")).try_cast(kind)
    return F.when(cell.rlike(_NOTHING), F.lit(0).cast(kind)).when(cell.rlike(_NUMBER), value)


def clean_amount(raw: Column, kind: str = WHOLE) -> Column:
    """Whole number of a statement cell; dashes and blanks are zero, missing and unreadable cells are null."""
    return let(strip_ws(raw), lambda cell: parse_amount(cell, kind))


def is_quarantined(raw: Column) -> Column:
    """Neither a number that an amount can hold nor a recognised way to write zero."""
    return clean_amount(raw).isNull()


def clean_rate(raw: Column, kind: str = "decimal(30,2)") -> Column:
    """Percentage of a rate cell; a comma may stand for the decimal point."""
    cell = F.regexp_replace(strip_ws(raw), r"\s*%$", "")
    pointed = F.regexp_replace(cell, r"^(-?[0-9]+),([0-9]{1,2})$", "$1.$2")
    return F.regexp_replace(pointed, ",", "").try_cast(kind)
