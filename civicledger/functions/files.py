"""File-level checks as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicledger.functions.archive import ZIP_END_OF_DIRECTORY, ZIP_LOCAL_HEADER, ZIP_TAIL_BYTES, end_record  # noqa: F401

# File kinds of the appropriation data set that are fetched.
ALLOWED_SUFFIXES = ["parquet", "json", "csv", "md"]

# File signatures.
PARQUET_MAGIC = b"PAR1"

def matches_allowed(name: Column, suffixes: list[str] = ALLOWED_SUFFIXES) -> Column:
    """Case-insensitive ``*.suffix`` allow-list."""
    return F.lower(name).rlike(rf"(?s)\.(?:{'|'.join(suffixes)})\z")


def is_hidden(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1).startswith(".git")


def content_sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def parquet_status(head: Column, tail: Column) -> Column:
    """``ok``, or which end of the file lacks the signature."""
    magic = F.lit(PARQUET_MAGIC)
    return (
        F.when(F.coalesce(F.substring(head, 1, 4) != magic, F.lit(True)), "bad_header")
        .when(F.coalesce(F.substring(tail, -4, 4) != magic, F.lit(True)), "truncated")
        .otherwise("ok")
    )


def parquet_footer_status(head: Column, tail: Column, size: Column) -> Column:
    """``ok``, the end that lacks the signature, or ``impossible_footer``: a length that the file has no room for.

    ``tail`` are the last eight bytes at least; before the closing signature they state the length of the footer, which
    lies between the opening signature and these eight.
    """
    digits = F.hex(F.substring(tail, -8, 4))
    length = F.conv(F.concat(*[F.substring(digits, at, 2) for at in (7, 5, 3, 1)]), 16, 10).cast("bigint")
    fits = (F.octet_length(tail) >= 8) & (length > 0) & (length + 12 <= size)
    signed = parquet_status(head, tail)
    return F.when(signed != "ok", signed).when(F.coalesce(fits, F.lit(False)), "ok").otherwise("impossible_footer")


def workbook_status(head: Column, tail: Column) -> Column:
    """``valid``, or why the bytes cannot be a zip-based workbook.

    Weaker than a walk through its directory (``archive_checked``): it looks for the zip signature and for the
    end-of-directory record where it must be, followed by exactly the comment whose length it states. ``tail`` are the
    last ``ZIP_TAIL_BYTES`` bytes, or all.
    """
    signature = F.substring(head, 1, 4) == F.lit(ZIP_LOCAL_HEADER)
    return (
        F.when(~F.coalesce(signature, F.lit(False)), "not_a_zip")
        .when(end_record(tail).isNull(), "no_end_of_directory")
        .otherwise("valid")
    )
