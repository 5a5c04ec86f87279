"""Zip archives by their central directory, as Column expressions over byte ranges of a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicledger.operators.columns import add_once, scanned

# Signatures of the zip format.
ZIP_LOCAL_HEADER = b"PK\x03\x04"
ZIP_DIRECTORY_ENTRY = b"PK\x01\x02"
ZIP_END_OF_DIRECTORY = b"PK\x05\x06"

# A zip's end record is 22 bytes, followed by a comment of at most 65,535 bytes.
ZIP_TAIL_BYTES = 22 + 65535

# Parts without which a workbook can't be opened.
WORKBOOK_PARTS = ("[Content_Types].xml", "xl/workbook.xml")

#: A longer directory is reported, not read.
DIRECTORY_BYTES = 64 << 20


def little_endian(data: Column, at: int | Column, width: int) -> Column:
    """The unsigned number in ``width`` bytes from ``at`` on (0-based); null where the bytes end before."""
    digits = F.hex(F.substring(data, F.lit(at) + 1 if isinstance(at, int) else at + 1, F.lit(width)))
    turned = F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in reversed(range(width))])
    return F.when(F.length(digits) == 2 * width, F.conv(turned, 16, 10).cast("bigint"))


def end_record(tail: Column) -> Column:
    """Where in ``tail`` (the last ``ZIP_TAIL_BYTES`` bytes, or all) the end record stands; null if none fits.

    It must be followed by exactly the comment whose length it states; of several the last one counts.
    """
    pieces = F.split(F.decode(tail, "ISO-8859-1"), ZIP_END_OF_DIRECTORY.decode("latin-1"))

    def step(state: Column, piece: Column) -> Column:
        """``at``: place of the mark in front of the piece, below 0 for the first; ``found``: the last that fits."""
        at = state["at"]
        fits = (at >= 0) & (at + 22 + little_endian(tail, at + 20, 2) == F.octet_length(tail))
        return F.struct((at + 4 + F.length(piece)).alias("at"), F.when(fits, at).otherwise(state["found"]).alias("found"))

    return F.aggregate(pieces, F.struct(F.lit(-4).alias("at"), F.lit(None).cast("int").alias("found")), step)["found"]


def directory_place(tail: Column, size: Column) -> Column:
    """What the end record of a file of ``size`` bytes says: ``end`` (its own place), ``entries``, ``length`` and ``start``."""
    at = end_record(tail)
    number = lambda offset, width: little_endian(tail, at + offset, width)
    return F.struct(
        (size - F.octet_length(tail) + at).cast("bigint").alias("end"),
        number(10, 2).alias("entries"),
        number(12, 4).alias("length"),
        number(16, 4).alias("start"),
    )


def place_status(place: Column) -> Column:
    """What is wrong with a ``directory_place``; null if its directory can be read."""
    return (
        F.when(place["end"].isNull(), "no_end_of_directory")
        .when((place["entries"] == 0xFFFF) | (place["length"] == 0xFFFFFFFF) | (place["start"] == 0xFFFFFFFF), "zip64")
        .when((place["start"] + place["length"] > place["end"]) | (place["entries"] * 46 > place["length"]), "impossible_directory")
        .when(place["length"] > DIRECTORY_BYTES, "directory_too_large")
    )


def directory_entries(directory: Column, count: Column) -> Column:
    """``count`` entries in their order: ``name``, ``first`` and ``end`` byte, and ``after``, where the next one stands.

    Each entry states the lengths that lead to the next one; behind one that is broken all fields are null. Its bytes in
    the archive are at least the local header of 30 bytes, the name and the packed content.
    """

    def step(at: Column, _: Column) -> tuple[Column, Column]:
        head = F.substring(directory, at + 1, F.lit(46))
        name, first = little_endian(head, 28, 2), little_endian(head, 42, 4)
        after = at + 46 + name + little_endian(head, 30, 2) + little_endian(head, 32, 2)
        good = (F.substring(head, 1, 4) == F.lit(ZIP_DIRECTORY_ENTRY)) & (after <= F.octet_length(directory))
        after = F.when(good, after).cast("int")
        one = F.struct(
            F.when(good, F.substring(directory, at + 47, name.cast("int")).cast("string")).alias("name"),
            F.when(good, first).alias("first"),
            F.when(good, first + 30 + name + little_endian(head, 20, 4)).alias("end"),
            after.alias("after"),
        )
        return after, one

    numbers = F.when(count > 0, F.sequence(F.lit(1), count.cast("int"))).otherwise(F.array().cast("array<int>"))
    return scanned(numbers, F.lit(0), step, "struct<name:string,first:bigint,end:bigint,after:int>")


def entries_status(entries: Column, place: Column, parts: tuple[str, ...] = WORKBOOK_PARTS) -> Column:
    """``valid``, or what the ``directory_entries`` show.

    ``broken_directory``: the entries don't fill it exactly; ``overlapping_entries``: two share bytes;
    ``truncated_entries``: one would reach into the directory; ``missing_parts``: a name of ``parts`` isn't there.
    """
    walked = F.coalesce(F.try_element_at(F.transform(entries, lambda e: e["after"]), F.lit(-1)), F.lit(0))
    ordered = F.array_sort(F.transform(entries, lambda e: F.struct(e["first"].alias("first"), e["end"].alias("end"))))
    state = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(False).alias("overlaps"))
    swept = F.aggregate(ordered, state, lambda s, e: F.struct(F.greatest(s["end"], e["end"]).alias("end"), (s["overlaps"] | (e["first"] < s["end"])).alias("overlaps")))
    names = F.transform(entries, lambda e: e["name"])
    return (
        F.when(F.when(F.size(entries) > 0, walked).otherwise(0) != place["length"], "broken_directory")
        .when(swept["overlaps"], "overlapping_entries")
        .when(swept["end"] > place["start"], "truncated_entries")
        .when(F.size(F.array_except(F.array(*map(F.lit, parts)), names)) > 0, "missing_parts")
        .otherwise("valid")
    )


def archive_checked(files: DataFrame, parts: tuple[str, ...] = WORKBOOK_PARTS) -> DataFrame:
    """``files`` without their bytes (``head``, ``tail``, ``place``, ``directory``) and with ``status``; ``error`` goes first."""
    walked = add_once(files, entries=directory_entries(F.col("directory"), F.col("place.entries")))
    signed = F.coalesce(F.substring("head", 1, 4) == F.lit(ZIP_LOCAL_HEADER), F.lit(False))
    status = F.coalesce("error", F.when(~signed, "not_a_zip"), place_status(F.col("place")), entries_status(F.col("entries"), F.col("place"), parts))
    return walked.withColumn("status", status).drop("head", "tail", "place", "directory", "entries", "error")
