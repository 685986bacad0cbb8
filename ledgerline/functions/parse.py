"""Scalar functions that read raw text and file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.spec import BLANK, DATE, FLAG
from ledgerline.spec import Column as SpecColumn

#: Download stamp before the extension, month of the folder (fixed path format).
STAMP_PATTERN = r"_(\d{8}_\d{4})\.[^./]+$"
MONTH_PATTERN = r"year_month=([^/]+)/"

#: A snapshot delivered as a folder of parts: the part name is not part of it.
PART_PATTERN = r"(_\d{8}_\d{4}\.[^./]+)/[^/]+$"

STAMP_FORMAT = "yyyyMMdd_HHmm"


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def parse_date(value: Column) -> Column:
    """Day.month.year text to a date; any other text fails under ANSI."""
    return F.to_date(value, "d.M.yyyy")


def parse_flag(value: Column) -> Column:
    return value == F.lit("Y")


def typed(column: SpecColumn) -> Column:
    """Typed value of a raw text column, under its own name."""
    raw = F.col(f"`{column.name}`")
    if column.parse == DATE:
        value = parse_date(raw)
    elif column.parse == FLAG:
        value = parse_flag(raw)
    elif column.parse == BLANK:
        value = blank_to_null(raw).cast(column.type)
    else:
        value = raw.cast(column.type)
    return value.alias(column.name)


def typed_or_null(column: SpecColumn) -> tuple[Column, Column]:
    """Typed value of a raw text column, NULL where the text is not of the type, and whether that is so."""
    raw = F.col(f"`{column.name}`")
    if column.parse == FLAG:
        return parse_flag(raw).alias(column.name), ~F.coalesce(raw, F.lit("")).isin("Y", "N")
    if column.parse == DATE:
        value = F.try_to_date(raw, "d.M.yyyy")
    else:
        raw = blank_to_null(raw) if column.parse == BLANK else raw
        value = raw.try_cast(column.type)
    return value.alias(column.name), raw.isNotNull() & value.isNull()


def snapshot_path(path: Column) -> Column:
    """Path of the snapshot a file belongs to: itself, or its folder of parts."""
    return F.regexp_replace(path, PART_PATTERN, "$1")


def file_stamp(path: Column) -> Column:
    """Download stamp ``YYYYMMDD_HHmm`` at the end of a file name."""
    return F.regexp_extract(path, STAMP_PATTERN, 1)


def file_month(path: Column) -> Column:
    """Text of the ``year_month=`` folder."""
    return F.regexp_extract(path, MONTH_PATTERN, 1)


def stamp_time(stamp: Column) -> Column:
    """Instant of a download stamp, which is always UTC."""
    return F.to_timestamp(F.concat(stamp, F.lit(" +0000")), f"{STAMP_FORMAT} Z")


def time_stamp(instant: Column) -> Column:
    """Download stamp of an instant (session time zone UTC)."""
    return F.date_format(instant, STAMP_FORMAT)
