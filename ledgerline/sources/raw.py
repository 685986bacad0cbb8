"""Raw layer: text snapshots exactly as received.

    <root>/<source>/<table>/year_month=<YYYY-MM>/<table>_<YYYYMMDD_HHmm>.csv

A large export may be a folder of that name with its parts in it, each with
the header line.
"""

from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.parse import file_month, file_stamp, snapshot_path, stamp_time
from ledgerline.sources import quoted
from ledgerline.sources.files import head_of, listing, parts_of
from ledgerline.sources.quoted import first_record
from ledgerline.spec import RAW_FILENAME, RAW_TIMESTAMP, RAW_YEAR_MONTH, DatasetSpec

# Quoting of the export format.
_CSV = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}

#: Bytes that are read first to find a header, and files that are asked at once.
HEAD_BYTES, HEADS_AT_ONCE = 1 << 16, 16
_PATH = "___path"


def folder(root: str, spec: DatasetSpec) -> str:
    return f"{root.rstrip('/')}/{spec.source}/{spec.table}"


def snapshot_files(spark: SparkSession, root: str, spec: DatasetSpec, pattern: str = "*.csv") -> DataFrame:
    """(file, year_month, stamp, time) of every raw file, from the listing."""
    files = listing(spark, folder(root, spec), pattern).select(snapshot_path(F.col("path")).alias("file"))
    stamp = file_stamp(F.col("file"))
    return files.select(
        "file", file_month(F.col("file")).alias("year_month"), stamp.alias("stamp"), stamp_time(stamp).alias("time")
    ).distinct()


def list_snapshots(files: DataFrame) -> DataFrame:
    """Distinct snapshot files, oldest first."""
    return files.groupBy("file").agg(F.min("time").alias("min_time")).orderBy("min_time", "file")


@dataclass(frozen=True)
class Head:
    """What the beginning of a raw file tells: column names as spelled, line end, bytes of its largest part."""

    names: tuple[str, ...]
    line_end: str
    largest: int


def head(spark: SparkSession, path: str) -> Head:
    """Reads the first record and no more than twice its bytes (``HEAD_BYTES`` at least)."""
    parts = parts_of(spark, path)
    for part, length in parts:
        size, record = HEAD_BYTES, None
        while length and record is None:
            record = first_record(head_of(spark, part, size).removeprefix("\ufeff"), whole=size >= length)
            size *= 2
        if record:
            end = "\r\n" if record.endswith("\r") else "\n"
            return Head(tuple(next(csv.reader([record.removesuffix("\r")], strict=False), ())), end, max(n for _, n in parts))
    return Head((), "\n", 0)


def heads(spark: SparkSession, paths: list[str]) -> dict[str, Head]:
    """The heads of many files, some at a time: a few bytes of each, none of the body."""
    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:
        return dict(zip(paths, pool.map(lambda path: head(spark, path), paths), strict=True))


def header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one file, as spelled in it."""
    return head(spark, path).names


def headers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """Column names of many files."""
    return {path: found.names for path, found in heads(spark, paths).items()}


def comparable(path: str) -> str:
    """A path without the slashes by which Spark's listings and file metadata differ."""
    return re.sub("^file:/+", "/", path)


def with_quoted_line_breaks(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of *paths* in which a quoted value spans lines: some line has an odd number of quotes."""
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    path = snapshot_path(F.col("_metadata.file_path"))
    odd = spark.read.text(paths).where(quotes % 2 == 1).select(path.alias("file")).distinct()
    found = {comparable(r["file"]) for r in odd.collect()}  # a subset of the caller's list
    return [p for p in paths if comparable(p) in found]


def _plain(spark: SparkSession, paths: list[str], names: tuple[str, ...], options: dict[str, str], **more) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = spark.read.options(**_CSV, **options, **more).schema(schema).csv(paths)
    return rows.select(*[F.col(_quoted(n)) for n in names], F.col("_metadata.file_path").alias(_PATH))


def _split_quoted(spark: SparkSession, paths: list[str], names: tuple[str, ...], options: dict[str, str], line_end: str) -> DataFrame:
    found = quoted.records(spark, paths, split_bytes(spark))
    text = F.col("text")
    if line_end == "\r\n":
        text = F.when(text.endswith("\r"), F.substring(text, 1, F.length(text) - 1)).otherwise(text)
    found = found.select(F.col("path").alias(_PATH), text.alias("text")).where("text <> ''")
    return found.select(*quoted.values(F.col("text"), names, {"quote": '"', "escape": '"', **options}), _PATH)


def split_bytes(spark: SparkSession) -> int:
    """Bytes of text that Spark gives one task at most."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)i?b?", spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    return int(number) << (10 * " kmgt".index(unit or " "))


def read_files(
    spark: SparkSession,
    paths: list[str],
    names: tuple[str, ...],
    multiline: bool | None = None,
    strict: bool = True,
    malformed: str | None = None,
) -> DataFrame:
    """All-text rows of files that share the header *names*, with provenance.

    Files whose quoted values stay on one line are split by Spark's reader. Those with line breaks
    inside quotes are read whole, one task each, as long as they are no larger than a split; larger ones
    are split, too (``quoted``). With *multiline* None the files themselves are asked. Text inside quotes
    is kept to the byte: each file is read with the line end of its header. A row with too few or too
    many values fails a *strict* read of all columns; otherwise it is padded or cut, and the column
    *malformed*, if asked for, has its text.
    """
    options = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    read = names
    if malformed:
        options, read = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": malformed}, (*names, malformed)
    whole = [] if multiline is False else paths if multiline else with_quoted_line_breaks(spark, paths)
    inside = set(whole)
    groups: dict[tuple[bool, str], list[str]] = {}
    if whole:
        limit = split_bytes(spark)
        for path, found in heads(spark, whole).items():
            groups.setdefault((found.largest > limit, found.line_end), []).append(path)
    return _with_provenance(_united(spark, paths, read, options, groups, inside), names, malformed)


def read_split(spark: SparkSession, paths: list[str], names: tuple[str, ...]) -> DataFrame:
    """Like ``read_files`` for files with line breaks inside quotes, of any size: all are split."""
    groups: dict[tuple[bool, str], list[str]] = {}
    for path, found in heads(spark, paths).items():
        groups.setdefault((True, found.line_end), []).append(path)
    return _with_provenance(_united(spark, paths, names, {"mode": "FAILFAST"}, groups, set(paths)), names, None)


def _united(
    spark: SparkSession,
    paths: list[str],
    read: tuple[str, ...],
    options: dict[str, str],
    groups: dict[tuple[bool, str], list[str]],
    inside: set[str],
) -> DataFrame:
    """Rows of files with line breaks inside quotes, by size and line end, and of those without."""
    rows = [
        _split_quoted(spark, members, read, options, end) if large else _plain(spark, members, read, options, multiLine=True, lineSep=end)
        for (large, end), members in groups.items()
    ]
    if len(inside) < len(paths):
        rows.append(_plain(spark, [p for p in paths if p not in inside], read, options))
    united = rows[0]
    for more in rows[1:]:
        united = united.unionByName(more)
    return united


def _with_provenance(rows: DataFrame, names: tuple[str, ...], malformed: str | None) -> DataFrame:
    path = snapshot_path(F.col(_PATH))
    return rows.select(
        *[F.nullif(F.col(_quoted(n)), F.lit("")).alias(n) for n in names],
        path.alias(RAW_FILENAME),
        file_month(path).alias(RAW_YEAR_MONTH),
        stamp_time(file_stamp(path)).alias(RAW_TIMESTAMP),
        *([F.col(malformed)] if malformed else []),
    )


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def scan(spark: SparkSession, root: str, spec: DatasetSpec) -> DataFrame:
    """Every raw row of a dataset, text columns united by name.

    A folder read in one go would assign columns by the first file's order, so
    files are read per group of identical headers. The paths listed on the
    driver are one per snapshot.
    """
    paths = [r["file"] for r in list_snapshots(snapshot_files(spark, root, spec)).collect()]
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, names in headers(spark, paths).items():
        groups.setdefault(names, []).append(path)
    provenance = (RAW_FILENAME, RAW_YEAR_MONTH, RAW_TIMESTAMP)
    united: DataFrame | None = None
    for names, members in groups.items():
        rows = read_files(spark, members, names, spec.multiline)
        united = rows if united is None else united.unionByName(rows, allowMissingColumns=True)
    if united is None:
        raise FileNotFoundError(f"No raw files for {spec.code}")
    extra = [c for c in united.columns if c not in spec.names and c not in provenance]
    missing = [F.lit(None).cast("string").alias(n) for n in spec.names if n not in united.columns]
    return united.select("*", *missing).select(*spec.names, *extra, *provenance)


def latest_period(rows: DataFrame, year: str, month: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``YYYY-MM`` of the newest (year, month) whose parts both parse; NULL if none."""
    y, m = (F.expr(f"try_cast(trim(`{c}`) AS int)") for c in (year, month))
    newest = F.max(F.when(y.isNotNull() & m.isNotNull(), F.struct(y.alias("y"), m.alias("m"))))
    return rows.groupBy(*by).agg(newest.alias("__newest")).select(
        *by,
        F.when(
            F.col("__newest").isNotNull(), F.format_string("%04d-%02d", "__newest.y", "__newest.m")
        ).alias("latest_period"),
    )
