"""Std layer: typed Parquet, one partition per snapshot, and a journal of what was converted.

    <root>/<source>/<table>/year_month=<YYYY-MM>/snapshot=<YYYYMMDD_HHmm>/part-*.parquet

A snapshot is a folder of files written in parallel. Its name in the derived
columns keeps the one-file form
``<root>/<source>/<table>/year_month=<YYYY-MM>/<source>_<table>_<stamp>.parquet``.

A conversion parses its text once, into a staged table of typed rows in which values that do not fit are
marked. The checks read that table; what passes is published from it. The journal
``<root>/_conversions/<source>/<table>`` then gets a row per export, also for one without rows, which
leaves no partition. What is pending follows from the journal; a partition that someone removes is
converted again only by a rebuild.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.parse import MONTH_PATTERN, STAMP_PATTERN, file_month, file_stamp, stamp_time, typed, typed_or_null
from ledgerline.operators.checks import CheckError, check_rows, check_schema, check_unique
from ledgerline.operators.changes import with_digest
from ledgerline.operators.snapshots import local_relation
from ledgerline.session import shuffles_freed, work_folder
from ledgerline.sources import raw
from ledgerline.sources.files import CODEC, listing, parquet, path_exists
from ledgerline.spec import (
    BLANK,
    FLAG,
    RAW_FILENAME,
    STD_FILENAME,
    STD_TIMESTAMP,
    STD_YEAR_MONTH,
    DatasetSpec,
)

#: Partition columns; they identify a snapshot in its rows.
BY = ("year_month", "snapshot")

JOURNAL = T.StructType(
    [*[T.StructField(n, T.StringType()) for n in ("table", "year_month", "stamp")], T.StructField("rows", T.LongType())]
)
_MALFORMED, _WRONG = "___malformed", "___wrong"


def folder(root: str, spec: DatasetSpec) -> str:
    return f"{root.rstrip('/')}/{spec.source}/{spec.table}"


# The path format below and the message of a path that is none.


def std_name(root: str, source: str, table: str, month: Column, stamp: Column) -> Column:
    return F.concat(
        F.lit(f"{root.rstrip('/')}/{source}/{table}/year_month="),
        month,
        F.lit(f"/{source}_{table}_"),
        stamp,
        F.lit(".parquet"),
    )


def std_path(root: str, source: str, table: str, raw_file: Column) -> Column:
    """Std name that belongs to a raw file; a path without month or stamp fails."""
    month, stamp = file_month(raw_file), file_stamp(raw_file)
    guarded = F.when((month != "") & (stamp != ""), stamp).otherwise(
        F.raise_error(F.concat(F.lit("Not a Raw file path: "), raw_file)).cast("string")
    )
    return std_name(root, source, table, month, guarded)


def typed_rows(spec: DatasetSpec, rows: DataFrame) -> DataFrame:
    """Typed projection, keys first, with the partition columns.

    A value outside its type, a flag other than Y or N and an empty key fail
    the write, which then publishes nothing.
    """
    out = []
    for column in spec.columns:
        value = typed(column)
        raw_value = F.col(f"`{column.name}`")
        problem = None
        if column.parse == FLAG:
            problem = ~F.coalesce(raw_value, F.lit("")).isin("Y", "N")
        elif column.name in spec.keys:
            problem = (F.nullif(F.trim(raw_value), F.lit("")) if column.parse == BLANK else raw_value).isNull()
        if problem is not None:
            failure = F.raise_error(F.lit(f"{spec.code}: bad {column.name}")).cast(column.type)
            value = F.when(problem, failure).otherwise(value).alias(column.name)
        out.append(value)
    path = F.col(RAW_FILENAME)
    return rows.select(*out, file_month(path).alias("year_month"), file_stamp(path).alias("snapshot"))


def write(spec: DatasetSpec, rows: DataFrame, root: str, gather: bool = True) -> None:
    """Publish typed rows; only the partitions they belong to are replaced.

    REBALANCE gathers the rows of a snapshot into files of a good size, so a task that holds several
    snapshots does not leave a file in each.
    """
    with shuffles_freed(rows.sparkSession):
        (
            (rows.hint("rebalance", *[F.col(c) for c in BY]) if gather else rows)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", CODEC)
            .partitionBy(*BY)
            .parquet(folder(root, spec))
        )


def write_snapshot(spec: DatasetSpec, rows: DataFrame, root: str, month: str, stamp: str) -> None:
    """Publish the typed rows of one snapshot in files as large as the tasks they come in: neither shuffled nor sorted."""
    path = f"{folder(root, spec)}/year_month={month}/snapshot={stamp}"
    rows.select(*spec.names).write.mode("overwrite").parquet(path)


def publish(spec: DatasetSpec, rows: DataFrame, root: str, raw_file: str) -> None:
    """Publish one table's typed rows of a raw file; keys must be there and unique."""
    check_unique(spec, rows, raw_file, folder(root, spec))
    stamped = rows.select(*spec.names, F.lit(raw_file).alias(RAW_FILENAME))
    path = F.col(RAW_FILENAME)
    stamped = stamped.select(*spec.names, file_month(path).alias("year_month"), file_stamp(path).alias("snapshot"))
    write(spec, stamped, root, gather=False)  # one snapshot: its files are as large as the tasks its rows come in
    spark, (month, stamp) = rows.sparkSession, snapshot_of(raw_file)
    there = scan(spark, root, spec).where((F.col("year_month") == month) & (F.col("snapshot") == stamp))
    note_conversions(spark, root, spec, {(month, stamp): there.count()})  # footers only


def scan(spark: SparkSession, root: str, spec: DatasetSpec) -> DataFrame:
    """Typed columns and partition columns of every snapshot."""
    schema = T.StructType(spec.schema.fields + [T.StructField(c, T.StringType()) for c in BY])
    return parquet(spark, folder(root, spec), schema)


def view(spark: SparkSession, root: str, spec: DatasetSpec) -> DataFrame:
    """Typed columns, then digest, name, month and time of the snapshot."""
    rows = with_digest(spec, scan(spark, root, spec))
    return rows.withColumns(
        {
            STD_FILENAME: std_name(root, spec.source, spec.table, F.col("year_month"), F.col("snapshot")),
            STD_YEAR_MONTH: F.col("year_month"),
            STD_TIMESTAMP: stamp_time(F.col("snapshot")),
        }
    ).drop(*BY)


def snapshots(spark: SparkSession, root: str, spec: DatasetSpec) -> DataFrame:
    """Partition columns, name and time of the snapshots that hold rows.

    Only partition values and Parquet footers are read.
    """
    found = scan(spark, root, spec).select(*BY).distinct()
    return found.select(
        *BY,
        std_name(root, spec.source, spec.table, F.col("year_month"), F.col("snapshot")).alias(STD_FILENAME),
        stamp_time(F.col("snapshot")).alias(STD_TIMESTAMP),
    )


# Journal


def journal_folder(root: str, spec: DatasetSpec) -> str:
    return f"{root.rstrip('/')}/_conversions/{spec.source}/{spec.table}"


def journal(spark: SparkSession, root: str, spec: DatasetSpec) -> DataFrame:
    """table, year_month, stamp and rows of every conversion; rows is NULL for those found, not made, here."""
    return parquet(spark, journal_folder(root, spec), JOURNAL)


def _listed(spark: SparkSession, root: str, spec: DatasetSpec) -> DataFrame:
    """(table, year_month, stamp) that exist in Std, from the listing."""
    path = F.col("path")
    return (
        listing(spark, folder(root, spec), "*.parquet")
        .select(
            F.lit(spec.table).alias("table"),
            file_month(path).alias("year_month"),
            F.regexp_extract(path, "/snapshot=([^/]+)/", 1).alias("stamp"),
        )
        .distinct()
    )


def note_conversions(spark: SparkSession, root: str, spec: DatasetSpec, counts: dict[tuple[str, str], int]) -> None:
    """Add a row for each (year_month, stamp); the first journal also takes over what is already there."""
    path = journal_folder(root, spec)
    rows = local_relation(spark, [(spec.table, *key, n) for key, n in counts.items()], JOURNAL)
    if not path_exists(spark, path):
        there = _listed(spark, root, spec).join(rows.select("year_month", "stamp"), ["year_month", "stamp"], "left_anti")
        rows = rows.unionByName(there.withColumn("rows", F.lit(None).cast("bigint")))
    rows.coalesce(1).write.mode("append").parquet(path)


def converted(spark: SparkSession, root: str, spec: DatasetSpec) -> DataFrame:
    """(table, year_month, stamp) that were converted: from the journal, or from the listing if there is none yet."""
    if path_exists(spark, journal_folder(root, spec)):
        return journal(spark, root, spec).select("table", "year_month", "stamp").distinct()
    return _listed(spark, root, spec)


def pending(files: DataFrame, tables: list[str], existing: DataFrame, rebuild: bool = False) -> DataFrame:
    """Raw files that lack a Std snapshot for any of *tables*; all with *rebuild*."""
    if rebuild:
        return files.select("file", "time").distinct()
    wanted = files.withColumn("table", F.explode(F.array(*[F.lit(t) for t in tables])))
    return wanted.join(existing, ["table", "year_month", "stamp"], "left_anti").select("file", "time").distinct()


# Conversion


def staged(spark: SparkSession, spec: DatasetSpec, paths: list[str], names: tuple[str, ...]) -> DataFrame:
    """Typed rows of raw files with the header *names*, and whether something is wrong with a row.

    The text is parsed here, once; the result is a table below the work folder.
    """
    rows = raw.read_files(spark, paths, names, spec.multiline, malformed=_MALFORMED)
    wrong = F.col(_MALFORMED).isNotNull()
    values = []
    for column in spec.columns:
        value, unfit = typed_or_null(column)
        values.append(value)
        wrong = wrong | unfit
        if column.name in spec.keys:
            text = F.col(f"`{column.name}`")
            wrong = wrong | (F.nullif(F.trim(text), F.lit("")) if column.parse == BLANK else text).isNull()
    path = F.col(RAW_FILENAME)
    rows = rows.select(*values, file_month(path).alias("year_month"), file_stamp(path).alias("snapshot"), wrong.alias(_WRONG))
    folder = work_folder(spark, "std-stage")
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def examined(spec: DatasetSpec, rows: DataFrame) -> tuple[dict[tuple[str, str], int], set[tuple[str, str]]]:
    """Rows of each staged snapshot, and the snapshots that break a rule; reads flags and keys, no text."""
    counts = rows.groupBy(*BY).agg(F.count("*").alias("rows"), F.max(_WRONG).alias("wrong")).collect()  # one row per snapshot
    twice = rows.groupBy(*BY, *spec.keys).count().where("count > 1").select(*BY).distinct().collect()
    bad = {(r["year_month"], r["snapshot"]) for r in counts if r["wrong"]} | {tuple(r) for r in twice}
    return {(r["year_month"], r["snapshot"]): r["rows"] for r in counts}, bad


def snapshot_of(path: str) -> tuple[str, str]:
    """(year_month, stamp) of a raw file path."""
    month, stamp = re.search(MONTH_PATTERN, path), re.search(STAMP_PATTERN, path)
    if not month or not stamp:
        raise ValueError(f"Not a Raw file path: {path}")
    return month.group(1), stamp.group(1)


def explain_failure(spark: SparkSession, spec: DatasetSpec, std_root: str, path: str, names: tuple[str, ...]) -> None:
    """Read a file that broke a rule once more, strictly, to raise what is wrong with it."""
    rows = raw.read_files(spark, [path], names, spec.multiline)
    check_rows(spec, rows, path, folder(std_root, spec))
    check_unique(spec, rows, path, folder(std_root, spec))
    typed_rows(spec, rows).write.format("noop").mode("overwrite").save()
    raise CheckError(f"{path} breaks a rule of {spec.code}")


def standardize(spark: SparkSession, spec: DatasetSpec, std_root: str, path: str) -> None:
    """Convert one raw file. Every failure names the file and what is wrong."""
    names = raw.header(spark, path)
    check_schema(spec, names, path)
    _convert(spark, spec, std_root, {path: names})


def _convert(spark: SparkSession, spec: DatasetSpec, std_root: str, headers: dict[str, tuple[str, ...]]) -> None:
    """Publish files in order up to the first that breaks a rule, and raise what is wrong with that one."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, names in headers.items():
        groups.setdefault(names, []).append(path)
    rows = None
    for names, members in groups.items():
        part = staged(spark, spec, members, names)
        rows = part if rows is None else rows.unionByName(part)
    counts, bad = examined(spec, rows)
    paths = list(headers)
    broken = next((k for k, path in enumerate(paths) if snapshot_of(path) in bad), len(paths))
    good = {snapshot_of(path): counts.get(snapshot_of(path), 0) for path in paths[:broken]}
    filled = [key for key, n in good.items() if n]
    if filled:
        if broken < len(paths):
            rows = rows.where(F.struct(*BY).isin([F.struct(F.lit(m), F.lit(s)) for m, s in filled]))
        write(spec, rows.select(*spec.names, *BY), std_root)
    if good:
        note_conversions(spark, std_root, spec, good)
    if broken < len(paths):
        explain_failure(spark, spec, std_root, paths[broken], headers[paths[broken]])


def standardize_all(
    spark: SparkSession, spec: DatasetSpec, raw_root: str, std_root: str, rebuild: bool = False
) -> int:
    """Convert every pending raw file; return how many.

    All files are staged and published together. The first bad one, by time, stops the load: those before
    it are stored, and it raises its own message.
    """
    files = raw.snapshot_files(spark, raw_root, spec)
    todo = [
        r["file"]
        for r in pending(files, [spec.table], converted(spark, std_root, spec), rebuild)
        .orderBy("time", "file")
        .collect()
    ]
    headers = raw.headers(spark, todo)
    drifted = next((k for k, path in enumerate(todo) if set(headers[path]) != set(spec.names)), len(todo))
    if drifted:
        _convert(spark, spec, std_root, {path: headers[path] for path in todo[:drifted]})
    if drifted < len(todo):
        check_schema(spec, headers[todo[drifted]], todo[drifted])
    return len(todo)
