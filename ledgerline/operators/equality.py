"""Snapshot equality: does a new export say anything new?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _kept(rows: DataFrame, ignore: Sequence[str]) -> list[str]:
    return [c for c in rows.columns if c not in set(ignore)]


def row_differences(left: DataFrame, right: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows, without *ignore*, whose number differs, with ``surplus`` (left
    minus right).

    One aggregation of both sides: rows are counted before the shuffle, so a
    group of copies never meets in one task row by row.
    """
    names = _kept(left, ignore)
    if names != _kept(right, ignore):
        raise ValueError("Both snapshots need the same columns in the same order")
    both = left.select(*names, F.lit(1).alias("__side")).union(right.select(*names, F.lit(-1).alias("__side")))
    return both.groupBy(*names).agg(F.sum("__side").alias("surplus")).where("surplus <> 0")


def fingerprint(rows: DataFrame, ignore: Sequence[str] = ()) -> tuple:
    """Row count and order-free hash totals; differing fingerprints prove a difference."""
    names = _kept(rows, ignore)
    code = F.xxhash64(*[F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")) for n in names])
    return tuple(
        rows.select(code.alias("h"))
        .agg(F.count("*"), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor("h"))
        .first()
    )


def same_rows(left: DataFrame, right: DataFrame, ignore: Sequence[str] = (), printed: bool = False) -> bool:
    """Equal header (names and order) and equal rows in any order, without *ignore*.

    The fingerprints settle most differences without a shuffle, unless they were *printed* and compared
    before; equality is always proved by comparing the rows themselves. NULL equals empty text.
    """
    if _kept(left, ignore) != _kept(right, ignore):
        return False
    if not printed and fingerprint(left, ignore) != fingerprint(right, ignore):
        return False

    def filled(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")).alias(n) for n in _kept(rows, ignore)])

    return row_differences(filled(left), filled(right)).isEmpty()


def _placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a file with their place: file split and number within it.

    Files of equal length are split at the same offsets, and a split is bounded
    by ``spark.sql.files.maxPartitionBytes``, so the numbering never gathers
    more than that in one task. Only the line feed is taken off a line.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    number = F.row_number().over(Window.partitionBy("block").orderBy("at"))
    return lines.select("block", number.alias("line"), "value")


def same_bytes(spark: SparkSession, left: str, right: str) -> bool:
    """Whether two text files are equal byte for byte."""
    files = spark.read.format("binaryFile")
    sizes = [[r["length"] for r in files.load(path).select("length").collect()] for path in (left, right)]
    if any(len(s) != 1 for s in sizes):
        raise ValueError("Byte equality is defined for single files")
    if sizes[0] != sizes[1]:
        return False
    return row_differences(_placed_lines(spark, left), _placed_lines(spark, right)).isEmpty()
