"""Quality checks: each yields its violations as rows, and can raise on them.

The rows are the whole result and stay distributed. A check that raises writes
them all to a Parquet table first; the exception has the table's path, the exact
total, and the first few entries as a foretaste.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import work_folder
from ledgerline.spec import DatasetSpec

#: Entries an exception message quotes; the table at its path has all of them.
QUOTED = 50


class CheckError(ValueError):
    """Data breaks a rule of its dataset; *path* holds every violation."""

    def __init__(self, message: str, path: str | None = None, total: int | None = None):
        super().__init__(message)
        self.path, self.total = path, total


@dataclass(frozen=True)
class Violations:
    """All distinct messages as a table, their number, and a text for people."""

    path: str
    total: int
    text: str


def schema_drift(expected: Iterable[str], actual: Iterable[str]) -> str | None:
    """``missing: a, b; unexpected: c``, names compared with their case."""
    expected, actual = set(expected), set(actual)
    parts = []
    if expected - actual:
        parts.append("missing: " + ", ".join(sorted(expected - actual)))
    if actual - expected:
        parts.append("unexpected: " + ", ".join(sorted(actual - expected)))
    return "; ".join(parts) or None


def column_drift(expected: DataFrame, actual: DataFrame, group: str, name: str) -> DataFrame:
    """Schema drift per *group* from two tables of (group, column name).

    The names are made distinct before they are gathered, so a group holds as
    many entries as it has differing columns, not rows.
    """
    missing = expected.select(group, name).subtract(actual.select(group, name))
    unexpected = actual.select(group, name).subtract(expected.select(group, name))
    sides = missing.withColumn("side", F.lit("missing")).unionByName(
        unexpected.withColumn("side", F.lit("unexpected"))
    )
    per_side = sides.groupBy(group, "side").agg(
        F.array_join(F.array_sort(F.collect_list(name)), ", ").alias("names")
    )
    return per_side.groupBy(group).agg(
        F.array_join(
            F.array_sort(F.collect_list(F.concat("side", F.lit(": "), "names"))), "; "
        ).alias("drift")
    )


def domain_violations(rows: DataFrame, names: Sequence[str], allowed: Sequence[str]) -> DataFrame:
    """(column, value, rows) of values outside *allowed*; empty counts as one.

    Map-side partial counts reduce a frequent bad value before the shuffle.
    """
    offending = [
        F.when(
            F.col(f"`{n}`").isNull() | ~F.col(f"`{n}`").isin(*allowed),
            F.struct(F.lit(n).alias("column"), F.col(f"`{n}`").alias("value")),
        )
        for n in names
    ]
    found = rows.select(F.explode(F.array(*offending)).alias("v")).where("v is not null")
    return found.groupBy("v.column", "v.value").agg(F.count("*").alias("rows"))


def null_keys(rows: DataFrame, keys: Sequence[str], labels: Sequence[str] = ()) -> DataFrame:
    """(column, label, rows) of rows with an empty key column.

    The label names the row: the text of *labels*, or of the key, joined by
    ``/``; a row whose label is NULL is counted under NULL.
    """
    described = [F.col(f"`{n}`").cast("string") for n in (labels or keys)]
    label = described[0] if len(described) == 1 else F.concat(described[0], *[
        part for d in described[1:] for part in (F.lit("/"), d)
    ])
    offending = [F.when(F.col(f"`{k}`").isNull(), F.lit(k)) for k in keys]
    found = rows.select(label.alias("label"), F.explode(F.array(*offending)).alias("column")).where(
        "column is not null"
    )
    return found.groupBy("column", "label").agg(F.count("*").alias("rows"))


def duplicates(rows: DataFrame, names: Sequence[str | Column]) -> DataFrame:
    """Values of *names* that occur more than once, with their count."""
    return rows.groupBy(*names).agg(F.count("*").alias("rows")).where("rows > 1")


def missing_parents(children: DataFrame, child: str, parents: DataFrame, parent: str) -> DataFrame:
    """(child, rows) of references without a parent.

    Counting before the join leaves one row per referenced value, so a value
    that a third of the children share does not load one task.
    """
    counted = children.where(F.col(child).isNotNull()).groupBy(child).agg(F.count("*").alias("rows"))
    known = parents.select(F.col(parent).alias(child)).distinct()
    return counted.join(known, child, "left_anti")


def whole(pattern: str) -> str:
    """*pattern* for the whole value; a final line break is part of the value."""
    return rf"\A(?:{pattern})\z"


def pattern_violations(rows: DataFrame, name: str, pattern: str) -> DataFrame:
    """Rows whose value is empty or does not match *pattern* as a whole."""
    value = F.col(name)
    return rows.where(value.isNull() | ~value.rlike(whole(pattern)))


def range_violations(rows: DataFrame, name: str, low: int, high: int) -> DataFrame:
    return rows.where(~F.col(name).between(low, high))


def mixed_values(rows: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """Groups in which *name* takes more than one value, with the extremes."""
    return (
        rows.groupBy(*group)
        .agg(F.min(name).alias("lowest"), F.max(name).alias("highest"), F.count("*").alias("rows"))
        .where(F.col("lowest") != F.col("highest"))
    )


def listed(messages: DataFrame, column: str, folder: str | None = None) -> Violations | None:
    """Distinct messages, written below *folder*; None if there are none.

    The folder begins with an underscore, so scans of the dataset pass over it.
    """
    distinct = messages.select(F.col(column).alias("message")).where(F.col(column).isNotNull()).distinct()
    if distinct.isEmpty():
        return None
    spark = messages.sparkSession
    path = f"{folder.rstrip('/')}/_violations/{uuid.uuid4().hex}" if folder else work_folder(spark, "violations")
    distinct.write.parquet(path)
    kept = spark.read.parquet(path)
    total = kept.count()
    text = ", ".join(r[0] for r in kept.orderBy("message").limit(QUOTED).collect())
    if total > QUOTED:
        text += f", ... ({total} in all, in {path})"
    return Violations(path, total, text)


def check_schema(spec: DatasetSpec, actual: Iterable[str], file: str) -> None:
    drift = schema_drift(spec.names, actual)
    if drift:
        raise CheckError(f"Schema of {file} changed: {drift}")


def check_rows(spec: DatasetSpec, rows: DataFrame, file: str, folder: str | None = None) -> None:
    """Flags and keys of a raw snapshot; violations go to a table below *folder*."""
    if spec.flags:
        wrong = domain_violations(rows, spec.flags, ("Y", "N"))
        found = listed(wrong.select(F.concat("column", F.lit("="), F.coalesce("value", F.lit("NULL"))).alias("m")), "m", folder)
        if found:
            raise CheckError(f"Unexpected flag values in {file}: {found.text}", found.path, found.total)
    empty = null_keys(rows, spec.keys, spec.key_labels).withColumn("label", F.coalesce("label", F.lit("NULL")))
    for key in spec.keys:
        found = listed(empty.where(F.col("column") == key), "label", folder)
        if found:
            raise CheckError(f"Empty {key} in {file}: {found.text}", found.path, found.total)


def check_unique(spec: DatasetSpec, rows: DataFrame, file: str, folder: str | None = None) -> None:
    """A business key occurs once in a snapshot.

    Equal keys have equal hashes, so keys are gathered, and compared, only if a hash occurs twice.
    """
    if duplicates(rows.select(F.xxhash64(*[F.col(f"`{k}`") for k in spec.keys]).alias("h")), ["h"]).isEmpty():
        return
    twice = duplicates(rows, list(spec.keys)).select(
        F.concat_ws("/", *[F.col(f"`{k}`").cast("string") for k in spec.keys]).alias("m")
    )
    found = listed(twice, "m", folder)
    if found:
        raise CheckError(f"Duplicate key in {file}: {found.text}", found.path, found.total)


def ranked(rows: DataFrame, names: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per *names* in *order*; one row per task crosses the shuffle."""
    window = Window.partitionBy(*names).orderBy(*order)
    return rows.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")
