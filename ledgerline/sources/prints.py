"""Fingerprints of raw files, kept so that a new download is compared in one scan.

    <root>/fingerprints/<source>/<table>/part-*.parquet

A fingerprint does not depend on the order of the rows and leaves out volatile columns: header, number of rows,
sum and exclusive or of the rows' hashes. Different ones prove a difference; equal ones are proved by the rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.equality import fingerprint
from ledgerline.operators.snapshots import local_relation
from ledgerline.sources import raw
from ledgerline.sources.files import parquet
from ledgerline.spec import DatasetSpec

SCHEMA = T.StructType(
    [
        T.StructField("raw_file", T.StringType()),
        T.StructField("header", T.ArrayType(T.StringType())),
        T.StructField("rows", T.LongType()),
        T.StructField("total", T.DecimalType(38, 0)),
        T.StructField("parity", T.LongType()),
    ]
)


def folder(root: str, spec: DatasetSpec) -> str:
    return f"{root.rstrip('/')}/fingerprints/{spec.source}/{spec.table}"


def rows_of(spark: SparkSession, spec: DatasetSpec, raw_file: str) -> DataFrame:
    """All-text rows of a raw file, its own columns in its own order."""
    names = raw.header(spark, raw_file)
    return raw.read_files(spark, [raw_file], names, spec.multiline, strict=False).select(*[F.col(f"`{n}`") for n in names])


def of(spark: SparkSession, root: str, spec: DatasetSpec, raw_file: str) -> tuple:
    """The kept fingerprint of a raw file; taken from the file, and kept, the first time."""
    kept = parquet(spark, folder(root, spec), SCHEMA).where(F.col("raw_file") == raw_file).first()
    if kept is None:
        rows = rows_of(spark, spec, raw_file)
        header = [c for c in rows.columns if c not in spec.volatile]
        count, total, parity = fingerprint(rows, spec.volatile)
        kept = (raw_file, header, count, total if total is not None else Decimal(0), parity or 0)
        local_relation(spark, [kept], SCHEMA).coalesce(1).write.mode("append").parquet(folder(root, spec))
    return tuple(kept[1]), *kept[2:]
