"""Helpers that several operators share: tables, written intermediate results, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import work_folder

#: Bytes of one Arrow batch that goes to a Python worker; with it a worker's memory is bounded
#: by this and the longest text, whatever the number of rows.
BATCH_BYTES = 4 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """*df* written to the shared work folder and read again.

    Cuts the lineage: what follows survives a lost executor without computing *df* once more,
    and plans with the size of the files.
    """
    path = work_folder(df.sparkSession, f"llm-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_file_order(docs: DataFrame, name: str) -> DataFrame:
    """*docs* with the place of each row (*name*, from 0) in the files it is read from: files by their
    number, rows as they lie in them.

    A sorted table that was written keeps its order in its files, but a scan deals them out by size; the
    place has to be asked for. What is no scan of files is written first.
    """
    try:
        meta = docs.metadataColumn("_metadata")
    except AnalysisException:
        docs = written(docs, "file-order")
        meta = docs.metadataColumn("_metadata")
    file, start = unused(docs, "_file", "_start")
    rows = docs.select("*", meta["file_path"].alias(file), meta["row_index"].alias(name))
    part = F.regexp_extract(F.col(file), r"part-(\d+)[^/]*$", 1)
    order = Window.orderBy(F.lpad(part, 20, "0"), file)  # one row per file
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = rows.groupBy(file).agg((F.max(name) + 1).alias("n")).select(file, before.alias(start))
    return rows.join(F.broadcast(starts), file).withColumn(name, F.col(start) + F.col(name)).select(*[column(c) for c in docs.columns], name)


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator], schema: str) -> DataFrame:
    """``mapInArrow`` with batches of bounded size."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is.

    ``lower`` does that for pure ASCII, and fast; other texts go through ``translate``.
    """
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like *names* that *df* does not have, so that its own columns stay untouched."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name in taken:
            name = f"{name}_"
        taken.add(name)
        found.append(name)
    return found


def column(name: str) -> Column:
    """The column of that exact name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")
