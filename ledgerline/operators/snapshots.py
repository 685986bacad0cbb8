"""Numbering of snapshots: a short list, kept apart from the rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.session import work_folder
from ledgerline.spec import STD_FILENAME, STD_TIMESTAMP

SEQ = "__seq"

#: What identifies a snapshot in its rows unless the caller names cheaper columns.
BY_FILE = (STD_FILENAME, STD_TIMESTAMP)

#: Snapshots whose list is broadcast: one an hour for eleven years, some 20 MB of names.
LISTED = 100_000


def distinct_snapshots(observations: DataFrame, by: tuple[str, ...] = BY_FILE) -> DataFrame:
    """Snapshots that hold at least one row; reads no data column."""
    return observations.select(*dict.fromkeys((*by, STD_FILENAME, STD_TIMESTAMP))).distinct()


def number_snapshots(snapshots: DataFrame) -> DataFrame:
    """Add the sequence number by (time, file).

    The window has no partition key. Its input is one row per snapshot, never
    the rows of the snapshots.
    """
    order = Window.orderBy(STD_TIMESTAMP, STD_FILENAME)
    return snapshots.withColumn(SEQ, F.row_number().over(order))


def local_relation(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows as a relation that lives in the plan: its size is known and
    reading it takes no job."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    arrays = [
        pa.array(values, type=field.type)
        for values, field in zip(columns, to_arrow_schema(schema), strict=True)
    ]
    return spark.createDataFrame(pa.table(arrays, names=schema.names), schema)


def local_copy(df: DataFrame, limit: int) -> DataFrame | None:
    """*df* as a local relation if it has at most *limit* rows, otherwise None."""
    instants = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    # instants travel as microseconds: Python would read them in its own time zone
    plain = df.withColumns({n: F.unix_micros(n) for n in instants})
    rows = plain.limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    local = local_relation(df.sparkSession, [tuple(r) for r in rows], plain.schema)
    return local.withColumns({n: F.timestamp_micros(n) for n in instants})


def numbered_snapshots(
    observations: DataFrame, snapshots: DataFrame | None = None, by: tuple[str, ...] = BY_FILE
) -> DataFrame:
    """The numbered snapshot list, ready to be joined to rows.

    Static sizes know nothing of it: the list is a distinct over all rows, so Spark would plan as if
    it had their size and shuffle the rows by snapshot. It is therefore counted first. A list of at most
    ``LISTED`` snapshots becomes part of the plan and is broadcast; a longer one is written, and the join
    is left to the size of its file.
    """
    listed = distinct_snapshots(observations, by) if snapshots is None else snapshots
    numbered = number_snapshots(listed.select(*dict.fromkeys((*by, STD_FILENAME, STD_TIMESTAMP))))
    local = local_copy(numbered, LISTED)
    if local is not None:
        return F.broadcast(local)
    path = work_folder(observations.sparkSession, "snapshots")
    numbered.write.parquet(path)
    return observations.sparkSession.read.schema(numbered.schema).parquet(path)
