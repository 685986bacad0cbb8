"""Load states: an append-only table, one row for each step that a load has finished.

A row says how far one raw file of a dataset has come. The newest row of a dataset is its state.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.checks import ranked
from ledgerline.sources.files import parquet

# The columns of the table, and how far a raw file can be.
NAMES = ("source", "dataset", "load_mode", "last_period_fetched", "status", "raw_file")
SCHEMA = T.StructType([*[T.StructField(n, T.StringType()) for n in NAMES], T.StructField("updated_at", T.TimestampType())])
RAW, STD, LAKE, OK = "raw", "std", "lake", "ok"
#: What a file at this point still has to become; a file that is through has nothing left.
NEXT = {RAW: STD, STD: LAKE}


@dataclass(frozen=True)
class LoadState:
    """How far the newest raw file of a dataset has come."""

    source: str
    dataset: str
    load_mode: str | None = None
    last_period_fetched: str | None = None
    status: str | None = None
    raw_file: str | None = None

    @property
    def finished(self) -> bool:
        return self.status not in NEXT

    def at(self, status: str) -> LoadState:
        """The same file, further on."""
        return replace(self, status=status)


def folder(root: str) -> str:
    return f"{root.rstrip('/')}/load_state"


def read(spark: SparkSession, root: str) -> DataFrame:
    return parquet(spark, folder(root), SCHEMA)


def latest_state(rows: DataFrame, *tie_break: str) -> DataFrame:
    """The newest row of every (source, dataset)."""
    newest_first = [F.desc(c) for c in ("updated_at", *tie_break)]
    return ranked(rows, ["source", "dataset"], newest_first)


def of(spark: SparkSession, root: str, source: str, dataset: str) -> LoadState:
    """The state of one dataset; without a status if nothing was ever recorded."""
    blank = LoadState(source, dataset)
    own = read(spark, root).where((F.col("source") == source) & (F.col("dataset") == dataset))
    for row in latest_state(own).drop("updated_at").collect():
        blank = LoadState(**row.asDict())
    return blank


def record(spark: SparkSession, root: str, state: LoadState) -> None:
    """Add a row; one file, under the instant it is written at."""
    if state.status not in (*NEXT, LAKE, OK):
        raise ValueError(f"no load can be at {state.status!r}")
    row = spark.createDataFrame([(*[getattr(state, name) for name in NAMES], datetime.now(timezone.utc))], SCHEMA)
    row.coalesce(1).write.mode("append").parquet(folder(root))
