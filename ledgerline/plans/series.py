"""Snapshot series derived from the star-schema tables.

The tables come without history. A deterministic rule turns each into a series
of complete exports in which keys appear, vanish, return and change.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.changes import by_key, full_replay
from ledgerline.operators.snapshots import local_relation
from ledgerline.spec import STD_FILENAME, STD_TIMESTAMP, Column, DatasetSpec

SOURCE = "star"


@dataclass(frozen=True)
class Series:
    """A table, its spec, the number the rule works on and the moving value."""

    spec: DatasetSpec
    base: str
    number: str
    moving: str
    select: tuple[str, ...]
    #: Aggregates per key, for a table whose key repeats.
    aggregates: tuple[str, ...] = ()

    def file(self, month: str, stamp: str) -> str:
        return f"std/{self.spec.source}/{self.spec.table}/year_month={month}/{self.spec.code}_{stamp}.parquet"


CUSTOMER = Series(
    spec=DatasetSpec(
        source=SOURCE,
        table="customer",
        keys=("c_custkey",),
        volatile=("sync_no",),
        columns=(
            Column("c_custkey", "bigint"),
            Column("c_name"),
            Column("c_nationkey", "int"),
            Column("c_mktsegment"),
            Column("balance", "decimal(18,2)"),
            Column("sync_no", "int"),
        ),
    ),
    base="customer",
    number="c_custkey",
    moving="c_acctbal",
    select=("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
)

ORDERS = Series(
    spec=DatasetSpec(
        source=SOURCE,
        table="orders",
        keys=("o_orderkey",),
        volatile=("sync_no",),
        columns=(
            Column("o_orderkey", "bigint"),
            Column("o_custkey", "bigint"),
            Column("o_orderstatus"),
            Column("o_orderpriority"),
            Column("o_orderdate", "date"),
            Column("balance", "decimal(18,2)"),
            Column("sync_no", "int"),
        ),
    ),
    base="orders",
    number="o_orderkey",
    moving="o_totalprice",
    select=("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "CAST(o_orderdate AS date) AS o_orderdate"),
)

# (l_orderkey, l_linenumber) repeats in the data; a snapshot row sums them up
LINEITEM = Series(
    spec=DatasetSpec(
        source=SOURCE,
        table="lineitem",
        keys=("l_orderkey", "l_linenumber"),
        volatile=("sync_no",),
        columns=(
            Column("l_orderkey", "bigint"),
            Column("l_linenumber", "int"),
            Column("parts", "bigint"),
            Column("first_part", "bigint"),
            Column("returned", "bigint"),
            Column("opened", "bigint"),
            Column("shipped", "date"),
            Column("balance", "decimal(18,2)"),
            Column("sync_no", "int"),
        ),
    ),
    base="lineitem",
    number="(l_orderkey + l_linenumber * 5)",
    moving="amount",
    select=("l_orderkey", "l_linenumber", "parts", "first_part", "returned", "opened", "shipped"),
    aggregates=(
        "count(*) AS parts",
        "min(l_partkey) AS first_part",
        "CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS bigint) AS returned",
        "CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS bigint) AS opened",
        "max(CAST(l_shipdate AS date)) AS shipped",
        "sum(CAST(l_extendedprice AS decimal(18,2))) AS amount",
    ),
)

# wide rows: whole texts are the payload
DOCUMENTS = Series(
    spec=DatasetSpec(
        source=SOURCE,
        table="documents",
        keys=("doc_id",),
        volatile=("sync_no",),
        columns=(
            Column("doc_id", "bigint"),
            Column("text"),
            Column("lang"),
            Column("source"),
            Column("balance", "decimal(18,2)"),
            Column("sync_no", "int"),
        ),
    ),
    base="documents",
    number="doc_id",
    moving="n_chars",
    select=("doc_id", "text", "lang", "source"),
)

SERIES = {s.base: s for s in (CUSTOMER, ORDERS, LINEITEM, DOCUMENTS)}


def snapshot_dates(count: int) -> list[tuple[int, str, str]]:
    """(seq, year_month, stamp) of monthly snapshots from 2026-01-01 10:00 UTC."""
    out = []
    for seq in range(1, count + 1):
        year, month = 2026 + (seq - 1) // 12, (seq - 1) % 12 + 1
        out.append((seq, f"{year}-{month:02d}", f"{year}{month:02d}01_1000"))
    return out


#: Column that tells the snapshot of a series row.
BY = ("seq",)


def snapshot_list(spark: SparkSession, series: Series, count: int) -> DataFrame:
    """Number, name and time of the series' snapshots, without reading a row."""
    rows = [
        (seq, series.file(month, stamp), datetime.strptime(stamp + "+0000", "%Y%m%d_%H%M%z"))
        for seq, month, stamp in snapshot_dates(count)
    ]
    schema = T.StructType(
        [
            T.StructField("seq", T.IntegerType()),
            T.StructField(STD_FILENAME, T.StringType()),
            T.StructField(STD_TIMESTAMP, T.TimestampType()),
        ]
    )
    return local_relation(spark, rows, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def snapshot_rows(spark: SparkSession, sf_dir: str, series: Series, count: int = 4, by_keys: bool = False) -> DataFrame:
    """Rows of every snapshot, ``seq`` from 1 to *count*.

    A row is present iff ``(number * 7 + seq * 3) % 11 <> 0``; its moving value
    rises by ``floor((number % 13 + seq) / 5)``; ``sync_no`` is the volatile
    column. With *by_keys* the table is shuffled by key before its rows become those of *count* snapshots,
    into tasks that can sort them.
    """
    base = table(spark, sf_dir, series.base)
    if by_keys:
        base = by_key(series.spec.keys, base, base.count() * count)  # counted from footers
    if series.aggregates:
        base = base.groupBy(*series.spec.keys).agg(*[F.expr(e) for e in series.aggregates])
    seq = F.explode(F.array(*[F.lit(i) for i in range(1, count + 1)])).alias("seq")
    number = F.expr(series.number)
    step = F.floor((number % 13 + F.col("seq")) / F.lit(5.0))
    return (
        base.select("*", seq)
        .where((number * 7 + F.col("seq") * 3) % 11 != 0)
        .select(
            *[F.expr(e) for e in series.select],
            (F.expr(series.moving).cast("decimal(18,2)") + step).cast("decimal(18,2)").alias("balance"),
            F.col("seq").alias("sync_no"),
            "seq",
        )
    )


def replay(spark: SparkSession, sf_dir: str, series: Series, count: int = 4) -> DataFrame:
    """Change log of the series."""
    rows = snapshot_rows(spark, sf_dir, series, count, by_keys=True)
    return full_replay(series.spec, rows, snapshot_list(spark, series, count), BY, clustered=True)
