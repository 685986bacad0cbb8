"""Catalog tables for the layers, created if missing.

A table may be bucketed on the business key. Each write then clusters its rows
once; replays and incremental loads read them clustered and need no shuffle of
the history, however often they run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.parse import stamp_time, time_stamp
from ledgerline.operators.changes import full_replay, step_changes
from ledgerline.session import configure
from ledgerline.sources import std
from ledgerline.spec import LOG_TIMESTAMP, STD_FILENAME, STD_TIMESTAMP, DatasetSpec

LOG_PARTITION = "snapshot"


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partitions: Sequence[str] = (),
    keys: Sequence[str] = (),
    buckets: int = 0,
    location: str | None = None,
) -> None:
    """A typed Parquet table; an existing one stays as it is."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if partitions:
        sql += f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})"
    if buckets:
        sql += f" CLUSTERED BY ({', '.join(f'`{k}`' for k in keys)}) INTO {buckets} BUCKETS"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def create_std(spark: SparkSession, name: str, spec: DatasetSpec, buckets: int = 0, location: str | None = None) -> None:
    schema = T.StructType([*spec.schema.fields, *[T.StructField(c, T.StringType()) for c in std.BY]])
    create_table(spark, name, schema, std.BY, spec.keys, buckets, location)


def create_log(spark: SparkSession, name: str, spec: DatasetSpec, buckets: int = 0, location: str | None = None) -> None:
    schema = T.StructType([*spec.log_schema.fields, T.StructField(LOG_PARTITION, T.StringType())])
    create_table(spark, name, schema, (LOG_PARTITION,), spec.keys, buckets, location)


def write_clustered(rows: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    """Replace the partitions that *rows* belong to.

    The shuffle hashes like the buckets do, so a partition gets one file per
    bucket.
    """
    spark = configure(rows.sparkSession)  # dynamic partition overwrite
    target = spark.table(name).columns
    rows.select(*target).repartition(buckets, *[F.col(k) for k in keys]).write.mode("overwrite").insertInto(name)


def std_snapshots(spark: SparkSession, std_table: str, std_root: str, spec: DatasetSpec) -> DataFrame:
    """Partition columns, name and time of the snapshots that hold rows."""
    name = std.std_name(std_root, spec.source, spec.table, F.col("year_month"), F.col("snapshot"))
    return (
        spark.table(std_table)
        .select(*std.BY)
        .distinct()
        .select(*std.BY, name.alias(STD_FILENAME), stamp_time(F.col("snapshot")).alias(STD_TIMESTAMP))
    )


def replay_table(spark: SparkSession, std_table: str, std_root: str, spec: DatasetSpec) -> DataFrame:
    """Full replay of a Std table bucketed on the key: no row is shuffled."""
    listed = std_snapshots(spark, std_table, std_root, spec)
    return full_replay(spec, spark.table(std_table), listed, std.BY, clustered=True)


def step_table(
    spark: SparkSession, std_table: str, log_table: str, std_root: str, spec: DatasetSpec, stamp: str
) -> DataFrame:
    """Changes of one snapshot on top of a log; both tables are bucketed on the
    key, so neither the history nor the snapshot is shuffled.

    An empty snapshot, and one older than the latest load, change nothing.
    """
    log = spark.table(log_table)
    newest = log.where(F.col(LOG_PARTITION) != stamp).agg(F.max(LOG_PARTITION).alias("newest")).first()["newest"]
    found = std_snapshots(spark, std_table, std_root, spec).where(F.col("snapshot") == stamp).collect()
    if not found or (newest is not None and stamp < newest):
        return log.drop(LOG_PARTITION).limit(0)
    name = std.std_name(std_root, spec.source, spec.table, F.lit(found[0]["year_month"]), F.lit(stamp))
    return step_changes(
        spec,
        spark.table(std_table).where(F.col("snapshot") == stamp),
        log.where(F.col(LOG_PARTITION) < stamp).drop(LOG_PARTITION),
        name,
        stamp_time(F.lit(stamp)),
    )


def write_log(changes: DataFrame, log_table: str, spec: DatasetSpec, buckets: int) -> None:
    rows = changes.withColumn(LOG_PARTITION, time_stamp(F.col(LOG_TIMESTAMP)))
    write_clustered(rows, log_table, spec.keys, buckets)
