"""Change log: append-only Parquet, one partition per load.

    <root>/<source>/<table>/version=<n>/snapshot=<YYYYMMDD_HHmm>/part-*.parquet

A rebuild writes the next version beside the current one. A version counts once
the writer's success mark is in it, so readers see the old log until the new one
is whole, and a rebuild that breaks off changes nothing.

Beside the loads of a version lies the kept state,

    version=<n>/_state/upto=<YYYYMMDD_HHmm>/part-*.parquet

the last log row of every live key after that load, without its digest, which follows from the rest. A load reads it
and the loads after it (the tail), not the log: its cost follows the snapshot, however long the history is. When the tail has grown to more than
``TAIL_LOADS`` loads, a new state is written; the one before stays until the next.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.digest import row_digest
from ledgerline.functions.parse import time_stamp
from ledgerline.operators.changes import capture_changes, current_state, full_replay
from ledgerline.operators.snapshots import local_copy
from ledgerline.session import shuffles_freed
from ledgerline.sources import std
from ledgerline.sources.files import CODEC, parquet, parts_of, partition_values, path_exists, remove_folder
from ledgerline.spec import LOG_DELETED, LOG_MD5, LOG_TIMESTAMP, DatasetSpec

PARTITION = "snapshot"
VERSION = "version"
#: Loads that are read beside the kept state before it is written anew.
TAIL_LOADS = 8


def folder(root: str, spec: DatasetSpec) -> str:
    return f"{root.rstrip('/')}/{spec.source}/{spec.table}"


def versions(spark: SparkSession, root: str, spec: DatasetSpec) -> list[int]:
    """Numbers of the versions that are there, whole or not, in order."""
    return sorted(int(v) for v in partition_values(spark, folder(root, spec), VERSION))


def version_folder(root: str, spec: DatasetSpec, number: int) -> str:
    return f"{folder(root, spec)}/{VERSION}={number}"


def current_version(spark: SparkSession, root: str, spec: DatasetSpec) -> int | None:
    """The newest version that was written to its end."""
    whole = (v for v in reversed(versions(spark, root, spec)) if path_exists(spark, f"{version_folder(root, spec, v)}/_SUCCESS"))
    return next(whole, None)


def current_folder(spark: SparkSession, root: str, spec: DatasetSpec) -> str:
    """Folder of the current version; of the first one to come if there is none."""
    number = current_version(spark, root, spec)
    if number is None:
        number = max(versions(spark, root, spec), default=0) + 1
    return version_folder(root, spec, number)


def scan(spark: SparkSession, root: str, spec: DatasetSpec) -> DataFrame:
    """The change log with its partition column, for pruning by load."""
    schema = T.StructType([*spec.log_schema.fields, T.StructField(PARTITION, T.StringType())])
    return parquet(spark, current_folder(spark, root, spec), schema)


def read(spark: SparkSession, root: str, spec: DatasetSpec) -> DataFrame:
    return scan(spark, root, spec).drop(PARTITION)


def until(spark: SparkSession, root: str, spec: DatasetSpec, instant: datetime) -> DataFrame:
    """Log rows of the loads up to *instant*, pruned by partition."""
    return scan(spark, root, spec).where(F.col(PARTITION) <= time_stamp(F.lit(instant))).drop(PARTITION)


def _write(rows: DataFrame, path: str, overwrite: str, gather: bool = True) -> None:
    """Write by load. REBALANCE gathers a load's rows into few files and splits
    a load that is far larger than the others; digests cross its shuffle as bytes. The first load holds every
    key: its tasks are as large as its files should be, so it need not be gathered."""
    rows = rows.withColumn(PARTITION, time_stamp(F.col(LOG_TIMESTAMP)))
    if gather:
        rows = rows.withColumn(LOG_MD5, F.unhex(LOG_MD5)).hint("rebalance", F.col(PARTITION))
        rows = rows.withColumn(LOG_MD5, F.lower(F.hex(LOG_MD5)))
    with shuffles_freed(rows.sparkSession):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", overwrite)
            .option("compression", CODEC)
            .partitionBy(PARTITION)
            .parquet(path)
        )


def rebuild(spark: SparkSession, root: str, std_root: str, spec: DatasetSpec) -> None:
    """Replace the log by a replay of every Std snapshot.

    The version before stays for readers that have begun; what is older goes.
    """
    found = std.scan(spark, std_root, spec)
    rows = full_replay(spec, found, std.snapshots(spark, std_root, spec), std.BY, count=found.count())  # footers only
    before, known = current_version(spark, root, spec), versions(spark, root, spec)
    _write(rows, version_folder(root, spec, max(known, default=0) + 1), "static")
    for number in known:
        if number != before:
            remove_folder(spark, version_folder(root, spec, number))


# Kept state


def _state_folder(path: str, upto: str | None = None) -> str:
    return f"{path}/_state" + (f"/upto={upto}" if upto else "")


def kept_states(spark: SparkSession, path: str) -> list[str]:
    """Loads after which a whole state was kept, in order."""
    found = partition_values(spark, _state_folder(path), "upto")
    return [s for s in found if path_exists(spark, f"{_state_folder(path, s)}/_SUCCESS")]


def _state_schema(spec: DatasetSpec) -> T.StructType:
    return T.StructType([f for f in spec.log_schema.fields if f.name != LOG_MD5])


def state_rows(spark: SparkSession, path: str, spec: DatasetSpec, loads: list[str]) -> DataFrame:
    """Log rows of which the latest per key are the state after *loads*: the kept state and the loads after it."""
    kept = [s for s in kept_states(spark, path) if loads and s <= loads[-1]]
    base = None
    if kept:
        base = parquet(spark, _state_folder(path, kept[-1]), _state_schema(spec))
        base = base.withColumn(LOG_MD5, row_digest(spec.schema, spec.digest_columns)).select(*spec.log_schema.names)
    tail = [f"{path}/{PARTITION}={s}" for s in loads if not kept or s > kept[-1]]
    if tail:
        rows = spark.read.schema(spec.log_schema).parquet(*tail)
        return rows if base is None else base.unionByName(rows)
    return spark.createDataFrame([], spec.log_schema) if base is None else base


def keep_state(spark: SparkSession, path: str, spec: DatasetSpec, tail_loads: int = TAIL_LOADS) -> None:
    """Write the state after the newest load if the tail is longer than *tail_loads*."""
    loads, kept = partition_values(spark, path, PARTITION), kept_states(spark, path)
    if sum(not kept or s > kept[-1] for s in loads) <= tail_loads:
        return
    held = state_rows(spark, path, spec, loads).drop(LOG_MD5)
    rows = current_state(spec, held, held.count()).where(~F.col(LOG_DELETED))
    with shuffles_freed(spark):
        rows.write.mode("overwrite").option("compression", CODEC).parquet(_state_folder(path, loads[-1]))
    for old in kept[:-1]:
        remove_folder(spark, _state_folder(path, old))


# Loads


def changes_of(
    spark: SparkSession, root: str, std_root: str, spec: DatasetSpec, stamps: list[str]
) -> tuple[DataFrame | None, list[str]]:
    """Changes of the given Std snapshots on top of the loads before them, and the snapshots taken."""
    path = current_folder(spark, root, spec)
    others = [s for s in partition_values(spark, path, PARTITION) if s not in set(stamps)]
    # every partition after the newest of the others belongs to this batch
    wanted = std.snapshots(spark, std_root, spec).where(F.col(PARTITION).isin(stamps))
    if others:
        wanted = wanted.where(F.col(PARTITION) > others[-1])
    listed = local_copy(wanted, len(stamps))
    if listed is None:
        raise ValueError(f"{spec.code}: a snapshot exists under two months")
    taken = sorted(r[PARTITION] for r in listed.select(PARTITION).collect())
    if not taken:
        return None, []
    for stale in kept_states(spark, path):
        if stale >= taken[0]:  # it holds rows of a load that is about to be written again
            remove_folder(spark, _state_folder(path, stale))
    found, held = std.scan(spark, std_root, spec).where(F.col(PARTITION).isin(taken)), state_rows(spark, path, spec, others)
    changes = capture_changes(
        spec, found, log=held, snapshots=listed, by=std.BY, count=found.count(), log_count=held.count()
    )
    return changes, taken


def load(
    spark: SparkSession, root: str, std_root: str, spec: DatasetSpec, stamps: list[str], tail_loads: int = TAIL_LOADS
) -> list[str]:
    """Add the changes of the given Std snapshots; return those taken.

    Snapshots older than the latest load are ignored. Each load owns its
    partition, and the state is read from the others: a rerun, or a retry after
    a crash, writes the same partitions again instead of adding rows.
    """
    changes, taken = changes_of(spark, root, std_root, spec, stamps)
    if changes is None:
        return []
    path = current_folder(spark, root, spec)
    held = {s: _files(spark, path, s) for s in taken if path_exists(spark, f"{path}/{PARTITION}={s}")}
    begun = current_version(spark, root, spec) is not None
    # only a static write leaves the success mark
    _write(changes, path, "dynamic" if begun else "static", gather=begun or len(taken) > 1)
    for stamp, before in held.items():
        if _files(spark, path, stamp) == before:  # a snapshot that no longer changes anything wrote no file
            remove_folder(spark, f"{path}/{PARTITION}={stamp}")
    keep_state(spark, path, spec, tail_loads)
    return taken


def _files(spark: SparkSession, path: str, stamp: str) -> list[str]:
    return [name for name, _ in parts_of(spark, f"{path}/{PARTITION}={stamp}")]
