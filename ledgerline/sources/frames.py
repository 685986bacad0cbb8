"""Maintained frame: versions with their intervals, brought up to date load by load.

    <root>/<source>/<table>/version=<n>/state=<open|closed>/load=<stamp>/bucket=<b>/part-*.parquet

``version`` is that of the log. Keys are spread over buckets by hash. A load reads its own change rows and the
open versions of the buckets they fall into. It writes the intervals that it closes, and those buckets
anew; what no change falls into, and every interval closed before, is neither read nor written. A
reader takes each bucket from the newest load that wrote it.

A load counts once its mark lies in ``_loads``; the mark names the log files that were applied. A load that
broke off writes the same folders again from the load before it, so readers never see half of one.
"""

from __future__ import annotations

import hashlib
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import versions
from ledgerline.operators.changes import ROWS_A_TASK
from ledgerline.session import shuffles_freed
from ledgerline.sources import log
from ledgerline.sources.files import CODEC, partition_values, parts_of, path_exists, remove_folder, touch
from ledgerline.spec import (
    EFFECTIVE_FROM,
    EFFECTIVE_TO,
    IS_DELETED,
    LOG_MD5,
    LOG_TIMESTAMP,
    DatasetSpec,
)
from ledgerline.functions.parse import time_stamp

OPEN, CLOSED = "open", "closed"
#: Buckets of a frame: so many that one of them fits a few tasks.
BUCKETS = 64
#: Newest loads whose open versions stay as they were, to go on from if a later load is written again.
KEPT = 3


def schema(spec: DatasetSpec) -> T.StructType:
    known = {f.name: f for f in spec.log_schema.fields}
    return T.StructType(
        [
            *spec.schema.fields,
            *[known[n] for n in versions._LINEAGE],
            T.StructField(EFFECTIVE_FROM, T.TimestampType()),
            T.StructField(EFFECTIVE_TO, T.TimestampType()),
            T.StructField(IS_DELETED, T.BooleanType()),
        ]
    )


def folder(root: str, spec: DatasetSpec, version: int) -> str:
    return f"{log.version_folder(root, spec, version)}"


def loads(spark: SparkSession, path: str) -> list[str]:
    """Loads that the frame holds, in order."""
    return partition_values(spark, f"{path}/_loads", "load")


def _bucket(spec: DatasetSpec, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in spec.keys]), F.lit(buckets)).cast("int")


def _open_folders(spark: SparkSession, path: str, upto: str, wanted: set[str] | None = None) -> list[str]:
    """Of each bucket the folder of the newest load up to *upto* that wrote it."""
    newest: dict[str, str] = {}
    for load in partition_values(spark, f"{path}/state={OPEN}", "load"):
        if load <= upto:
            for bucket in partition_values(spark, f"{path}/state={OPEN}/load={load}", "bucket"):
                newest[bucket] = load
    return [f"{path}/state={OPEN}/load={load}/bucket={b}" for b, load in newest.items() if wanted is None or b in wanted]


def _rows(spark: SparkSession, spec: DatasetSpec, path: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema(spec))
    return spark.read.schema(schema(spec)).option("basePath", path).parquet(*folders).select(*schema(spec).names)


def _slots(rows: DataFrame, spec: DatasetSpec, buckets: int, count: int) -> DataFrame:
    """*rows*, *count* in all, shuffled by key into tasks (``__slot``) that hold whole buckets or a part of one.

    Such a task can sort its rows by key and write them too, to one file of each bucket, so they are shuffled once.
    Digests cross as bytes.
    """
    width = max(ceil(count / ROWS_A_TASK), min(rows.sparkSession.sparkContext.defaultParallelism, buckets))
    slot = F.pmod(_bucket(spec, buckets), F.lit(width))
    if width > buckets:
        width = ceil(width / buckets) * buckets  # pmod by it tells the bucket, too
        slot = _bucket(spec, width)
    return rows.withColumns({"__slot": slot, LOG_MD5: F.unhex(LOG_MD5)}).repartitionById(width, F.col("__slot"))


def _write(rows: DataFrame, spec: DatasetSpec, path: str, load: Column, buckets: int) -> None:
    state = F.when(F.col(EFFECTIVE_TO).isNull(), OPEN).otherwise(CLOSED)
    rows = rows.withColumn(LOG_MD5, F.lower(F.hex(LOG_MD5))).select(*schema(spec).names)
    rows = rows.withColumns({"state": state, "load": load, "bucket": _bucket(spec, buckets)})
    with shuffles_freed(rows.sparkSession):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC).partitionBy(
            "state", "load", "bucket"
        ).parquet(path)


def apply_load(spark: SparkSession, spec: DatasetSpec, log_path: str, path: str, load: str, buckets: int = BUCKETS) -> None:
    """Bring the frame from the load before *load* to *load*."""
    before = [s for s in loads(spark, path) if s < load]
    changes = spark.read.schema(spec.log_schema).parquet(f"{log_path}/{log.PARTITION}={load}")
    none = F.lit(None).cast("timestamp")
    new = changes.select(
        *spec.names, *versions._LINEAGE, F.col(LOG_TIMESTAMP).alias(EFFECTIVE_FROM), none.alias(EFFECTIVE_TO),
        F.col("___Lake_isdeleted").alias(IS_DELETED),
    )
    touched = {str(r["bucket"]) for r in changes.select(_bucket(spec, buckets).alias("bucket")).distinct().collect()}  # at most *buckets*
    held = _rows(spark, spec, path, _open_folders(spark, path, before[-1], touched) if before else [])
    count = held.count() + changes.count()  # footers only
    rows = held.withColumn("__new", F.lit(False)).unionByName(new.withColumn("__new", F.lit(True)))
    # a key has at most one change in a load, which closes its open version
    until = F.max(F.when(F.col("__new"), F.col(EFFECTIVE_FROM))).over(Window.partitionBy("__slot", *spec.keys))
    closing = ~F.col("__new")
    for k in spec.keys:
        closing = closing & F.col(f"`{k}`").isNotNull()
    rows = _slots(rows, spec, buckets, count).withColumn(EFFECTIVE_TO, F.when(closing, until))
    _write(rows, spec, path, F.lit(load), buckets)
    touch(spark, _mark(spark, log_path, path, load))


def build(spark: SparkSession, spec: DatasetSpec, log_path: str, path: str, upto: list[str], buckets: int = BUCKETS) -> None:
    """The frame of all loads *upto* in one pass; each interval lies under the load that closed it."""
    rows = spark.read.schema(spec.log_schema).parquet(*[f"{log_path}/{log.PARTITION}={s}" for s in upto])
    load = F.coalesce(time_stamp(F.col(EFFECTIVE_TO)), F.lit(upto[-1]))
    rows = _slots(rows, spec, buckets, rows.count())  # counted from footers
    _write(versions.frame(spec, rows, slot="__slot"), spec, path, load, buckets)
    for stamp in upto:
        touch(spark, _mark(spark, log_path, path, stamp))


def refresh(spark: SparkSession, lake_root: str, root: str, spec: DatasetSpec, buckets: int = BUCKETS) -> list[str]:
    """Bring the frame up to the log; return the loads that were applied.

    A new version of the log begins a new frame. Loads whose log partition was written again, or is gone, and
    those after them are undone first; if that goes back further than the ``KEPT`` newest, the frame is built anew.
    """
    version = log.current_version(spark, lake_root, spec)
    if version is None:
        return []
    log_path, path = log.version_folder(lake_root, spec, version), folder(root, spec, version)
    stamps, known = partition_values(spark, log_path, log.PARTITION), loads(spark, path)
    same = 0
    while same < min(len(stamps), len(known)) and stamps[same] == known[same] and _holds(spark, log_path, path, stamps[same]):
        same += 1
    stale = known[same:]
    if stale and (same == 0 or len(stale) >= KEPT or not path_exists(spark, f"{path}/state={OPEN}/load={known[same - 1]}")):
        remove_folder(spark, path)
        same = 0
    else:
        for load in reversed(stale):
            _forget(spark, path, load)
    todo = stamps[same:]
    if same == 0 and len(stamps) > 1:
        build(spark, spec, log_path, path, stamps[:-1], buckets)
        todo = stamps[-1:]
    for stamp in todo:
        _forget(spark, path, stamp)  # what a load that broke off has left
        apply_load(spark, spec, log_path, path, stamp, buckets)
    _drop_replaced(spark, path)
    return stamps[same:]


def _mark(spark: SparkSession, log_path: str, path: str, load: str) -> str:
    """Mark of a load: it names the files of the log partition that were applied."""
    names = sorted(name.rsplit("/", 1)[1] for name, _ in parts_of(spark, f"{log_path}/{log.PARTITION}={load}"))
    return f"{path}/_loads/load={load}/{hashlib.md5(' '.join(names).encode()).hexdigest()}"


def _holds(spark: SparkSession, log_path: str, path: str, load: str) -> bool:
    return path_exists(spark, _mark(spark, log_path, path, load))


def _forget(spark: SparkSession, path: str, load: str) -> None:
    for part in (f"_loads/load={load}", f"state={OPEN}/load={load}", f"state={CLOSED}/load={load}"):
        if path_exists(spark, f"{path}/{part}"):
            remove_folder(spark, f"{path}/{part}")


def _drop_replaced(spark: SparkSession, path: str) -> None:
    """Remove open buckets that none of the ``KEPT`` newest loads reads."""
    known = loads(spark, path)
    used = {f for upto in known[-KEPT:] for f in _open_folders(spark, path, upto)}
    for load in partition_values(spark, f"{path}/state={OPEN}", "load"):
        for bucket in partition_values(spark, f"{path}/state={OPEN}/load={load}", "bucket"):
            one = f"{path}/state={OPEN}/load={load}/bucket={bucket}"
            if one not in used and known and load < known[-1]:
                remove_folder(spark, one)


def read(spark: SparkSession, lake_root: str, root: str, spec: DatasetSpec, hooks: list[Column] | None = None, current: bool = False) -> DataFrame:
    """The frame, or its open versions alone (*current*), with hook columns."""
    version = log.current_version(spark, lake_root, spec)
    path = folder(root, spec, version) if version is not None else ""
    known = loads(spark, path) if version is not None else []
    folders = _open_folders(spark, path, known[-1]) if known else []
    if not current:
        folders += [f"{path}/state={CLOSED}/load={s}" for s in known if path_exists(spark, f"{path}/state={CLOSED}/load={s}")]
    return _rows(spark, spec, path, folders).select(*(hooks or []), *schema(spec).names)
