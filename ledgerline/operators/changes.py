"""Change capture: snapshots in, an append-only change log out.

All modes are one window over the business key. A key occurs at most once in a
snapshot (the Std step rejects anything else, and the window below fails on
it), so a window group never holds more rows than there are snapshots and log
entries of that key, however the keys are distributed.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.digest import row_digest
from ledgerline.operators.snapshots import BY_FILE, SEQ, distinct_snapshots, numbered_snapshots
from ledgerline.spec import (
    LOG_DATASOURCE,
    LOG_DELETED,
    LOG_MD5,
    LOG_SOURCEFILE,
    LOG_TIMESTAMP,
    STD_FILENAME,
    STD_MD5,
    STD_TIMESTAMP,
    DatasetSpec,
)

_DIGEST = "__digest"

#: Rows of a history that a task sorts on average, at most: some 150 MB, replay and versions together.
ROWS_A_TASK = 250_000

#: Which values a deletion row repeats.
FROM_OBSERVATION = "observation"
FROM_LOG = "log"


def by_key(keys: tuple[str, ...], rows: DataFrame, count: int | None = None) -> DataFrame:
    """*rows* shuffled by key, for tasks that sort at most *count* rows in all.

    Adaptive execution gathers tasks by their compressed bytes, and the rows of a history compress well, so
    that a task can come to hold many times what was aimed at. A known count sets the width instead.
    """
    if count is None or count <= ROWS_A_TASK:
        return rows.repartition(*keys)
    width = max(ceil(count / ROWS_A_TASK), rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(width, *keys)


def with_digest(spec: DatasetSpec, rows: DataFrame) -> DataFrame:
    """Add the digest of the columns that are neither key nor volatile."""
    return rows.withColumn(STD_MD5, row_digest(spec.schema, spec.digest_columns))


def _state(spec: DatasetSpec, log: DataFrame, count: int | None = None) -> DataFrame:
    """Live keys of the log, placed before the first snapshot (sequence number 0).

    One row per key leaves the log side, and one per key and task crosses its shuffle, however long
    the history is. A key whose last row is a deletion counts as never seen: its return is a change
    either way.
    """
    return current_state(spec, log, count).where(~F.col(LOG_DELETED)).select(*spec.names, F.lit(0).alias(SEQ))


def _marked(spec: DatasetSpec, rows: DataFrame, seeded: bool) -> DataFrame:
    """Add whether a row enters the log (``__changed``) and whether its key is gone after it (``__vanished``).

    One window over the key; *seeded* rows with sequence number 0 are the state before.
    """
    key = Window.partitionBy(*spec.keys).orderBy(SEQ)
    seq, digest = F.col(SEQ), F.col(_DIGEST)
    prev_seq, next_seq = F.col("__prev_seq"), F.col("__next_seq")
    rows = rows.select(
        "*",
        F.lag(_DIGEST).over(key).alias("__prev_digest"),
        F.lag(SEQ).over(key).alias("__prev_seq"),
        F.lead(SEQ).over(key).alias("__next_seq"),
    )
    changed = prev_seq.isNull() | (prev_seq < seq - 1) | (F.col("__prev_digest") != digest)
    vanished = next_seq.isNull() | (next_seq > seq + 1)
    if seeded:
        changed = (seq > 0) & changed
    twice = (seq > 0) & (prev_seq == seq)
    failure = F.raise_error(duplicate_message(spec)).cast("boolean")
    return rows.withColumns({"__changed": F.when(twice, failure).otherwise(changed), "__vanished": vanished})


def duplicate_message(spec: DatasetSpec) -> Column:
    return F.concat(
        F.lit(f"{spec.code}: duplicate key ("),
        F.concat_ws(", ", *[F.col(f"`{k}`").cast("string") for k in spec.keys]),
        F.lit(") in one snapshot"),
    )


def _events(rows: DataFrame) -> DataFrame:
    """One row per event of marked rows: False enters the change, True the deletion after it."""
    events = (
        F.when(F.col("__changed") & F.col("__vanished"), F.array(F.lit(False), F.lit(True)))
        .when(F.col("__changed"), F.array(F.lit(False)))
        .when(F.col("__vanished"), F.array(F.lit(True)))
    )
    return rows.withColumn(LOG_DELETED, F.explode(events))


def capture_changes(
    spec: DatasetSpec,
    observations: DataFrame,
    log: DataFrame | None = None,
    snapshots: DataFrame | None = None,
    by: tuple[str, ...] = BY_FILE,
    deletions_repeat: str | None = None,
    clustered: bool = False,
    count: int | None = None,
    log_count: int | None = None,
) -> DataFrame:
    """Change rows of *observations* on top of what *log* already holds.

    *observations* are typed rows; the columns *by* tell their snapshot.
    Without a log this is the full replay; with a log and one snapshot the
    incremental step; with a log and several snapshots a seeded replay.
    *snapshots* (*by*, name and time of those with rows) saves listing them
    from the rows.

    A deletion row repeats the last observation of the key in a full replay
    and the last log row otherwise; *deletions_repeat* overrides that.

    Only key, data and the snapshot number cross the one shuffle, and of the log what tells its
    newest rows; names and times of snapshots are joined to the emitted rows. Rows that are already
    *clustered* (tables bucketed on the key) cross none. *count* and *log_count*, the rows of
    both sides if they are known, set the number of tasks.
    """
    repeat = deletions_repeat or (FROM_OBSERVATION if log is None else FROM_LOG)
    if repeat not in (FROM_OBSERVATION, FROM_LOG):
        raise ValueError(f"Unknown deletions_repeat '{repeat}'")

    numbered = numbered_snapshots(observations, snapshots, by)
    rows = observations.join(numbered.select(*by, SEQ), list(by)).select(*spec.names, SEQ)
    if log is not None:
        count = None if count is None or log_count is None else count + log_count
        if not clustered and count is not None and count > ROWS_A_TASK:
            # both sides into the same partitions, so that the state is not shuffled once more with the snapshots
            rows, log, log_count, clustered = by_key(spec.keys, rows, count), by_key(spec.keys, log, count), None, True
        rows = rows.unionByName(_state(spec, log, log_count))

    # the window below reuses this partitioning; the digest is computed on its
    # far side, spread evenly and not part of the shuffle
    if not clustered:
        rows = by_key(spec.keys, rows, count)
    rows = _marked(spec, rows.withColumn(_DIGEST, F.unhex(row_digest(spec.schema, spec.digest_columns))), log is not None)
    key, seq = Window.partitionBy(*spec.keys).orderBy(SEQ), F.col(SEQ)

    payload = [F.col(f"`{n}`") for n in spec.payload]
    if repeat == FROM_LOG:
        # values of the last row that entered the log, for the deletion row
        logged = F.last(F.when(F.col("__changed") | (seq == 0), F.struct(*payload)), ignorenulls=True)
        rows = rows.withColumn(
            "__logged", logged.over(key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        )

    deleted = F.col(LOG_DELETED)
    rows = _events(rows)
    if repeat == FROM_LOG:
        payload = [
            F.when(deleted, F.col(f"__logged.`{n}`")).otherwise(F.col(f"`{n}`")).alias(n) for n in spec.payload
        ]
    rows = rows.select(
        *spec.keys,
        *payload,
        F.lower(F.hex(_DIGEST)).alias(LOG_MD5),
        F.when(deleted, seq + 1).otherwise(seq).alias(SEQ),
        LOG_DELETED,
    )
    # inner: a key missing after the last snapshot is not missing from anything
    return rows.join(numbered.select(SEQ, STD_FILENAME, STD_TIMESTAMP), SEQ).select(
        *spec.names,
        LOG_MD5,
        F.col(STD_TIMESTAMP).alias(LOG_TIMESTAMP),
        F.lit(spec.code).alias(LOG_DATASOURCE),
        F.col(STD_FILENAME).alias(LOG_SOURCEFILE),
        LOG_DELETED,
    )


def full_replay(
    spec: DatasetSpec,
    observations: DataFrame,
    snapshots: DataFrame | None = None,
    by: tuple[str, ...] = BY_FILE,
    clustered: bool = False,
    count: int | None = None,
) -> DataFrame:
    """Change log of every snapshot, oldest first, in one pass."""
    return capture_changes(spec, observations, snapshots=snapshots, by=by, clustered=clustered, count=count)


def incremental_changes(
    spec: DatasetSpec,
    observations: DataFrame,
    log: DataFrame,
    snapshots: DataFrame | None = None,
    by: tuple[str, ...] = BY_FILE,
) -> DataFrame:
    """Change rows of new snapshots against the current state of *log*.

    Snapshots older than the latest load are ignored; loading one again adds
    nothing.
    """
    if snapshots is None:
        snapshots = distinct_snapshots(observations, by)
    newest = log.agg(F.max(LOG_TIMESTAMP)).scalar()
    snapshots = snapshots.where(F.coalesce(F.col(STD_TIMESTAMP) >= newest, F.lit(True)))
    return capture_changes(spec, observations, log=log, snapshots=snapshots, by=by)


def step_changes(
    spec: DatasetSpec, incoming: DataFrame, log: DataFrame, file: Column, time: Column
) -> DataFrame:
    """Changes of one snapshot as one full outer join with the live state.

    The same rows as ``capture_changes``; a key that occurs twice fails, too. Worth
    it where both sides are bucketed on the key: neither is then shuffled.
    """
    twice = Window.partitionBy(*spec.keys).orderBy(F.lit(0))  # clustered like the join below, so it shuffles nothing
    incoming = incoming.withColumn("__nth", F.row_number().over(twice))
    guarded = F.when(F.col("__nth") > 1, F.raise_error(duplicate_message(spec)).cast("boolean")).otherwise(F.lit(True))
    incoming = incoming.where(guarded)
    live = current_state(spec, log).where(~F.col(LOG_DELETED))
    old = live.select(*[F.col(f"`{n}`").alias(f"old_{n}") for n in spec.names], F.col(LOG_MD5).alias("__old_digest"))
    new = with_digest(spec, incoming.select(*spec.names))
    same_key = [new[k] == old[f"old_{k}"] for k in spec.keys]
    condition = same_key[0]
    for other in same_key[1:]:
        condition = condition & other
    gone = F.col(STD_MD5).isNull()
    return (
        new.join(old, condition, "full_outer")
        .where(gone | F.col("__old_digest").isNull() | (F.col("__old_digest") != F.col(STD_MD5)))
        .select(
            *[F.when(gone, F.col(f"`old_{n}`")).otherwise(F.col(f"`{n}`")).alias(n) for n in spec.names],
            F.coalesce(STD_MD5, "__old_digest").alias(LOG_MD5),
            time.alias(LOG_TIMESTAMP),
            F.lit(spec.code).alias(LOG_DATASOURCE),
            file.alias(LOG_SOURCEFILE),
            gone.alias(LOG_DELETED),
        )
    )


def current_state(spec: DatasetSpec, log: DataFrame, count: int | None = None) -> DataFrame:
    """Latest log row of every key, deletions included.

    ``row_number() = 1`` lets Spark keep one row per key and task before the
    shuffle. A log of *count* rows that is too large for that, since the tasks that read it would
    sort whole files, is shuffled first.
    """
    if count is not None and count > ROWS_A_TASK:
        log = by_key(spec.keys, log, count)
    newest_first = Window.partitionBy(*spec.keys).orderBy(
        F.col(LOG_TIMESTAMP).desc(), F.col(LOG_SOURCEFILE).desc(), F.col(LOG_DELETED).desc()
    )
    return log.withColumn("__rank", F.row_number().over(newest_first)).where("__rank = 1").drop("__rank")


def empty_log(spark, spec: DatasetSpec) -> DataFrame:
    return spark.createDataFrame([], T.StructType(spec.log_schema.fields))
