"""Versions with validity intervals over the change log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.changes import current_state
from ledgerline.spec import (
    EFFECTIVE_FROM,
    EFFECTIVE_TO,
    IS_DELETED,
    LOG_DATASOURCE,
    LOG_DELETED,
    LOG_MD5,
    LOG_SOURCEFILE,
    LOG_TIMESTAMP,
    DatasetSpec,
)

_LINEAGE = (LOG_MD5, LOG_DATASOURCE, LOG_SOURCEFILE)


def frame(spec: DatasetSpec, log: DataFrame, hooks: list[Column] | None = None, slot: str | None = None) -> DataFrame:
    """One version per log row: hooks, data, lineage, half-open interval.

    The open end is NULL, the same instant in every time zone. The log may be shuffled by a column *slot* that
    follows from the key.
    """
    versions = Window.partitionBy(*([slot] if slot else []), *spec.keys).orderBy(LOG_TIMESTAMP)
    return log.select(
        *(hooks or []),
        *spec.names,
        *_LINEAGE,
        F.col(LOG_TIMESTAMP).alias(EFFECTIVE_FROM),
        F.lead(LOG_TIMESTAMP).over(versions).alias(EFFECTIVE_TO),
        F.col(LOG_DELETED).alias(IS_DELETED),
    )


def latest_of_frame(frame_rows: DataFrame) -> DataFrame:
    """Open versions of keys that still exist, without the interval."""
    return frame_rows.where(F.col(EFFECTIVE_TO).isNull() & ~F.col(IS_DELETED)).drop(
        EFFECTIVE_FROM, EFFECTIVE_TO, IS_DELETED
    )


def latest(spec: DatasetSpec, log: DataFrame, hooks: list[Column] | None = None) -> DataFrame:
    """The same rows straight from the log: no interval is computed."""
    return (
        current_state(spec, log)
        .where(~F.col(LOG_DELETED))
        .select(*(hooks or []), *spec.names, *_LINEAGE)
    )


def as_of(spec: DatasetSpec, log: DataFrame, instant: datetime, hooks: list[Column] | None = None) -> DataFrame:
    """Rows as they stood at *instant*: ``from <= t and (to is null or t < to)``.

    Later loads are left out by a filter that reaches the scan.
    """
    return latest(spec, log.where(F.col(LOG_TIMESTAMP) <= F.lit(instant)), hooks)


def as_of_frame(frame_rows: DataFrame, instant: datetime) -> DataFrame:
    at = F.lit(instant)
    return frame_rows.where(
        (F.col(EFFECTIVE_FROM) <= at)
        & (F.col(EFFECTIVE_TO).isNull() | (at < F.col(EFFECTIVE_TO)))
        & ~F.col(IS_DELETED)
    )


def open_versions(spec: DatasetSpec, frame_rows: DataFrame) -> DataFrame:
    """Keys whose number of open versions is not exactly one (should be none)."""
    is_open = F.col(EFFECTIVE_TO).isNull().cast("long")
    return frame_rows.groupBy(*spec.keys).agg(F.sum(is_open).alias("open_versions")).where("open_versions <> 1")
