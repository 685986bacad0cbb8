"""Joins on hook columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.snapshots import local_relation

_HOT, _SPLITS, _SALT = "__hot", "__splits", "__salt"


def hot_values(rows: DataFrame, hook: str) -> DataFrame:
    """(value, splits) of hook values with more rows than one task's fair share.

    There can be no more of them than there are shuffle partitions, so they are kept as a small
    local relation; *splits* is how many fair shares a value fills.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = rows.where(F.col(hook).isNotNull()).groupBy(F.col(hook).alias("value")).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    found = counted.where(F.col("n") * tasks > total).select(
        "value", F.ceil(F.col("n") * tasks / total).cast("int").alias("splits")
    )
    kind = rows.schema[hook].dataType
    schema = T.StructType([T.StructField("value", kind), T.StructField("splits", T.IntegerType())])
    return local_relation(rows.sparkSession, [tuple(r) for r in found.collect()], schema)


def hook_join(
    left: DataFrame,
    right: DataFrame,
    hook: str,
    how: str = "left",
    right_hook: str | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join on a hook; NULL hooks never match.

    Rows without a hook take no part in the join: a left join adds them afterwards, without a
    shuffle. Rows of a value that *hot* lists (see ``hot_values``) are spread over as many salts as
    the value fills tasks, and only its right rows are repeated, once per salt. The result keeps
    every column of both sides.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"Unknown hook join '{how}'")
    other = right_hook or hook
    known, present = left.where(F.col(hook).isNotNull()), right.where(F.col(other).isNotNull())
    if hot is None:
        joined = known.join(present, known[hook] == present[other], how)
    else:
        values = hot.select(F.col("value").alias(_HOT), F.col("splits").alias(_SPLITS))
        mark = lambda side, name: side.join(F.broadcast(values), F.col(name) == F.col(_HOT), "left").drop(_HOT)
        spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.col(_SPLITS)).cast("int")
        salted = mark(known, hook).withColumn(_SALT, F.coalesce(spread, F.lit(0))).drop(_SPLITS)
        salts = F.sequence(F.lit(0), F.coalesce(F.col(_SPLITS), F.lit(1)) - 1)
        repeated = mark(present, other).withColumn(f"{_SALT}_right", F.explode(salts)).drop(_SPLITS)
        condition = (salted[hook] == repeated[other]) & (salted[_SALT] == repeated[f"{_SALT}_right"])
        joined = salted.join(repeated, condition, how).drop(_SALT, f"{_SALT}_right")
    if how == "inner":
        return joined
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema]
    # by position: both sides may name their hook alike
    return joined.union(left.where(F.col(hook).isNull()).select("*", *missing))
