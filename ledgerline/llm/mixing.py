"""Mixing sources to target weights by Pfair scheduling.

The rows of a source are put in a hashed order and cut into blocks. With weight ``w`` of ``W``,
block ``k`` of a source is released at slot ``floor(k W / w)`` and is due by slot
``ceil((k + 1) W / w)``. Every slot takes, among the released blocks, the one with the earliest
deadline (ties: the source named first). After any number of slots each source then is less than one
block away from its share. The windows repeat every ``W`` slots, so the schedule is worked out for
one period only (``W`` and the number of weights are parameters, hence bounded), and every further
block follows from it by arithmetic.

A source is never gathered: its rows are counted per bin of the hashed order, the bins are summed,
and rows are numbered within a bin. A source with a third of all rows has as many bins as any other.
The place of a row in the mix is a sum over sources of the rows scheduled before its slot.

Edge cases: rows whose source is null or not among the weights form one more source with
``rest_weight``. All rows are kept: a source that runs out leaves its slots to be skipped, and the
deviation bound holds until the first one does. Rows with equal ids are ordered by their other
columns; rows that are equal altogether are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import column, unused

#: Rows of a block, unless the caller says otherwise.
BLOCK_ROWS = 16
#: Bits of the hashed order, and the bits of it that number the bins.
ORDER_BITS, BIN_BITS = 60, 10


def schedule(spark: SparkSession, shares: list[int]) -> DataFrame:
    """One period: slot, stream, nth (block of the stream in the period), before (blocks of each stream before the slot)."""
    period = sum(shares)
    w = F.array(*[F.lit(s) for s in shares])

    def step(done: Column, slot: Column) -> Column:
        """The stream that slot *slot* goes to, given the blocks *done* of each stream."""
        windows = F.transform(
            done,
            lambda k, s: F.struct(
                F.ceil((k + 1) * period / F.get(w, s)).alias("due"), s.alias("stream"), F.floor(k * period / F.get(w, s)).alias("release")
            ),
        )
        return F.array_min(F.filter(windows, lambda x: x.release <= slot)).stream

    def add(state: Column, slot: Column) -> Column:
        return F.get(
            F.transform(
                F.array(step(state.done, slot)),
                lambda s: F.struct(
                    F.transform(state.done, lambda k, i: F.when(i == s, k + 1).otherwise(k)).alias("done"),
                    F.concat(state.picks, F.array(F.struct(s.alias("stream"), F.get(state.done, s).alias("nth"), state.done.alias("before")))).alias("picks"),
                ),
            ),
            F.lit(0),
        )

    kind = "array<struct<stream:int,nth:int,before:array<int>>>"
    start = F.struct(F.array(*[F.lit(0) for _ in shares]).alias("done"), F.array().cast(kind).alias("picks"))
    slots = F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, add, lambda state: state.picks)
    return spark.range(1).select(F.posexplode(slots).alias("slot", "pick")).select("slot", "pick.stream", "pick.nth", "pick.before")


def mix(
    docs: DataFrame,
    weights: Mapping[str, int],
    rest_weight: int = 1,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
    seed: str = "mix",
    names: tuple[str, str, str] = ("block", "slot", "position"),
) -> DataFrame:
    """*docs* with the block of each row in its source, the slot of the block, and the row's place in the mix."""
    spark = docs.sparkSession
    shares = [*weights.values(), rest_weight]
    if min(shares) < 1 or block_rows < 1:
        raise ValueError("weights and block_rows must be positive")
    period, rest = sum(shares), len(shares) - 1
    stream, order, bin_, start, rank, tie = unused(docs, "_stream", "_order", "_bin", "_start", "_rank", "_tie")

    known = F.create_map(*[F.lit(x) for pair in ((k, i) for i, k in enumerate(weights)) for x in pair]) if weights else None
    number = F.coalesce(F.try_element_at(known, column(source_col).cast("string")), F.lit(rest)) if weights else F.lit(rest)
    text = F.concat_ws("\x1f", F.lit(seed), F.coalesce(column(id_col).cast("string"), F.lit("")))
    hashed = F.conv(F.substring(F.md5(text.cast("binary")), 1, ORDER_BITS // 4), 16, 10).cast("bigint")
    keyed = docs.withColumns({stream: number, order: hashed, tie: F.xxhash64(*[column(c) for c in docs.columns])})
    keyed = keyed.withColumn(bin_, F.shiftright(F.col(order), ORDER_BITS - BIN_BITS).cast("int"))

    counts = keyed.groupBy(stream, bin_).agg(F.count("*").alias("n"))  # streams * bins rows at most
    before = Window.partitionBy(stream).orderBy(bin_).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(stream, bin_, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start))
    totals = {r[0]: r[1] for r in counts.groupBy(stream).agg(F.sum("n")).collect()}  # one row per weight

    within = Window.partitionBy(stream, bin_).orderBy(order, column(id_col), tie)
    ranked = keyed.withColumn(rank, F.row_number().over(within)).join(F.broadcast(starts), [stream, bin_])
    ranked = ranked.withColumn(rank, F.col(rank) - 1 + F.col(start))
    w = F.array(*[F.lit(s) for s in shares])
    block = F.floor(F.col(rank) / block_rows)
    mine = F.get(w, F.col(stream))
    plan = schedule(spark, shares).select(
        F.col("slot").alias("_plan_slot"), F.col("stream").alias("_plan_stream"), F.col("nth").alias("_plan_nth"), F.col("before").alias("_plan_before")
    )
    placed = ranked.withColumn(names[0], block).join(
        F.broadcast(plan), (F.col(stream) == F.col("_plan_stream")) & (F.pmod(block, mine) == F.col("_plan_nth"))
    )
    turn = F.floor(F.col(names[0]) / mine)
    sizes = F.array(*[F.lit(int(totals.get(i, 0))).cast("bigint") for i in range(len(shares))])
    ahead = F.aggregate(
        F.zip_with(
            F.zip_with(w, F.col("_plan_before"), lambda a, b: (turn * a + b) * block_rows), sizes, lambda rows, most: F.least(rows, most)
        ),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x,
    )
    return placed.select(
        *[column(c) for c in docs.columns],
        F.col(names[0]).cast("bigint").alias(names[0]),
        (turn * period + F.col("_plan_slot")).cast("bigint").alias(names[1]),
        (ahead + F.pmod(F.col(rank), F.lit(block_rows))).cast("bigint").alias(names[2]),
    )


def in_mixed_order(docs: DataFrame, weights: Mapping[str, int], rest_weight: int = 1, **options) -> DataFrame:
    """The rows of *docs*, sorted as the mix has them."""
    names = tuple(unused(docs, "_block", "_slot", "_position"))
    mixed = mix(docs, weights, rest_weight, names=names, **options)
    return mixed.orderBy(names[2]).select(*[column(c) for c in docs.columns])
