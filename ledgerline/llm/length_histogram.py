"""Token counts from an exact histogram of encoded lengths.

Documents are counted by encoded length, in the tasks that encode them and then per length with
map-side combine. Sums over the histogram from its long end answer, for every context limit: how
many documents are longer, how many tokens remain if each is cut there, and quantiles. A limit
between two lengths of the histogram has the sums of the next lower one, so the histogram's lengths
stand for all limits; ``totals_at`` does that.

The sums run in two levels, over blocks of lengths and within each block, so that no task sees the
whole histogram.

Edge cases: a null text counts as empty (length 0). A null group is a group of its own. An empty
table gives an empty report. Repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import column, map_batches, written
from ledgerline.llm.library_bpe import library

#: Lengths in a block of the two-level sums.
BLOCK = 256


def lengths(docs: DataFrame, by: Sequence[str] = (), text_col: str = "text", vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """Histogram: by..., n_tokens, n_docs."""
    rows = docs.select(*[column(c).cast("string").alias(c) for c in by], F.coalesce(column(text_col), F.lit("")).cast("binary").alias("_text"))
    kinds = "".join(f"`{c}` string, " for c in by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library(vocabulary)
        for batch in batches:
            counted: dict[tuple, int] = {}
            groups = zip(*[batch.column(i).to_pylist() for i in range(len(by))]) if by else [()] * batch.num_rows
            for group, text in zip(groups, batch.column(len(by))):
                key = (*group, encoder.count(text.as_py()))
                counted[key] = counted.get(key, 0) + 1
            columns = [pa.array([k[i] for k in counted], pa.string()) for i in range(len(by))]
            columns += [pa.array([k[-1] for k in counted], pa.int64()), pa.array(list(counted.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*by, "n_tokens", "n_docs"])

    found = map_batches(rows, run, f"{kinds}n_tokens bigint, n_docs bigint")
    return found.groupBy(*[column(c) for c in by], "n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def report(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """For each length as a context limit: n_docs, docs_longer, tokens_longer, truncated_total, total_tokens, quantile."""
    held = written(histogram, "lengths").withColumn("_block", F.floor(F.col("n_tokens") / BLOCK))
    tokens = F.col("n_tokens") * F.col("n_docs")
    groups = [column(c) for c in by]
    blocks = held.groupBy(*groups, "_block").agg(F.sum("n_docs").alias("_docs"), F.sum(tokens).alias("_tokens"))
    whole = Window.partitionBy(*groups)
    above = whole.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        *[column(c).alias(f"_g{i}") for i, c in enumerate(by)],
        F.col("_block").alias("_b"),
        F.coalesce(F.sum("_docs").over(above), F.lit(0)).alias("_docs_above"),
        F.coalesce(F.sum("_tokens").over(above), F.lit(0)).alias("_tokens_above"),
        F.sum("_docs").over(whole).alias("_all_docs"),
        F.sum("_tokens").over(whole).alias("_all_tokens"),
    )
    match = F.col("_block") == F.col("_b")
    for i, c in enumerate(by):
        match &= column(c).eqNullSafe(F.col(f"_g{i}"))
    longer = Window.partitionBy(*groups, "_block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    docs_longer = F.col("_docs_above") + F.coalesce(F.sum("n_docs").over(longer), F.lit(0))
    tokens_longer = F.col("_tokens_above") + F.coalesce(F.sum(tokens).over(longer), F.lit(0))
    summed = held.join(blocks, match).withColumns({"docs_longer": docs_longer, "tokens_longer": tokens_longer})
    return summed.select(
        *groups,
        "n_tokens",
        "n_docs",
        "docs_longer",
        "tokens_longer",
        (F.col("_all_tokens") - F.col("tokens_longer") + F.col("n_tokens") * F.col("docs_longer")).alias("truncated_total"),
        F.col("_all_tokens").alias("total_tokens"),
        ((F.col("_all_docs") - F.col("docs_longer")) / F.col("_all_docs")).alias("quantile"),
    )


def totals_at(found: DataFrame, limits: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """by..., limit, docs_longer, truncated_total, total_tokens for any context limits of a report with the same groups."""
    each = F.explode(F.array(*[F.lit(int(x)).cast("bigint") for x in limits])).alias("limit")
    groups = [column(c) for c in by]
    below = found.select("*", each)
    at = F.when(F.col("n_tokens") <= F.col("limit"), F.struct("n_tokens", "docs_longer", "tokens_longer"))
    picked = below.groupBy(*groups, "limit").agg(F.max(at).alias("at"), F.max("total_tokens").alias("total_tokens"), F.sum("n_docs").alias("docs"))
    longer = F.coalesce(F.col("at.docs_longer"), F.col("docs"))
    over = F.coalesce(F.col("at.tokens_longer"), F.col("total_tokens"))
    cut = (F.col("total_tokens") - over + F.col("limit") * longer).alias("truncated_total")
    return picked.select(*groups, "limit", longer.alias("docs_longer"), cut, "total_tokens")


def length_at(found: DataFrame, share: float, by: Sequence[str] = ()) -> DataFrame:
    """by..., the smallest length that at least *share* of the documents (of each group of the report) do not exceed."""
    return found.where(F.col("quantile") >= share).groupBy(*[column(c) for c in by]).agg(F.min("n_tokens").alias("n_tokens"))
