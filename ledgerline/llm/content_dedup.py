"""Exact dedup by content sort.

Rows are dealt by sampled splitters over (first bytes of the normalised text, hash of the whole
text), sorted, and compared in full with their neighbours: the window below groups by the whole
normalised text, not by a digest. The hash in the splitter keeps texts with a common beginning
(a licence line, say) from meeting in one range; nothing depends on it.

A group of copies with more than its share of the rows or bytes would still fill one range. Such
groups (at most four for each range, so their list is bounded) are found by a count per hash with
map-side combine, and their rows are spread over salts. Each salt is sorted and compared like any
other range and yields one row; those few rows are then merged.

Edge cases: a null text counts as empty. Rows without an id lose against any id; if no row of a
group has one, ``keep_id`` is null and one of them stays. Equal ids in one group: exactly one row
stays. An empty table gives an empty result. Columns of the input are never touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_lower, column, unused, written

#: Bytes of normalised text in a splitter; bounds what the sampling sends to the driver.
SPLITTER_CHARS = 24


def _ranked(docs: DataFrame, id_col: str, text_col: str, keep: str) -> tuple[DataFrame, dict[str, str]]:
    """*docs* with what content sort finds out within each (group, salt)."""
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be 'largest' or 'smallest', not {keep!r}")
    spark = docs.sparkSession
    start, hashed, salt, sha, best, rank, size = unused(docs, "_start", "_hash", "_salt", "_sha", "_best", "_rank", "_size")
    names = {"hash": hashed, "salt": salt, "sha": sha, "best": best, "rank": rank, "size": size}
    text = ascii_lower(F.coalesce(column(text_col), F.lit("")))

    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = docs.select(F.xxhash64(text).alias(hashed), F.octet_length(text).cast("long").alias("b"))
    sizes = written(sizes.groupBy(hashed).agg(F.count("*").alias("n"), F.sum("b").alias("b")), "copies")
    total = sizes.agg(F.sum("n").alias("n"), F.sum("b").alias("b")).first()
    share = F.greatest(F.col("n") / max(total.n or 0, 1), F.col("b") / max(total.b or 0, 1)) * (2 * ranges)
    hot = sizes.where(F.col("n") > 1).where(share > 1)
    hot = hot.select(hashed, F.least("n", F.ceil(share)).cast("int").alias(size))

    keyed = docs.withColumns({start: F.substring(text, 1, SPLITTER_CHARS), hashed: F.xxhash64(text)})
    keyed = keyed.join(F.broadcast(hot), hashed, "left")
    spread = F.pmod(F.monotonically_increasing_id(), F.col(size)).cast("int")
    keyed = keyed.withColumn(salt, F.when(F.col(size).isNull(), F.lit(-1)).otherwise(spread)).drop(size)
    dealt = keyed.repartitionByRange(start, hashed, salt)

    group = Window.partitionBy(start, hashed, salt, text)
    order = column(id_col).desc_nulls_last() if keep == "largest" else column(id_col).asc_nulls_last()
    ranked = dealt.withColumns(
        {
            best: F.first(column(id_col)).over(group.orderBy(order)),
            rank: F.row_number().over(group.orderBy(order)),
            size: F.count("*").over(group.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
            sha: F.sha2(text.cast("binary"), 256),
        }
    )
    return ranked.drop(start), names


def _merged(ranked: DataFrame, names: dict[str, str], keep: str) -> DataFrame:
    """One row for each group that was spread over salts: its id, size and the salt that stays."""
    heads = ranked.where((F.col(names["salt"]) >= 0) & (F.col(names["rank"]) == 1))
    value = F.struct(F.col(names["best"]).isNull().alias("none"), F.col(names["best"]).alias("id"), F.col(names["salt"]).alias("salt"))
    if keep == "largest":
        value = F.struct(F.col(names["best"]).isNotNull().alias("some"), F.col(names["best"]).alias("id"), F.col(names["salt"]).alias("salt"))
    pick = F.max(value) if keep == "largest" else F.min(value)
    groups = heads.groupBy(names["hash"], names["sha"]).agg(pick.alias("v"), F.sum(names["size"]).alias("total"))
    return groups.select(
        names["hash"], names["sha"], F.col("v.id").alias("all_best"), F.col("v.salt").alias("all_salt"), F.col("total").alias("all_size")
    )


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per row of *docs*: id, keep_id, group_size, kept, text_sha256."""
    narrow = docs.select(column(id_col).alias("_id"), column(text_col).alias("_text"))
    ranked, n = _ranked(narrow, "_id", "_text", keep)
    ranked = written(ranked.drop("_text"), "content-sort")
    spread = F.col("all_size").isNotNull()

    def either(whole: Column, part: Column) -> Column:
        return F.when(spread, whole).otherwise(part)

    # At most 4 groups for each range are spread: the size of the broadcast side is bounded.
    joined = ranked.join(F.broadcast(_merged(ranked, n, keep)), [n["hash"], n["sha"]], "left")
    return joined.select(
        F.col("_id").alias(id_col),
        either(F.col("all_best"), F.col(n["best"])).alias("keep_id"),
        either(F.col("all_size"), F.col(n["size"])).cast("long").alias("group_size"),
        ((F.col(n["rank"]) == 1) & either(F.col("all_salt") == F.col(n["salt"]), F.lit(True))).alias("kept"),
        F.col(n["sha"]).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of *docs* that stay, with all their columns."""
    ranked, n = _ranked(docs, id_col, text_col, keep)
    heads = written(ranked.where(F.col(n["rank"]) == 1), "content-heads")
    merged = _merged(heads, n, keep)
    joined = heads.join(F.broadcast(merged), [n["hash"], n["sha"]], "left")
    kept = joined.where(F.col("all_salt").isNull() | (F.col("all_salt") == F.col(n["salt"])))
    return kept.select(*[column(c) for c in docs.columns])
