"""Approximate nearest neighbours by largest inner product with a permutation index.

Pivots are vectors of a bounded sample. A vector is represented by its nearest pivots in order and is
posted in the inverted files of the first few; a query visits the files of its own first pivots,
ranks what it finds there by the footrule distance of the two orders (a pivot that is missing from
one counts as just behind its end), and the better part is compared exactly.

Inner products have no nearest pivots of their own; vectors get one more component that makes all
norms equal, queries get zero there, and the order is the same as by distance.

Equal vectors are indexed once, with their k + 1 smallest ids: no query needs more of them, for one
may be its own. Pivots are sampled from distinct vectors, and all vectors that tie with the last of
the better part are compared too, so a result does not depend on the order of arrival.

An inverted file may hold a third of all vectors: files are split into segments of bounded size, and
the queries that visit a file into blocks, so a task's group is bounded by parameters. Every vector
is indexed; only pivots are sampled (``pivots``, or twice the root of the number of distinct vectors,
at most 4,096).

Edge cases: vectors that are null, zero, of another than the commonest length, or hold a null or
non-finite component take no part, nor do rows without an id. Rows with equal ids and components
count once; with equal ids only, each is a candidate, except for queries of that id. Ties go to the
smaller id. With few vectors every file is searched whole. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import column, map_batches, written

#: Length of the orders, files a vector is posted in, files a query visits, share of a file that is compared exactly.
ORDER, POSTS, VISITS, KEEP = 96, 12, 24, 0.5
#: Pivots up to which POSTS and VISITS are enough; see ``reach``.
FEW_PIVOTS = 453
#: Vectors in a segment of a file, queries in a block, pivots at most.
SEGMENT, QUERIES, MOST_PIVOTS = 4096, 512, 4096


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec (array<double>) of the vectors that take part."""
    rows = vectors.select(column(id_col).cast("bigint").alias("id"), column(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vec") == (length.n if length else 0)).distinct()


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """ids (ascending, the smallest *most*), vec of each distinct vector of usable rows."""
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))  # each task leaves so many rows of a vector before the shuffle
    few = rows.withColumn("_n", place).where(F.col("_n") <= most).drop("_n")
    return few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")).select("ids", "vec")


def reach(pivots: int) -> tuple[int, int]:
    """Files a vector is posted in and files a query visits.

    Both grow with the root of the number of pivots, so that posts * visits / pivots, and with it the
    share of all vectors that a query compares, does not shrink with the table.
    """
    grown = max(1.0, math.sqrt(pivots / FEW_PIVOTS))
    return min(math.ceil(POSTS * grown), pivots), min(math.ceil(VISITS * grown), pivots)


def footrule(order: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Footrule distance of one order of pivots to those whose places of each pivot are the columns of *places*."""
    ranks = np.arange(len(order), dtype=np.int16)[:, None]
    return np.abs(places[order] - ranks).sum(axis=0, dtype=np.int32)


def search(
    vectors: DataFrame, is_query: str, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", pivots: int | None = None
) -> DataFrame:
    """query_id, rank, vec_id, score of the *k* nearest of each query; *is_query* is a condition on ``id``."""
    spark = vectors.sparkSession
    rows = written(usable(vectors, id_col, vec_col), "vectors")
    unlike = written(distinct_vectors(rows, k + 1), "distinct-vectors")
    facts = unlike.agg(F.count("*").alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)).alias("top")).first()
    count = pivots or min(MOST_PIVOTS, max(16, math.ceil(2 * math.sqrt(facts.n))))
    sample = unlike.orderBy(F.xxhash64("vec"), "vec").limit(count).select("vec").toArrow().column(0).to_pylist()
    base = np.array(sample, dtype=np.float64)
    top = facts.top or 0.0
    lift = np.sqrt(np.maximum(top - (base * base).sum(axis=1), 0)) if len(sample) else np.empty(0)
    posts, visits = reach(len(sample))
    size = min(max(ORDER, visits), len(sample))
    shared = spark.sparkContext.broadcast((base, lift))

    def orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, raised = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vec = np.array(batch.column(1).flatten()).reshape(batch.num_rows, -1)
            query = np.asarray(batch.column(2))
            extra = np.where(query, 0.0, np.sqrt(np.maximum(top - (vec * vec).sum(axis=1), 0)))
            order = np.argsort(-(vec @ pivot.T + extra[:, None] * raised), axis=1, kind="stable")[:, :size].astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([v.tobytes() for v in vec], pa.binary()),
                    pa.array([o.tobytes() for o in order], pa.binary()),
                    pa.array([o[: visits if q else posts].tolist() for o, q in zip(order, query)], pa.list_(pa.int32())),
                ],
                names=["ids", "query", "vec", "order", "files"],
            )

    asking = rows.where(is_query).select(F.array("id").alias("ids"), "vec", F.lit(True).alias("query"))
    source = unlike.select("ids", "vec", F.lit(False).alias("query")).unionByName(asking)
    ordered = written(map_batches(source, orders, "ids array<bigint>, query boolean, vec binary, `order` binary, files array<int>"), "orders")
    posted = ordered.withColumn("file", F.explode("files")).drop("files")
    # One row per pivot.
    sizes = posted.groupBy("file").agg(F.count_if(~F.col("query")).alias("o"), F.count_if(F.col("query")).alias("q"))
    sizes = sizes.where("o > 0 and q > 0").select(
        "file", F.ceil(F.col("o") / SEGMENT).cast("int").alias("segments"), F.ceil(F.col("q") / QUERIES).cast("int").alias("blocks")
    )
    placed = posted.join(F.broadcast(sizes), "file")
    mine = lambda n: F.pmod(F.xxhash64("ids", "vec"), F.col(n)).cast("int")
    all_of = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    listed = placed.where("not query").withColumn("segment", mine("segments")).withColumn("block", F.explode(all_of("blocks")))
    asked = placed.where("query").withColumn("block", mine("blocks")).withColumn("segment", F.explode(all_of("segments")))
    group, width = ["file", "segment", "block"], len(sample)

    def compare(objects: pa.Table, queries: pa.Table) -> pa.Table:
        count = np.asarray(pc.list_value_length(objects.column("ids")), dtype=np.int64)
        ids, start = objects.column("ids").combine_chunks().flatten().to_numpy(), np.cumsum(count) - count
        asking = queries.column("q_ids").combine_chunks().flatten().to_numpy()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(count) and len(asking):
            unpack = lambda table, name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind).reshape(len(table), -1)
            vec, order = unpack(objects, "vec", "<f8"), unpack(objects, "order", "<u2")
            places = np.full((width, len(count)), size, dtype=np.int16)
            places[order.ravel(), np.repeat(np.arange(len(count)), size)] = np.tile(np.arange(size, dtype=np.int16), len(count))
            keep = max(4 * k, math.ceil(KEEP * len(count)))
            for q, its_vec, its_order in zip(asking, unpack(queries, "q_vec", "<f8"), unpack(queries, "q_order", "<u2")):
                near = np.arange(len(count))
                if keep < len(count):
                    far = footrule(its_order, places)
                    near = np.flatnonzero(far <= np.partition(far, keep - 1)[keep - 1])
                first = ids[start[near]]
                near, first = near[other := (first != q) | (count[near] > 1)], first[other]
                second = np.where(first == q, ids[np.minimum(start[near] + 1, len(ids) - 1)], first)  # the smallest other id
                scores = np.einsum("ij,j->i", vec[near], its_vec)
                ranked = np.lexsort((second, -scores))
                most = k
                while True:  # again only if ids repeat
                    best = ranked[:most]
                    n = count[near[best]]
                    its = ids[np.repeat(start[near[best]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                    its, score = its[its != q], np.repeat(scores[best], n)[its != q]
                    its, score = its[placed := np.lexsort((its, -score))], score[placed]
                    _, at = np.unique(its, return_index=True)
                    if len(at) >= k or most >= len(ranked):
                        break
                    most *= 2
                at = np.sort(at)[:k]
                found.append((np.full(len(at), q), its[at], score[at]))
        q, o, s = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(o, pa.int64()), "score": pa.array(s, pa.float64())})

    wanted = [*group, "ids", "vec", "order"]
    asked = asked.select(*[F.col(c).alias(f"q_{c}") for c in wanted])
    pairs = listed.select(*wanted).groupBy(*group).cogroup(asked.groupBy(*[f"q_{c}" for c in group]))
    pairs = pairs.applyInArrow(compare, "query_id bigint, vec_id bigint, score double")
    best = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
