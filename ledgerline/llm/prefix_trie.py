"""The trie of conversation prefixes, by digests of blocks of turns.

A conversation is cut into blocks of ``block`` turns. Conversations are grouped by the digests of their
successive blocks first: one row per conversation and block, counted before and after the shuffle. Only
where a group goes on in several ways (siblings) are the turns inside their blocks looked at, and then
once for each distinct block, not for each conversation; a block without siblings is a chain whose nodes
all have its members.

A prefix is known by the exclusive or of 2 x 64-bit hashes of (block number, block content), so the parts of
a prefix can be combined in any grouping: no conversation has to be in one task.

* Turns are numbered in range partitions of (conversation, turn). A conversation that crosses partitions
  gets its offset from the partitions before; there are at most two such rows per partition.
* Block prefixes are prefix sums on two levels: inside ``SUPER`` blocks, and over them.
* A node's smallest member owns it. Along one conversation the owned nodes are the last ones, so with T, the
  words before its first owned turn, its share in the words that a node's subtree saves is max(0, T - words before
  the node). That and the leaves are sums over members, so they are aggregated like the counts are, however
  deep the trie is.
* Parents with very many children are joined apart: a parent with more than a thousandth of all rows
  below it is one of a thousand at most, and those are broadcast.
* The ids that end at a node are joined in pieces by range; one hash then runs over the pieces of a node
  in order (SHA-256 cannot be put together from parts), holding one piece.

Edge cases: rows without a conversation id are ignored. Turns are ordered by number (null first), then by the
digest of role and text; equal rows are turns of their own. A null role or text counts as empty. An empty table
has no nodes, not even a root. Conversations and texts may be of any length; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import column, map_batches, written

#: Turns of a block, blocks of a stretch of prefix sums.
BLOCK, SUPER = 4, 1024
#: The saved part of a parent's children that makes it be joined apart: one in so many rows.
SHARE = 1000
WORD = r"[^\x20\x09-\x0D]+"

FINAL, LATE, EDGE = 0, 1, 2
_HEAD = "array<struct<d: binary, w: bigint>>"


# Turns


def turns_of(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """_c, _t, _d (16-byte digest of role and text), _w (words of the text) and _row, which tells equal rows apart."""
    role, text = (F.coalesce(column(c), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.select(
        column(conv_col).cast("bigint").alias("_c"),
        column(turn_col).alias("_t"),
        digest.alias("_d"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("_w"),
    )
    return rows.where("_c is not null").withColumn("_row", F.monotonically_increasing_id())


def shared_heads(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """For each conversation c: skip = crc32(c) % *most*, and the first *skip* turns of c - c % *every*.

    Both are short: a head has fewer than *most* turns, and one conversation lends its turns to fewer than
    2 x *every* others.
    """
    c = F.col("_c")
    convs = turns.select("_c").distinct()
    convs = convs.select("_c", (c - c % every).alias("_base"), (F.crc32(c.cast("string")) % most).cast("int").alias("_skip"))
    first = Window.partitionBy("_c").orderBy(F.asc_nulls_first("_t"), "_d", "_row")
    lent = turns.where(c % every == 0).withColumn("_n", F.row_number().over(first)).where(F.col("_n") < most)
    lent = lent.groupBy("_c").agg(F.sort_array(F.collect_list(F.struct("_n", "_d", "_w"))).alias("_all"))
    lent = lent.select(c.alias("_base"), F.transform("_all", lambda x: F.struct(x._d.alias("d"), x._w.alias("w"))).alias("_all"))
    head = F.slice(F.coalesce("_all", F.array().cast(_HEAD)), F.lit(1), F.col("_skip"))
    return convs.join(lent, "_base", "left").select("_c", "_skip", head.alias("_head"))


def _no_heads(turns: DataFrame) -> DataFrame:
    return turns.select("_c").distinct().select("_c", F.lit(0).alias("_skip"), F.array().cast(_HEAD).alias("_head"))


def numbered(turns: DataFrame, heads: DataFrame) -> DataFrame:
    """_c, _pos, _d, _w: the head of each conversation, then its turns after the skipped ones, from 1.

    Position 0 of each conversation is a row without a turn.
    """
    marks = heads.select("_c", F.lit(0).alias("_o"), F.lit(None).cast(turns.schema["_t"].dataType).alias("_t"), F.lit(None).cast("binary").alias("_d"), F.lit(None).cast("bigint").alias("_w"), F.lit(0).cast("bigint").alias("_row"), "_skip", "_head")
    rows = turns.select("_c", F.lit(1).alias("_o"), "_t", "_d", "_w", "_row", F.lit(None).cast("int").alias("_skip"), F.lit(None).cast(_HEAD).alias("_head"))
    order = ["_c", "_o", "_t", "_d", "_row"]
    rows = written(marks.unionByName(rows), "trie-rows").repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select("_c", "_o", "_d", "_w", "_skip", "_head")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, own, skip, k, known = None, 0, 0, 0, False  # the conversation at hand; known: its mark was here

        def out(kind, c, pos, d, w, skip) -> pa.RecordBatch:
            n = len(c)
            columns = [pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, part, np.int32)), pa.array(c, pa.int64()), pa.array(pos, pa.int64()), d, w, pa.array(skip, pa.int32())]
            return pa.RecordBatch.from_arrays(columns, names=["kind", "part", "_c", "_pos", "_d", "_w", "_k"])

        def edge() -> pa.RecordBatch:
            none = pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64())
            return out(EDGE, [conv], [own], *none, [k if known else None])

        for batch in batches:
            if not batch.num_rows:
                continue
            c, mark = batch.column(0).to_numpy(), batch.column(1).to_numpy() == 0
            digest, words = batch.column(2), batch.column(3)
            begins = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
            sizes = np.diff(np.append(begins, len(c)))
            marks = np.flatnonzero(mark)
            head, skips = batch.column(5).take(pa.array(marks)), batch.column(4).take(pa.array(marks)).to_numpy()
            lengths = head.value_lengths().to_numpy() if len(marks) else np.empty(0, np.int64)
            # per run: turns before it in this partition, skipped turns, head length, whether its mark was seen
            before, run_skip, run_k = (np.zeros(len(begins), dtype=np.int64) for _ in range(3))
            run_known = mark[begins].copy()
            run_skip[run_known], run_k[run_known] = skips, lengths
            if not mark[0]:
                if conv is not None and c[0] == conv:
                    before[0], run_skip[0], run_k[0], run_known[0] = own, skip, k, known
                elif conv is not None:
                    raise AssertionError("a conversation without its mark")
            if conv is not None and c[0] != conv and not known:
                yield edge()  # a conversation from the partition before ends here
            run = np.repeat(np.arange(len(begins)), sizes)
            count = np.cumsum(~mark)
            nth = count - (count[begins] - ~mark[begins])[run] + before[run]
            kept = ~mark & run_known[run] & (nth > run_skip[run])
            at = pa.array(np.flatnonzero(kept))
            yield out(FINAL, c[kept], (nth - run_skip[run] + run_k[run])[kept], digest.take(at), words.take(at), np.zeros(int(kept.sum()), np.int32))
            late = ~mark & ~run_known[run]
            if late.any():
                at = pa.array(np.flatnonzero(late))
                yield out(LATE, c[late], nth[late], digest.take(at), words.take(at), np.zeros(int(late.sum()), np.int32))
            if len(marks):
                zero = np.zeros(len(marks), np.int64)
                yield out(FINAL, c[marks], zero, pa.array([b""] * len(marks), pa.binary()), pa.array(zero), zero.astype(np.int32))
                flat = head.flatten()
                pos = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + 1
                yield out(FINAL, np.repeat(c[marks], lengths), pos, flat.field("d"), flat.field("w"), np.zeros(len(flat), np.int32))
            if len(begins) > 1 and not run_known[0]:  # the first run ends inside this batch
                conv, own, known = int(c[0]), int(before[0] + (~mark[: sizes[0]]).sum()), False
                yield edge()
            conv, skip, k, known = int(c[-1]), int(run_skip[-1]), int(run_k[-1]), bool(run_known[-1])
            own = int(before[-1] + (~mark[begins[-1] :]).sum())
        if conv is not None:
            yield edge()

    schema = "kind int, part int, _c bigint, _pos bigint, _d binary, _w bigint, _k int"
    found = written(map_batches(rows, run, schema), "trie-turns")
    along = Window.partitionBy("_c").orderBy("part")
    earlier = F.coalesce(F.sum("_pos").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = found.where(F.col("kind") == EDGE).select("_c", "part", earlier.alias("_before"), F.max("_k").over(whole).alias("_all_k"))
    offsets = offsets.where("_before > 0 or _all_k is not null")
    # at most two rows per partition
    late = found.where(F.col("kind") == LATE).join(F.broadcast(offsets), ["_c", "part"])
    late = late.join(F.broadcast(offsets.select("_c").distinct().join(heads.select("_c", "_skip"), "_c")), "_c")
    place = F.col("_pos") + F.col("_before")
    late = late.where(place > F.col("_skip")).select("_c", (place - F.col("_skip") + F.col("_all_k")).alias("_pos"), "_d", "_w")
    return found.where(F.col("kind") == FINAL).select("_c", "_pos", "_d", "_w").unionByName(late)


# Blocks


def _lanes(number: Column, content: Column) -> list[Column]:
    return [F.xxhash64(F.lit(lane), number, content) for lane in (1, 2)]


def _content(turns: Column, n: Column) -> Column:
    """The digests of the first *n* turns of a block, one after the other."""
    return F.aggregate(F.slice(turns, F.lit(1), n), F.lit(b""), lambda all_, x: F.concat(all_, x.d))


def _words(turns: Column, n: Column) -> Column:
    return F.aggregate(F.slice(turns, F.lit(1), n), F.lit(0).cast("bigint"), lambda all_, x: all_ + x.w)


def paths(rows: DataFrame, block: int) -> DataFrame:
    """One row per conversation and block: _c, blk, sup, the prefix before it (p1, p2, cb words), its turns, and
    whether it is the conversation's last. Block 0 is the root, without turns."""
    blk = F.when(F.col("_pos") > 0, F.floor((F.col("_pos") - 1) / block) + 1).otherwise(0).cast("bigint")
    rows = rows.withColumn("blk", blk).where((F.col("blk") > 0) | (F.col("_pos") == 0))
    rows = rows.groupBy("_c", "blk").agg(F.sort_array(F.collect_list(F.struct("_pos", "_d", "_w"))).alias("all"))
    turns = F.filter(F.col("all"), lambda x: x._pos > 0)
    rows = rows.select("_c", "blk", F.floor(F.col("blk") / SUPER).cast("bigint").alias("sup"), F.transform(turns, lambda x: F.struct(x._d.alias("d"), x._w.alias("w"))).alias("turns"))
    size = F.size("turns")
    lanes = _lanes(F.col("blk"), _content(F.col("turns"), size))
    l1, l2 = (F.when(F.col("blk") > 0, lane).otherwise(F.lit(0).cast("bigint")) for lane in lanes)
    rows = written(rows.select("*", l1.alias("l1"), l2.alias("l2"), _words(F.col("turns"), size).alias("w")), "trie-blocks")

    def sums(over) -> list[Column]:
        past = over.rowsBetween(Window.unboundedPreceding, -1)
        zero = F.lit(0).cast("bigint")
        return [F.coalesce(f(c).over(past), zero) for f, c in ((F.bit_xor, "l1"), (F.bit_xor, "l2"), (F.sum, "w"))]

    stretches = rows.groupBy("_c", "sup").agg(F.bit_xor("l1").alias("l1"), F.bit_xor("l2").alias("l2"), F.sum("w").alias("w"))
    over = Window.partitionBy("_c").orderBy("sup")
    s1, s2, sw = sums(over)
    stretches = stretches.select("_c", "sup", s1.alias("s1"), s2.alias("s2"), sw.alias("sw"), F.lead("sup").over(over).isNull().alias("end"))
    rows = rows.join(stretches, ["_c", "sup"])
    over = Window.partitionBy("_c", "sup").orderBy("blk")
    r1, r2, rw = sums(over)
    return rows.select(
        "_c", "blk", "sup", "turns",
        F.col("s1").bitwiseXOR(r1).alias("p1"), F.col("s2").bitwiseXOR(r2).alias("p2"), (F.col("sw") + rw).alias("cb"),
        (F.col("end") & F.lead("blk").over(over).isNull()).alias("last"),
    )


def _id(turns: Column, n: Column) -> list[Column]:
    """The node after the first *n* turns of a block."""
    inside = _lanes(F.col("blk"), _content(turns, n))
    return [F.when(n > 0, F.col(p).bitwiseXOR(lane)).otherwise(F.col(p)) for p, lane in zip(("p1", "p2"), inside)]


def nodes(groups: DataFrame, block: int, measures: dict[str, Column], saved: bool = False) -> DataFrame:
    """Nodes of grouped blocks: chains where a prefix goes on in one way, turn by turn where siblings diverge.

    *measures* says how the columns of *groups* are put together where blocks share turns; s1, s2, … hold
    the savings of the first, second, … turn of a block if *saved*.
    """
    key = ["blk", "p1", "p2"]
    groups = written(groups, "trie-groups")
    limit = groups.count() // SHARE + 1
    fan = written(groups.groupBy(*key).agg(F.count("*").alias("ways")), "trie-ways")
    wide = F.broadcast(fan.where(F.col("ways") > limit).select(*key))  # fewer than SHARE rows
    few = groups.join(wide, key, "left_anti").join(fan.where(F.col("ways") <= limit), key)
    several = groups.join(wide, key, "left_semi").unionByName(few.where("ways > 1").drop("ways"))
    alone = few.where("ways = 1").drop("ways")

    def by_turn(rows: DataFrame) -> DataFrame:
        turns = F.col("turns")
        rows = rows.select("*", F.explode(F.when(F.size(turns) > 0, F.sequence(F.lit(1), F.size(turns))).otherwise(F.array(F.lit(0)))).alias("t"))
        t, before = F.col("t"), F.greatest(F.col("t") - 1, F.lit(0))
        (i1, i2), (q1, q2) = _id(turns, t), _id(turns, before)
        depth = F.when(t > 0, (F.col("blk") - 1) * block + t).otherwise(0)
        extra = [F.coalesce(F.element_at(F.array(*[F.col(f"s{i + 1}") for i in range(block)]), F.greatest(t, F.lit(1))), F.lit(0)).alias("saved")] if saved else []
        return rows.select(
            i1.alias("i1"), i2.alias("i2"), q1.alias("q1"), q2.alias("q2"), depth.cast("bigint").alias("depth"),
            (F.col("cb") + _words(turns, before)).alias("cb"), *[F.col(m) for m in measures], *extra,
        )

    keys = ["i1", "i2", "q1", "q2", "depth", "cb"]
    put = {**measures, **({"saved": F.sum("saved")} if saved else {})}
    shared = by_turn(several).groupBy(*keys).agg(*[c.alias(m) for m, c in put.items()])
    return written(by_turn(alone).unionByName(shared), "trie-nodes")


# Digest of the ends


def _ends_digest(ends: DataFrame) -> DataFrame:
    """i1, i2, ends_sha256 of the ids _c that end at each node, ascending, joined by commas."""
    order = ["i1", "i2", "_c"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, c = (batch.column(i).to_numpy() for i in range(3))
            begins = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            names, cuts = c.tolist(), [*begins.tolist(), len(c)]
            texts = [",".join(map(str, names[i:j])) for i, j in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(a[begins]), pa.array(b[begins]), pa.array(c[begins]), pa.array(texts)], names=["i1", "i2", "_c", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hasher = None, None
        done: list[tuple[int, int, str]] = []

        def out() -> pa.RecordBatch:
            columns = [pa.array([d[i] for d in done], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.string()))]
            return pa.RecordBatch.from_arrays(columns, names=["i1", "i2", "ends_sha256"])

        for batch in batches:
            for i1, i2, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                if at == (i1, i2):
                    hasher.update(b",")
                else:
                    if at is not None:
                        done.append((*at, hasher.hexdigest()))
                    at, hasher = (i1, i2), hashlib.sha256()
                hasher.update(ids.encode())
            if done:
                yield out()
                done.clear()
        if at is not None:
            done.append((*at, hasher.hexdigest()))
            yield out()

    pieces = map_batches(ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order), join, "i1 bigint, i2 bigint, _c bigint, ids string")
    pieces = written(pieces, "trie-ends").repartition("i1", "i2").sortWithinPartitions(*order)
    return map_batches(pieces, digest, "i1 bigint, i2 bigint, ends_sha256 string")


# The trie


def prefix_trie(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block: int = BLOCK,
    share_heads: bool = False,
) -> DataFrame:
    """Every prefix of every conversation: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256. *share_heads* first gives conversations the head of another (``shared_heads``).
    """
    turns = written(turns_of(conversations, conv_col, turn_col, role_col, text_col), "trie-input")
    heads = written(shared_heads(turns) if share_heads else _no_heads(turns), "trie-heads")
    rows = written(paths(numbered(turns, heads), block), "trie-paths")
    key = ["blk", "p1", "p2", "cb", "turns"]

    # first the counts: who owns a node, and which nodes are leaves
    groups = rows.groupBy(*key).agg(F.count("*").alias("n"), F.min("_c").alias("conv"))
    found = nodes(groups, block, {"n": F.sum("n"), "conv": F.min("conv")})
    kids = found.where("depth > 0").groupBy(F.col("q1").alias("i1"), F.col("q2").alias("i2")).agg(F.count("*").alias("n_children"))
    kids = written(kids, "trie-children")
    owned = found.join(kids, ["i1", "i2"], "left").select(F.col("conv").alias("_c"), "cb", F.col("n_children").isNull().cast("int").alias("leaf"))
    size = F.size("turns")
    ends = rows.where("last").select("_c", "sup", *[c.alias(n) for c, n in zip(_id(F.col("turns"), size), ("i1", "i2"))], (F.col("cb") + _words(F.col("turns"), size)).alias("total"))
    ends = written(ends, "trie-last")
    # of each conversation: words before its first owned turn (all, if it owns none), and whether it owns a leaf
    own = ends.select("_c", "total", "sup", F.lit(None).cast("bigint").alias("cb"), F.lit(0).alias("leaf")).unionByName(
        owned.select("_c", F.lit(None).cast("bigint").alias("total"), F.lit(None).cast("bigint").alias("sup"), "cb", "leaf")
    )
    own = own.groupBy("_c").agg(F.coalesce(F.min("cb"), F.max("total")).alias("upto"), F.max("leaf").alias("leaf"), F.max("sup").alias("sup"))
    own = own.select("_c", "upto", "leaf", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("sup"))).alias("sup"))

    # then the sums over members: rows of one conversation meet in stretches of SUPER blocks
    zero = F.lit(0).cast("bigint")
    saving = [
        F.sum(F.greatest(zero, F.col("upto") - F.col("cb") - _words(F.col("turns"), F.lit(t)))).alias(f"s{t + 1}") for t in range(block)
    ]
    groups = rows.join(own, ["_c", "sup"]).groupBy(*key).agg(
        F.count("*").alias("n"), F.min("_c").alias("conv"), F.sum("leaf").alias("leaves"), *saving
    )
    found = nodes(groups, block, {"n": F.sum("n"), "conv": F.min("conv"), "leaves": F.sum("leaves")}, saved=True)
    found = found.join(kids, ["i1", "i2"], "left").join(_ends_digest(ends), ["i1", "i2"], "left")
    found = written(found.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-found")

    limit = found.count() // SHARE + 1
    parents = found.where("n_children > 0").select(F.col("i1").alias("q1"), F.col("i2").alias("q2"), F.col("conv").alias("parent_conv_id"), "n_children")
    wide = F.broadcast(parents.where(F.col("n_children") > limit).drop("n_children"))  # fewer than SHARE rows
    below = found.where("depth > 0")
    rest = below.join(wide, ["q1", "q2"], "left_anti").join(parents.where(F.col("n_children") <= limit).drop("n_children"), ["q1", "q2"])
    root = found.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    whole = below.join(wide, ["q1", "q2"]).unionByName(rest).unionByName(root)
    return whole.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        "n_children",
        F.col("leaves").cast("bigint").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
