"""SimHash fingerprints and near-duplicate classes by pigeonring filtering.

A fingerprint has 64 bits in a ring of ``segments`` segments. If two fingerprints differ in at
most ``distance`` bits, then (pigeonring principle) there is a segment from which every chain of
1, 2, ... consecutive segments differs in at most ``length * distance / segments`` bits. While that
budget is below one, the chain must be equal bit for bit: those segments are the key under which
fingerprints are posted, once for each start. Fingerprints that meet under a key go through the
longer chains, and only what is left through the full Hamming check.

Copies have one fingerprint, so all of this runs on distinct fingerprints; a source full of copies
costs one row. Fingerprints under one key are compared in a task in blocks, which yields links that
join what the block's pairs join (a spanning forest), never all pairs. A key with more than
``run_limit`` fingerprints is not compared in a task: each of its fingerprints is posted once for
every pair of bits outside the key with these bits blanked, and equal ones are linked. At most four
distinct fingerprints are equal then, so that path is exact, spread over the cluster, and linear
in the fingerprints of the key.

Edge cases: a null text counts as empty; no words give fingerprint zero, which links like any
other; fewer words than a shingle has make one shingle. Null ids are kept; the component of a class
without any id is null. Repeated rows come out as often as they went in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import column, map_batches, unused, written
from ledgerline.llm.components import components

BITS = 64
#: Rows of an output batch of the comparison.
OUT_ROWS = 50_000

_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles of *text*, repeats included."""
    words = text.lower().split()  # of bytes: A-Z only, and only 0x20 and 0x09-0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    last = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, last)], dtype="<u8")
    if len(hashes) < 64:
        ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        octets = hashes.view(np.uint8).reshape(-1, 8)
        ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fingerprint", shingle: int = 3) -> DataFrame:
    """*docs* without its text, with a signed 64-bit fingerprint."""
    rest = [c for c in docs.columns if c not in (text_col, name)]
    text = F.coalesce(column(text_col), F.lit("")).cast("binary")
    source = docs.select(*[column(c) for c in rest], text.alias(name))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*[column(c) for c in rest]).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch.column(len(rest)).to_pylist()], dtype=np.uint64)
            columns = [batch.column(i) for i in range(len(rest))] + [pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, name])

    return map_batches(source, run, f"{kinds}{', ' if kinds else ''}`{name}` bigint")


class Ring:
    """The segments of the ring and the budgets of their chains."""

    def __init__(self, distance: int, segments: int):
        if not distance < segments <= BITS:
            raise ValueError("a ring needs more segments than bits may differ, and at most 64")
        self.distance, self.segments = distance, segments
        self.edges = [BITS * i // segments for i in range(segments + 1)]
        self.budgets = [length * distance // segments for length in range(1, segments + 1)]
        self.exact = sum(b == 0 for b in self.budgets)

    def mask(self, start: int, length: int) -> int:
        """Bits of the chain of *length* segments from *start*."""
        bits = 0
        for k in range(start, start + length):
            low, high = self.edges[k % self.segments], self.edges[k % self.segments + 1]
            bits |= ((1 << (high - low)) - 1) << low
        return bits

    def chains(self, start: int) -> list[tuple[np.uint64, int]]:
        """Mask and budget of each chain longer than the key; the last is the whole ring."""
        return [
            (np.uint64(self.mask(start, length)), self.budgets[length - 1])
            for length in range(self.exact + 1, self.segments + 1)
        ]

    def blanks(self, start: int) -> np.ndarray:
        """Masks that blank each choice of ``distance`` bits outside the key."""
        from itertools import combinations

        free = [b for b in range(BITS) if not self.mask(start, self.exact) >> b & 1]
        whole = (1 << BITS) - 1
        return np.array([whole ^ sum(1 << b for b in bits) for bits in combinations(free, self.distance)], dtype=np.uint64)


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _forest(prints: np.ndarray, chains: list[tuple[np.uint64, int]], block: int = 512) -> Iterator[tuple[int, int]]:
    """Links among *prints* that connect whatever its close pairs connect."""
    parent = list(range(len(prints)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(0, len(prints), block):
        left = prints[a : a + block]
        for b in range(a, len(prints), block):
            right = prints[b : b + block]
            differ = left[:, None] ^ right[None, :]
            near = np.ones(differ.shape, dtype=bool)
            for mask, budget in chains:
                near &= np.bitwise_count(differ & mask) <= budget
            for i, j in zip(*np.nonzero(near)):
                x, y = root(a + int(i)), root(b + int(j))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    yield int(prints[a + i]), int(prints[b + j])


def links(prints: DataFrame, name: str = "fingerprint", distance: int = 2, segments: int = 7, run_limit: int = 2048) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints within *distance* bits, directly or in steps."""
    ring = Ring(distance, segments)
    keys = [_signed(ring.mask(s, ring.exact)) for s in range(segments)]
    value = column(name)
    posted = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), value.bitwiseAND(F.lit(m)).alias("k")) for s, m in enumerate(keys)]))
    rows = prints.select(value.alias("p"), posted.alias("at")).select("at.s", "at.k", "p")
    rows = rows.repartition("s", "k").sortWithinPartitions("s", "k")
    chains = [ring.chains(s) for s in range(segments)]
    schema = "kind int, a bigint, b bigint"

    def out(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(np.full(len(a), kind, dtype=np.int32)), pa.array(a), pa.array(b)]
        return pa.RecordBatch.from_arrays(columns, names=["kind", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, full = None, [], False
        found: list[tuple[int, int]] = []

        def blanked(values: np.ndarray) -> Iterator[pa.RecordBatch]:
            masks = ring.blanks(key[0])
            step = max(1, OUT_ROWS // len(values))
            for m in range(0, len(masks), step):
                some = masks[m : m + step]
                blank = (values[:, None] & some[None, :]).ravel().view(np.int64)
                # Two blanks of one fingerprint can be equal only if they blank other bits: the mask is part of the value.
                which = np.tile(np.arange(m, m + len(some)), len(values)).astype(np.int64) * segments + key[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((which + 1).astype(np.int32)), pa.array(blank), pa.array(np.repeat(values, len(some)).view(np.int64))],
                    names=["kind", "a", "b"],
                )

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal held, full, found
            values = np.concatenate(held) if held else np.empty(0, dtype=np.uint64)
            if full and len(values):
                yield from blanked(values)
            elif len(values) > 1:
                found += _forest(values, chains[key[0]])
            held, full = [], False
            if len(found) >= OUT_ROWS:
                pairs = np.array(found, dtype=np.uint64).view(np.int64)
                found = []
                yield out(0, pairs[:, 0], pairs[:, 1])

        for batch in batches:
            if not batch.num_rows:
                continue
            s, k = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            p = batch.column(2).to_numpy().view(np.uint64)
            cuts = [0, *(np.flatnonzero((s[1:] != s[:-1]) | (k[1:] != k[:-1])) + 1).tolist(), len(s)]
            for i, j in zip(cuts, cuts[1:]):
                if key != (this := (int(s[i]), int(k[i]))):
                    yield from close()
                    key = this
                held.append(p[i:j])
                while sum(map(len, held)) > run_limit:  # a long run leaves in pieces, none is held whole
                    values = np.concatenate(held)
                    yield from blanked(values[:run_limit])
                    held, full = [values[run_limit:]], True
        yield from close()
        if found:
            pairs = np.array(found, dtype=np.uint64).view(np.int64)
            yield out(0, pairs[:, 0], pairs[:, 1])

    found = written(map_batches(rows, run, schema), "links")
    near = found.where("kind = 0").select("a", "b")
    # Equal but for the blanked bits: at most 2 ** distance different fingerprints.
    same = found.where("kind > 0").groupBy("kind", "a").agg(F.min("b").alias("low"), F.collect_set("b").alias("all"))
    same = same.where(F.size("all") > 1).select(F.col("low").alias("a"), F.explode("all").alias("b")).where("a <> b")
    return near.unionByName(same).distinct()


#: A class with more than this part of all distinct fingerprints is joined apart; there are fewer such classes than this.
SHARE = 1000


def _named(prints: DataFrame, distance: int, segments: int) -> DataFrame:
    """_print and _first of each distinct fingerprint: (_id, _digest) of the first row of its class."""
    row = F.struct(F.col("_id").isNull().alias("none"), "_id", "_digest")  # a row with an id comes before one without
    each = written(prints.groupBy("_print").agg(F.min(row).alias("_low")), "distinct-fingerprints")
    classes = components(links(each.select("_print"), "_print", distance, segments))
    # Only classes of several fingerprints need a second look; a fingerprint of its own has its answer.
    members = each.join(classes.withColumnRenamed("node", "_print"), "_print", "left")
    members = written(members.select("_print", "_low", F.col("component").alias("_class")), "classes")
    linked = members.where("_class is not null")
    lows = written(linked.groupBy("_class").agg(F.min("_low").alias("_first"), F.count("*").alias("_n")), "class-lows")
    limit = members.count() // SHARE + 1
    wide = F.broadcast(lows.where(F.col("_n") > limit).drop("_n"))  # fewer than SHARE rows
    rest = linked.join(wide.select("_class"), "_class", "left_anti").join(lows.where(F.col("_n") <= limit).drop("_n"), "_class")
    alone = members.where("_class is null").select("_print", F.col("_low").alias("_first"))
    return alone.unionByName(linked.join(wide, "_class").unionByName(rest).select("_print", "_first"))


def _classified(docs: DataFrame, id_col: str, text_col: str, distance: int, segments: int) -> DataFrame:
    """_id, _digest (of the text), _print and _first of each row."""
    text = F.coalesce(column(text_col), F.lit(""))
    narrow = docs.select(column(id_col).alias("_id"), F.xxhash64(text).alias("_digest"), text.alias("_text"))
    prints = written(with_fingerprint(narrow, "_text", "_print"), "fingerprints")
    return prints.join(_named(prints, distance, segments), "_print")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 2, segments: int = 7) -> DataFrame:
    """id, fingerprint (16 hex digits) and component_id of each row of *docs*."""
    found = _classified(docs, id_col, text_col, distance, segments)
    return found.select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"), F.col("_first._id").alias("component_id")
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 2, segments: int = 7) -> DataFrame:
    """One row of each class of *docs*, with all its columns: that with the smallest id, and of those the smallest hash of the text.

    Rows are told apart by id and text, so rows that share an id are judged one by one; a row without an id
    stays only where its class has none with one. Rows with equal id and text stay or go together.
    """
    found = _classified(docs.select(column(id_col), column(text_col)), id_col, text_col, distance, segments)
    key, digest, flag = unused(docs, "_key", "_hash", "_flag")
    first = F.col("_id").eqNullSafe(F.col("_first._id")) & (F.col("_digest") == F.col("_first._digest"))
    gone = found.where(~first).select(F.col("_id").alias(key), F.col("_digest").alias(digest)).distinct().withColumn(flag, F.lit(True))
    text = F.coalesce(column(text_col), F.lit(""))
    left = docs.join(gone, column(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(text) == F.col(digest)), "left")
    return left.where(F.col(flag).isNull()).select(*[docs[f"`{c}`"] for c in docs.columns])
