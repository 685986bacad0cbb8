"""Token ids in binary files, with a minimal perfect hash index for access by key.

Format, below one folder:

* ``shards/NNNNNN.bin``: raw ids, little-endian, two bytes each where the vocabulary allows it, the
  documents of one range of keys in ascending order, each with an end id;
* ``index/NNNNNN.mph``: for the keys of one hash bucket a minimal perfect hash function (levels of
  bits; a key's slot is the rank of its first bit that no other key of the bucket shares). After a
  head of ``HEAD`` bytes that holds the sizes of the levels, the bits lie in blocks of 64 bytes that
  begin with the number of set bits before them, so one block gives a bit and its rank. Then one
  entry of fixed width per slot: a 32-bit fingerprint of the key, shard, offset and number of ids.
  Keys are not stored: a key that was never written has a foreign fingerprint, up to one in 2^32;
* ``manifest``: Parquet, one row per shard: ids before it, ids, documents, and the number of buckets.

A lookup hashes the key, opens one index file and reads its head, one block of each level that the
key passes (1.7 on average, whatever the number of keys), one entry, and one range of a shard. Keys that are looked up
together share the pages of ``PAGE`` bytes they need, and no page is read twice.

Files are written under a name of the attempt and renamed, so a task that runs twice leaves what it
would have left once. The folder must be one that all executors see; pyarrow opens it by its address
(local and mounted folders, hdfs, s3, gs).

Edge cases: keys are whole numbers or null; null sorts first. A key that occurs n times is n keys
(key, 0 .. n-1), in the order of the texts. A null text counts as empty: its range holds the end id
alone. An empty table leaves an empty index and manifest.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import column, map_batches, written
from ledgerline.llm.library_bpe import library

#: Bits per key of a level of the hash function, and the fingerprints' seed.
GAMMA, PRINT_SEED = 2, 0x9E3779B9
#: Keys of an index file on average, at most; bounds what a task of the index holds at once.
BUCKET_KEYS = 1 << 18
#: An index file: bytes of its head (number of keys, then bits of each level), of a block and of a page read at once.
HEAD, BLOCK, PAGE = 1024, 64, 1 << 13
#: Bits of a block after the 4 bytes of its rank.
BLOCK_BITS = (BLOCK - 4) * 8
#: Keys that are looked up in one step.
LOOKUPS = 1 << 14
SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("start", "<u8"), ("n", "<u8")])
ENTRY = "key bigint, nth bigint, shard int, start bigint, n bigint"


# Files


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _named(folder: str, kind: str, number: int) -> str:
    return f"{folder}/{kind}/{number:06d}.{'bin' if kind == 'shards' else 'mph'}"


class _Part:
    """A file that gets its name when it is complete."""

    def __init__(self, uri: str):
        self.fs, self.path = _opened(uri)
        self.own = f"{self.path}.{uuid.uuid4().hex}"
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.stream = self.fs.open_output_stream(self.own)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.own, self.path)


# Minimal perfect hash


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(key: np.ndarray, nth: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of keys (bits of the key, number of the occurrence)."""
    step = np.uint64(((seed + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    return _mixed(_mixed(key + step) ^ (nth * np.uint64(0xD6E8FEB86659FD93) + step))


def build_index(key: np.ndarray, nth: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Levels of bits, and the slot of each key. Keys (key, nth) must be distinct."""
    levels, slots, base = [], np.empty(len(key), dtype=np.int64), 0
    left = np.arange(len(key))
    while len(left):
        size = np.uint64(GAMMA * len(left) + 1)
        place = (_hashed(key[left], nth[left], len(levels)) % size).astype(np.int64)
        alone = np.bincount(place, minlength=int(size)) == 1
        levels.append(alone)
        settled = alone[place]
        slots[left[settled]] = base + np.cumsum(alone)[place[settled]] - 1
        base += int(alone.sum())
        left = left[~settled]
    return levels, slots


def packed_index(levels: list[np.ndarray], slots: np.ndarray, entries: np.ndarray) -> bytes:
    """The bytes of an index file; *entries* (of ``SLOT``) are in the order of the keys."""
    head = np.zeros(HEAD // 8, dtype="<u8")
    if len(levels) >= len(head):
        raise ValueError(f"an index of {len(slots)} keys takes {len(levels)} levels: its keys are not distinct")
    head[0], head[1 : len(levels) + 1] = len(slots), [len(bits) for bits in levels]
    out, rank = [head.tobytes()], 0
    for bits in levels:
        count = -(-len(bits) // BLOCK_BITS)
        padded = np.zeros(count * BLOCK_BITS, dtype=bool)
        padded[: len(bits)] = bits
        padded = padded.reshape(count, BLOCK_BITS)
        set_ = padded.sum(axis=1)
        blocks = np.empty((count, BLOCK), dtype=np.uint8)
        blocks[:, :4] = (rank + np.cumsum(set_) - set_).astype("<u4").view(np.uint8).reshape(count, 4)
        blocks[:, 4:] = np.packbits(padded, axis=1, bitorder="little")
        out.append(blocks.tobytes())
        rank += int(set_.sum())
    ordered = np.empty(len(slots), dtype=SLOT)
    ordered[slots] = entries
    return b"".join([*out, ordered.tobytes()])


class IndexFile:
    """An index file that is read by pages, each once, and only those that are needed."""

    def __init__(self, stream, size: int):
        self.stream, self.size, self.bytes_read = stream, size, 0
        self.pages: dict[int, np.ndarray] = {}
        head = self._records(np.zeros(1, dtype=np.int64), HEAD)[0].view("<u8")
        self.keys = int(head[0])
        self.levels = [int(x) for x in head[1:] if x]
        self.blocks = [-(-bits // BLOCK_BITS) for bits in self.levels]

    def _records(self, at: np.ndarray, width: int) -> np.ndarray:
        """The *width* bytes from each offset *at*, one row each."""
        first, last = at // PAGE, (at + width - 1) // PAGE
        needed = np.unique(np.concatenate([first, last]))
        missing = [int(p) for p in needed if int(p) not in self.pages]
        runs = np.split(missing, np.flatnonzero(np.diff(missing) != 1) + 1) if missing else []
        for run in runs:
            low, high = int(run[0]) * PAGE, min((int(run[-1]) + 1) * PAGE, self.size)
            data = np.frombuffer(self.stream.read_at(high - low, low), dtype=np.uint8)
            self.bytes_read += len(data)
            for k, page in enumerate(run):
                own = np.zeros(PAGE, dtype=np.uint8)
                part = data[k * PAGE : (k + 1) * PAGE]
                own[: len(part)] = part
                self.pages[int(page)] = own
        # Both pages of a record that crosses are needed, so they stand side by side.
        joined = np.concatenate([self.pages[int(p)] for p in needed])
        base = np.searchsorted(needed, first) * PAGE + at % PAGE
        return joined[base[:, None] + np.arange(width)]

    def find(self, key: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the keys are in the index, and their entries."""
        slots = np.full(len(key), -1, dtype=np.int64)
        left, before = np.arange(len(key)), 0
        for number, (size, count) in enumerate(zip(self.levels, self.blocks)):
            if not len(left):
                break
            place = (_hashed(key[left], nth[left], number) % np.uint64(size)).astype(np.int64)
            block, bit = np.divmod(place, BLOCK_BITS)
            rows = self._records(HEAD + (before + block) * BLOCK, BLOCK)
            here = (rows[np.arange(len(left)), 4 + bit // 8] >> (bit % 8).astype(np.uint8)) & 1 == 1
            rank = np.ascontiguousarray(rows[:, :4]).view("<u4")[:, 0].astype(np.int64)
            bits = np.unpackbits(rows[here, 4:], axis=1, bitorder="little")
            inside = (bits * (np.arange(BLOCK_BITS) < bit[here, None])).sum(axis=1)
            slots[left[here]] = rank[here] + inside
            left, before = left[~here], before + count
        found = np.flatnonzero(slots >= 0)
        at = HEAD + sum(self.blocks) * BLOCK + slots[found] * SLOT.itemsize
        entries = self._records(at, SLOT.itemsize).reshape(-1).view(SLOT) if len(found) else np.empty(0, dtype=SLOT)
        good = entries["print"] == _prints(key[found], nth[found])
        return found[good], entries[good]


def _prints(key: np.ndarray, nth: np.ndarray) -> np.ndarray:
    return (_hashed(key, nth, PRINT_SEED) >> np.uint64(32)).astype(np.uint32)


def _key_parts(keys: pa.Array, nths: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys as unsigned numbers; a null key is marked in the number of its occurrence."""
    null = np.asarray(keys.is_null())
    key = keys.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
    return key, nths.to_numpy(zero_copy_only=False).astype(np.uint64) | (null.astype(np.uint64) << np.uint64(63))


# Runs of equal values in sorted batches


def _runs(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[tuple[int, pa.Table]]:
    """Tables of consecutive rows with one value in column *by*."""
    held, value = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        v = batch.column(by).to_numpy()
        cuts = [0, *(np.flatnonzero(v[1:] != v[:-1]) + 1).tolist(), len(v)]
        for i, j in zip(cuts, cuts[1:]):
            if held and v[i] != value:
                yield value, pa.Table.from_batches(held).combine_chunks()
                held = []
            value = int(v[i])
            held.append(batch.slice(i, j - i))
    if held:
        yield value, pa.Table.from_batches(held).combine_chunks()


# Writing


def write(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.json",
    end_id: int = 0,
    shards: int | None = None,
) -> DataFrame:
    """Write shards, index and manifest of *docs* below *folder*; return the manifest."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(column(id_col).cast("bigint").alias("key"), F.coalesce(column(text_col), F.lit("")).cast("binary").alias("text"))
    rows = rows.repartitionByRange(shards, "key").sortWithinPartitions("key", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library(vocabulary)
        end = np.array([end_id], dtype=encoder.width).tobytes()
        shard, at, part, last, nth = TaskContext.get().partitionId(), 0, None, (), 0
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = part or _Part(_named(folder, "shards", shard))
                ids = encoder.encode(text.as_py()) + end
                part.stream.write(ids)
                nth = nth + 1 if last == (key,) else 0
                last, n = (key,), len(ids) // len(end)
                out.append((key, nth, shard, at, n))
                at += n
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "nth", "shard", "start", "n"])
        if part:
            part.close()

    entries = written(map_batches(rows, encode, ENTRY), "entries")
    buckets = max(shards, -(-entries.count() // BUCKET_KEYS))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    totals = entries.groupBy("shard").agg(F.sum("n").alias("ids"), F.count("*").alias("documents"))
    totals = totals.withColumns({"before": F.coalesce(F.sum("ids").over(before), F.lit(0)), "buckets": F.lit(buckets)})
    totals.coalesce(1).write.parquet(f"{folder}/manifest")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, run in _runs(batches, 0):
            key, nth = _key_parts(run.column("key").combine_chunks(), run.column("nth").combine_chunks())
            levels, slots = build_index(key, nth)
            entries = np.empty(len(slots), dtype=SLOT)
            entries["print"] = _prints(key, nth)
            for c in ("shard", "start", "n"):
                entries[c] = run.column(c).to_numpy()
            part = _Part(_named(folder, "index", bucket))
            part.stream.write(packed_index(levels, slots, entries))
            part.close()
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([len(slots)], pa.int64())], names=["bucket", "keys"])

    bucketed = entries.select(_bucket(buckets).alias("bucket"), "*").repartition(shards, "bucket").sortWithinPartitions("bucket")
    map_batches(bucketed, index, "bucket int, keys bigint").write.parquet(f"{folder}/index-manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("key", "nth"), F.lit(buckets)).cast("int")


# Reading


def look_up(keys: DataFrame, folder: str) -> DataFrame:
    """Entries of the *keys* (key, nth) that were written, from the index."""
    buckets = keys.sparkSession.read.parquet(f"{folder}/manifest").agg(F.max("buckets")).first()[0] or 1

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, run in _runs(batches, 0):
            fs, path = _opened(_named(folder, "index", bucket))
            if (info := fs.get_file_info(path)).type != pafs.FileType.File:
                continue  # no key of this bucket was written
            keys_, nths = run.column("key").combine_chunks(), run.column("nth").combine_chunks()
            key, nth = _key_parts(keys_, nths)
            with fs.open_input_file(path) as stream:
                index = IndexFile(stream, info.size)
                for a in range(0, len(key), LOOKUPS):
                    kept, at = index.find(key[a : a + LOOKUPS], nth[a : a + LOOKUPS])
                    rows = pa.array(kept + a)
                    arrays = [keys_.take(rows), nths.take(rows)]
                    arrays += [pa.array(at[c].astype(kind)) for c, kind in (("shard", "i4"), ("start", "i8"), ("n", "i8"))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["key", "nth", "shard", "start", "n"])

    typed = keys.select(F.col("key").cast("bigint").alias("key"), F.col("nth").cast("bigint").alias("nth"))
    bucketed = typed.select(_bucket(buckets).alias("bucket"), "key", "nth")
    return map_batches(bucketed.repartition("bucket").sortWithinPartitions("bucket"), find, ENTRY)


def read(entries: DataFrame, folder: str, vocabulary: str = "byte_bpe_50k.json", keep_ids: bool = False) -> DataFrame:
    """key, nth, shard, start, n, ids_crc32 of *entries*, from the shards; with *keep_ids* the ids too."""
    names = ["key", "nth", "shard", "start", "n", "ids_crc32"] + ["ids"] * keep_ids
    schema = f"{ENTRY}, ids_crc32 bigint" + ", ids array<int>" * keep_ids

    def payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.dtype(library(vocabulary).width)
        opened, stream = None, None
        for batch in batches:
            sums, found = [], []
            for shard, start, n in zip(*[batch.column(c).to_pylist() for c in ("shard", "start", "n")]):
                if opened != shard:
                    if stream:
                        stream.close()
                    fs, path = _opened(_named(folder, "shards", shard))
                    opened, stream = shard, fs.open_input_file(path)
                ids = np.frombuffer(stream.read_at(n * width.itemsize, start * width.itemsize), dtype=width).astype("<u4")
                sums.append(zlib.crc32(ids.tobytes()))
                if keep_ids:
                    found.append(ids.tolist())
            columns = [batch.column(i) for i in range(5)] + [pa.array(sums, pa.int64())]
            if keep_ids:
                columns.append(pa.array(found, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if stream:
            stream.close()

    # Rows of a shard stay apart in lots of neighbours: no task need read a whole shard.
    return map_batches(entries.repartition("shard", F.floor(F.col("start") / (1 << 22))).sortWithinPartitions("shard", "start"), payload, schema)


def written_documents(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """Write *docs*, then give id, start, n_tokens, ids_crc32 of every document as the files have them."""
    spark: SparkSession = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    manifest = write(docs, folder, id_col, text_col, vocabulary, shards=shards)
    keys = docs.groupBy(column(id_col).cast("bigint").alias("key")).agg(F.count("*").alias("times"))
    keys = keys.select("key", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("times") - 1)).alias("nth"))
    found = read(look_up(keys, folder), folder, vocabulary)
    bases = F.broadcast(manifest.select("shard", "before"))  # one row per shard
    return found.join(bases, "shard").select(
        F.col("key").alias(id_col), (F.col("before") + F.col("start")).cast("bigint").alias("start"), F.col("n").alias("n_tokens"), "ids_crc32"
    )
