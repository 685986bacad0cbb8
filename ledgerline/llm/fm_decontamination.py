"""Benchmark passages in training documents, found with an FM-index of each training shard.

A shard is what a task has read so far of its partition, up to ``SHARD_WORDS`` words. Its words become
numbers, its text a sequence of them with breaks, and of that an FM-index is built: suffix array by
prefix doubling, Burrows-Wheeler transform in a wavelet matrix with rank samples, and every 32nd suffix
position. Test phrases are searched backward through the ranks, all phrases at once; their rows
walk back to the next sampled position, which gives the place of each occurrence. Places are compared
with the phrase word by word (the numbers stand for 64-bit hashes), and overlapping spans are merged.

What is searched is read from the shared work folder in blocks, so a task holds one shard and one block,
however large the benchmark is; nothing of it is broadcast but a sieve of fixed size: one bit for each
of ``SIEVE`` word hashes. Words outside the sieve occur in no phrase and become breaks, and a run of words
that is shorter than the shortest phrase is not indexed, since it cannot hold one. A false positive of the
sieve costs time and changes no result.

Words are maximal runs of 0-9, A-Z (in lower case), a-z and everything beyond ASCII. Phrases are each
``width`` consecutive words of an item; an item with fewer words, but not none, is one phrase.

Edge cases: a null text has no words. A row is one result, whatever its id; null and repeated ids are
kept. Items with one id count once; the phrases of an item without id mark words and are not counted as an
item. Documents may be of any length: one is never split. Empty tables give no rows, an empty
benchmark no hits. Further columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import column, map_batches
from ledgerline.session import work_folder

#: Words of an item that make a phrase.
WIDTH = 10
#: Indexed words and documents of a shard, at most (and what one batch holds beyond that).
SHARD_WORDS, SHARD_DOCS = 1 << 20, 1 << 17
#: Phrases that are searched at once, and bits of the sieve.
BLOCK_ROWS, SIEVE = 1 << 15, 1 << 20
#: Suffix positions that are kept: one in so many, and the first of each run.
SAMPLE = 32
#: Bytes whose hashes are computed at once, unless a single word is longer.
PIECE = 1 << 22

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[0x80:] = True
for _first, _last in ("09", "AZ", "az"):
    _IN_WORD[ord(_first) : ord(_last) + 1] = True


# Words


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    up, down = (np.full(size, b, dtype=np.uint64) for b in (base, inverse))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_BYTE = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: differences of running sums of byte times power, shifted to one origin."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, side="right")))
        base = starts[at]
        piece = data[base : ends[to - 1]]
        up, down = _powers(max(PIECE, len(piece)) + 1)
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[piece] * up[: len(piece)], out=sums[1:])
        i, j = starts[at:to] - base, ends[at:to] - base
        out[at:to] = _mixed((sums[j] - sums[i]) * down[i] + (j - i).astype(np.uint64))
        at = to
    return out


class Words:
    """The words of an Arrow array of texts, without a Python object for any of them."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        body = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]] if len(texts) else np.empty(0, np.uint8)
        self.offsets = offsets - offsets[0] if len(texts) else np.zeros(1, np.int64)
        self.data = _LOWER[body]
        inside = np.concatenate([[False], _IN_WORD[body], [False]])
        cut = np.zeros(len(body) + 1, dtype=bool)
        cut[self.offsets] = True  # a word ends with its text
        self.starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
        self.ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
        before = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(before)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        self.nth = np.arange(len(self.starts)) - before[self.doc]
        self.hashes = _hashes(self.data, self.starts, self.ends)

    def spaced(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of some words, each with a space after it, and where each begins."""
        lengths = self.ends[chosen] - self.starts[chosen]
        at = np.concatenate([[0], np.cumsum(lengths + 1)])
        out = np.full(at[-1], ord(" "), dtype=np.uint8)
        inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[inner + np.repeat(at[:-1], lengths)] = self.data[inner + np.repeat(self.starts[chosen], lengths)]
        return out, at


# Index


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of *text* in order; breaks (0) differ from each other, the text ends with one.

    Prefix doubling that sorts, in each round, only what is still undecided.
    """
    n = len(text)
    breaks = text == 0
    first = np.where(breaks, np.cumsum(breaks) - 1, text.astype(np.int64) + int(breaks.sum()))
    order = np.argsort(first, kind="stable")
    slots = np.arange(n)
    rank = np.empty(n, dtype=np.int64)

    def settle(slots: np.ndarray, suffixes: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Rank a sorted stretch by the slot its group begins at; return the slots of undecided groups."""
        begins = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        rank[suffixes] = slots[begins][group]
        return slots[np.diff(np.append(begins, len(slots)))[group] > 1]

    left = settle(slots, order, np.append(True, np.diff(first[order]) != 0))
    ahead = 1
    while len(left):
        suffixes = order[left]
        key = (rank[suffixes] << 32) | rank[suffixes + ahead]
        by = np.argsort(key)
        key, suffixes = key[by], suffixes[by]
        order[left] = suffixes
        left = settle(left, suffixes, np.append(True, key[1:] != key[:-1]))
        ahead *= 2
    return order


class Bits:
    """Bits with the count of ones before each word of 64."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & low)

    def at(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class FmIndex:
    """Backward search and location in a sequence of numbers in which 0 is a break."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        suffixes = suffix_array(text)
        last = text[suffixes - 1]
        self.symbols = int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.symbols))])
        self.levels: list[tuple[int, Bits]] = []
        rows = last.astype(np.int64)
        for shift in reversed(range(max(1, (self.symbols - 1).bit_length()))):
            high = (rows >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(high)))
            rows = np.concatenate([rows[~high], rows[high]])
        every = np.arange(self.symbols)
        self.origin = self._down(every, np.zeros(self.symbols, dtype=np.int64))
        known = (suffixes % sample == 0) | (last == 0)
        self.known, self.places = Bits(known), suffixes[known]

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.rank(i)
            i = np.where(symbol >> shift & 1, bits.zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before row i of the transform."""
        return self._down(symbol, i) - self.origin[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrases that occur, first row, row after the last) for phrases of one length, one in each row."""
        left = np.arange(len(phrases))
        symbol = phrases[:, -1]
        low, high = self.first[symbol], self.first[symbol + 1]
        for step in range(phrases.shape[1] - 2, -1, -1):
            there = low < high
            left, low, high = left[there], low[there], high[there]
            symbol = phrases[left, step]
            low, high = self.first[symbol] + self.rank(symbol, low), self.first[symbol] + self.rank(symbol, high)
        there = low < high
        return left[there], low[there], high[there]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Place in the text of the suffix of each row: back through the text to the next kept place."""
        out = np.empty(len(rows), dtype=np.int64)
        left, steps = np.arange(len(rows)), 0
        while len(left):
            known = self.known.at(rows)
            out[left[known]] = self.places[self.known.rank(rows[known])] + steps
            left, rows, steps = left[~known], rows[~known], steps + 1
            symbol, i = np.zeros(len(rows), dtype=np.int64), rows
            for shift, bits in self.levels:
                high, ones = bits.at(i), bits.rank(i)
                symbol |= high.astype(np.int64) << shift
                i = np.where(high, bits.zeros + ones, i - ones)
            rows = self.first[symbol] + i - self.origin[symbol]
        return out


# Phrases


def _phrases(items: DataFrame, id_col: str, text_col: str, width: int, folder: str) -> tuple[int, np.ndarray]:
    """Write the phrases of all items; return the length of the shortest and the sieve."""
    schema = "item string, n int, words binary, hashes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column(1))
            body, at = words.spaced(np.arange(len(words.starts)))
            body = body.tobytes()
            n = np.minimum(words.counts, width)
            starts = np.flatnonzero(words.nth <= (words.counts - n)[words.doc])
            for i in range(0, len(starts), BLOCK_ROWS):
                first = starts[i : i + BLOCK_ROWS]
                doc = words.doc[first]
                many = n[doc]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(doc)),
                        pa.array(many.astype(np.int32)),
                        pa.array([body[a:b] for a, b in zip(at[first].tolist(), at[first + many].tolist())], pa.binary()),
                        pa.array([words.hashes[a : a + k].tobytes() for a, k in zip(first.tolist(), many.tolist())], pa.binary()),
                    ],
                    names=["item", "n", "words", "hashes"],
                )

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_slot(hashes)))], names=["slot"])

    narrow = items.select(column(id_col).cast("string").alias("item"), column(text_col).alias("_text"))
    map_batches(narrow, run, schema).write.parquet(folder)
    found = items.sparkSession.read.schema(schema).parquet(folder)
    shortest = found.agg(F.min("n")).first()[0]
    sieve = np.zeros(SIEVE, dtype=bool)
    if shortest is not None:
        set_ = map_batches(found.select("hashes"), slots, "slot bigint").distinct().collect()  # SIEVE numbers at most
        sieve[[r.slot for r in set_]] = True
    return shortest or 1, sieve


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(SIEVE)).astype(np.int64)


def _blocks(folder: str) -> Iterator[pa.RecordBatch]:
    """The phrases, block by block, from the shared folder."""
    fs, path = pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
    files = (f for f in fs.get_file_info(pafs.FileSelector(path)) if f.base_name.startswith("part-"))
    for file in sorted(files, key=lambda f: f.path):
        with fs.open_input_file(file.path) as source:
            yield from pq.ParquetFile(source).iter_batches(BLOCK_ROWS)


# Search


class Shard:
    """Documents read so far and those of their words that may belong to a phrase."""

    def __init__(self, sieve: np.ndarray, shortest: int):
        self.sieve, self.shortest = sieve, shortest
        self.ids: list[pa.Array] = []
        self.counts: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.docs = self.words = 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        words = Words(texts)
        maybe = np.flatnonzero(self.sieve[_slot(words.hashes)])
        # runs of consecutive words of one document that all pass the sieve
        begins = np.append(True, (np.diff(maybe) != 1) | (np.diff(words.doc[maybe]) != 0)) if len(maybe) else np.empty(0, bool)
        run = np.cumsum(begins) - 1
        lengths = np.bincount(run) if len(maybe) else np.empty(0, np.int64)
        chosen = maybe[lengths[run] >= self.shortest]
        if len(chosen):
            body, at = words.spaced(chosen)
            begin = words.starts[chosen] - words.offsets[words.doc[chosen]]
            end = begin + words.ends[chosen] - words.starts[chosen]
            self.parts.append((words.hashes[chosen], words.doc[chosen] + self.docs, words.nth[chosen], begin, end, body, np.diff(at)))
        self.ids.append(ids)
        self.counts.append(words.counts)
        self.docs += len(ids)
        self.words += len(chosen)

    @property
    def full(self) -> bool:
        return self.words >= SHARD_WORDS or self.docs >= SHARD_DOCS

    def found(self, folder: str) -> tuple[np.ndarray, list[list[str]], list[list[dict]]]:
        """Of each document the number of hit words, the items in order, and the merged spans."""
        items: list[set[str]] = [set() for _ in range(self.docs)]
        spans: list[list[dict]] = [[] for _ in range(self.docs)]
        if not self.parts:
            return np.zeros(self.docs, dtype=np.int64), [[] for _ in items], spans
        hashes, doc, nth, begin, end, body, sizes = (np.concatenate(p) for p in zip(*self.parts))
        # a break after each run; the text of the index has one place more per break
        last = np.append((np.diff(doc) != 0) | (np.diff(nth) != 1), True)
        place = np.arange(len(hashes)) + np.cumsum(last) - last
        known, number = np.unique(hashes, return_inverse=True)
        text = np.zeros(len(hashes) + int(last.sum()), dtype=np.int64)
        text[place] = number + 1
        word = np.full(len(text), -1, dtype=np.int64)
        word[place] = np.arange(len(hashes))
        index = FmIndex(text)
        at, body = np.concatenate([[0], np.cumsum(sizes)]), body.tobytes()
        cover = np.zeros(len(hashes) + 1, dtype=np.int64)
        for block in _blocks(folder):
            names, many = block.column(0).to_pylist(), block.column(1).to_numpy()
            phrases, coded = block.column(2).to_pylist(), block.column(3)
            which = {}
            for i, phrase in enumerate(phrases):
                which.setdefault(phrase, []).append(i)
            distinct = np.array([rows[0] for rows in which.values()])
            for n in np.unique(many):
                own = distinct[many[distinct] == n]
                codes = np.frombuffer(b"".join(coded.take(pa.array(own)).to_pylist()), dtype=np.uint64).reshape(-1, n)
                symbols = np.searchsorted(known, codes)
                there = (known[np.minimum(symbols, len(known) - 1)] == codes).all(axis=1)
                own, symbols = own[there], symbols[there] + 1
                hit, low, high = index.search(symbols)
                if not len(hit):
                    continue
                phrase = np.repeat(own[hit], high - low)
                rows = np.arange(len(phrase)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + np.repeat(low, high - low)
                first = word[index.locate(rows)]
                same = [body[a:b] == phrases[p] for a, b, p in zip(at[first].tolist(), at[first + n].tolist(), phrase.tolist())]
                phrase, first = phrase[same], first[same]
                np.add.at(cover, first, 1)
                np.add.at(cover, first + n, -1)
                for d, p in np.unique(np.stack([doc[first], phrase], axis=1), axis=0).tolist():
                    items[d].update(names[i] for i in which[phrases[p]] if names[i] is not None)
        covered = np.cumsum(cover[:-1]) > 0
        hit = np.flatnonzero(covered)
        for run in np.split(hit, np.flatnonzero((np.diff(hit) != 1) | (np.diff(doc[hit]) != 0) | (np.diff(nth[hit]) != 1)) + 1):
            if len(run):
                a, b = run[0], run[-1]
                span = {"first_word": int(nth[a]), "words": len(run), "first_byte": int(begin[a]), "end_byte": int(end[b])}
                spans[int(doc[a])].append(span)
        return np.bincount(doc[hit], minlength=self.docs), [sorted(x) for x in items], spans


SPANS = pa.list_(pa.struct([("first_word", pa.int64()), ("words", pa.int64()), ("first_byte", pa.int64()), ("end_byte", pa.int64())]))


def passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
) -> DataFrame:
    """id, n_words, n_hit, items (sorted as strings) and spans of every row of *docs*.

    A span is a maximal stretch of hit words: number of its first word, words, and the bytes of
    the UTF-8 text from its first to its last word.
    """
    folder = work_folder(docs.sparkSession, "llm-phrases")
    shortest, sieve = _phrases(benchmark, item_col, item_text_col, width, folder)
    packed = np.packbits(sieve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = np.unpackbits(packed).astype(bool)
        shard = Shard(sieve, shortest)

        def close() -> pa.RecordBatch:
            n_hit, items, spans = shard.found(folder)
            columns = [
                pa.concat_arrays(shard.ids),
                pa.array(np.concatenate(shard.counts)),
                pa.array(n_hit),
                pa.array(items, pa.list_(pa.string())),
                pa.array(spans, SPANS),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["_id", "n_words", "n_hit", "items", "spans"])

        for batch in batches:
            if batch.num_rows:
                shard.add(batch.column(0), batch.column(1))
            if shard.full:
                yield close()
                shard = Shard(sieve, shortest)
        if shard.docs:
            yield close()

    narrow = docs.select(column(id_col).alias("_id"), column(text_col).alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()
    spans = "array<struct<first_word: bigint, words: bigint, first_byte: bigint, end_byte: bigint>>"
    found = map_batches(narrow, run, f"_id {kind}, n_words bigint, n_hit bigint, items array<string>, spans {spans}")
    return found.select(F.col("_id").alias(id_col), "n_words", "n_hit", "items", "spans")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The report of ``passages``: how much of each document is hit, and by which items."""
    return passages(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
