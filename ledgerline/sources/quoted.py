"""Large text files with line breaks inside quoted values, read by all cores.

A split of such a file cannot know whether it begins inside quotes. So each task reads its split
both ways, as if it began outside and as if it began inside, until both agree; it writes the
pieces of records that go over an end of the split, in both readings, and how the split ends in
either case. From those ends, one small row per split, follows in which state each split really
begins: that of the last split whose end does not depend on its beginning, turned by each split
since that swaps the two. A record that goes over the end of a split is put together from its
pieces of the true reading. All other records are read from the files again, each split from its
true state: they are neither written nor shuffled, however large the files are.

Both passes must see the same splits. So the files are read in a session of their own whose split
size is fixed: neither later settings nor executors that come or go change it.

Within a task the lines of a split come in the order of the file, and splits one after another.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import work_folder
from ledgerline.sources.files import parts_of

#: How a split was read: as if it began outside or inside quotes, or as either.
OUTSIDE, INSIDE, EITHER = 0, 1, 2
#: A whole record, the end of one, the beginning of one, the middle of one, and the end state of the split.
WHOLE, HEAD, TAIL, THROUGH, END = range(5)
#: Characters of a piece; a piece that is read in the wrong way may be as long as its split.
PIECE = 1 << 20

#: Bytes of a split, at least, unless Spark's own limit is lower.
SPLIT = 4 << 20

_PIECES = "path string, block bigint, reading int, kind int, n bigint, text string"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends within quotes. A quote opens a value only at its beginning; two are one of the text."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('"', at + 1):
                at += 2
                continue
            inside, at = False, at + 1
        elif at == 0 and line.startswith('"'):
            inside, at = True, 1
        else:
            at = line.find(',"', at)
            if at < 0:
                return False
            inside, at = True, at + 2


def first_record(text: str, whole: bool) -> str | None:
    """The first record of a text without its line end; None if it does not end and *text* is not *whole*."""
    end = 0
    inside = False
    while True:
        line_end = text.find("\n", end)
        line = text[end : line_end if line_end >= 0 else len(text)]
        inside = ends_inside(line, inside)
        if line_end < 0:
            return text if whole else None
        if not inside:
            return text[:line_end]
        end = line_end + 1


class _Reading:
    """Records of a split, under one assumption about how it begins."""

    def __init__(self, inside: bool):
        self.inside, self.leading = inside, inside
        self.lines: list[str] = []
        self.size = self.n = 0

    def add(self, line: str) -> list[tuple[int, int, str]]:
        self.inside = ends_inside(line, self.inside) if '"' in line else self.inside
        self.lines.append(line)
        self.size += len(line)
        if not self.inside:
            return self._take(HEAD if self.leading else WHOLE, last=True)
        return self._take(THROUGH, last=False) if self.leading and self.size >= PIECE else []

    def close(self) -> list[tuple[int, int, str]]:
        return self._take(THROUGH if self.leading else TAIL, last=False) if self.lines else []

    def _take(self, kind: int, last: bool) -> list[tuple[int, int, str]]:
        piece = (kind, self.n, "\n".join(self.lines))
        self.lines, self.size, self.n = [], 0, self.n + 1
        self.leading &= not last
        return [piece]


class _Split:
    def __init__(self, path: str, block: int):
        self.path, self.block, self.first = path, block, True
        self.readings = {EITHER: _Reading(False)} if block == 0 else {OUTSIDE: _Reading(False), INSIDE: _Reading(True)}

    def add(self, line: str) -> Iterator[tuple]:
        if self.first and self.block == 0:
            line = line.removeprefix("\ufeff")
        self.first = False
        for name, reading in self.readings.items():
            for piece in reading.add(line):
                yield (self.path, self.block, name, *piece)
        if len(self.readings) == 2 and not any(r.inside for r in self.readings.values()):
            one = _Reading(False)  # from here on both read the same
            one.n = max(r.n for r in self.readings.values())
            self.readings = {EITHER: one}

    def close(self) -> Iterator[tuple]:
        for name, reading in self.readings.items():
            for piece in reading.close():
                yield (self.path, self.block, name, *piece)
            yield (self.path, self.block, name, END, int(reading.inside), "through" if reading.leading else "")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, list[str]]]:
    """The lines of each split in a batch, whose last column they are, under the split's other columns."""
    *of, lines = batch.columns
    ends = [tuple(c[at].as_py() for c in of) for at in (0, -1)] if batch.num_rows else []
    if ends and ends[0] == ends[1]:  # a split's lines follow one another
        yield ends[0], lines.to_pylist()
    elif ends:
        for key, rows in groupby(zip(*(c.to_pylist() for c in (*of, lines))), key=lambda row: row[:-1]):
            yield key, [row[-1] for row in rows]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of records that an end of a split cuts, and the ends."""
    split: _Split | None = None
    rows: list[tuple] = []
    size = 0
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string())
    names = ["path", "block", "reading", "kind", "n", "text"]

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        rows.clear()
        return batch

    for batch in batches:
        for (path, block), lines in _runs(batch):
            if split is None or (split.path, split.block) != (path, block):
                if split is not None:
                    rows += split.close()
                split = _Split(path, block)
            for line in lines:
                for row in split.add(line):
                    if row[3] != WHOLE:
                        rows.append(row)
                        size += len(row[-1])
                if size >= PIECE:
                    yield out()
                    size = 0
    if split is not None:
        rows += split.close()
    if rows:
        yield out()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that lie in one split, but for the header, of splits whose state is known."""
    at = reading = None
    paths: list[str] = []
    texts: list[str] = []
    size = 0

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (paths, texts)], names=["path", "text"])
        paths.clear()
        texts.clear()
        return batch

    for batch in batches:
        for (path, block, state), lines in _runs(batch):
            if at != (path, block):
                if state is None:
                    raise ValueError(f"{path}: the split at {block} was not there when the file was read first")
                at, reading = (path, block), _Reading(state == 1)
                if block == 0:
                    lines[0] = lines[0].removeprefix("\ufeff")
            for line in lines:
                for kind, n, text in reading.add(line):
                    if kind == WHOLE and (block or n):
                        paths.append(path)
                        texts.append(text)
                        size += len(text)
                if size >= PIECE:
                    yield out()
                    size = 0
    if texts:
        yield out()


def _states(pieces: DataFrame) -> DataFrame:
    """path, block, state (of its beginning) and start (the split in which the record before it began)."""
    ends = pieces.where(F.col("kind") == END).groupBy("path", "block").agg(
        *[
            F.max(F.when(F.col("reading").isin(reading, EITHER), F.col("n"))).alias(f"f{reading}")
            for reading in (OUTSIDE, INSIDE)
        ],
        F.max(F.when((F.col("reading") == INSIDE) & (F.col("text") == "through"), 1)).alias("through"),
    )
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swaps = (F.col("f0") > F.col("f1")).cast("int")
    ends = ends.withColumn("swaps", F.sum(swaps).over(upto))
    fixed = F.last(F.when(F.col("f0") == F.col("f1"), F.struct("f0", "swaps")), ignorenulls=True).over(before)
    ends = ends.withColumn("fixed", fixed).withColumn("so_far", F.coalesce(F.lag("swaps").over(Window.partitionBy("path").orderBy("block")), F.lit(0)))
    state = F.coalesce((F.col("fixed.f0") + F.col("so_far") - F.col("fixed.swaps")) % 2, F.lit(0)).cast("int")
    ends = ends.withColumn("state", state)
    inside = F.when(F.col("state") == 1, F.col("f1")).otherwise(F.col("f0")) == 1
    opens = inside & ~((F.col("state") == 1) & F.col("through").isNotNull())
    return ends.select("path", "block", "state", F.last(F.when(opens, F.col("block")), ignorenulls=True).over(before).alias("start"))


def _lines(spark: SparkSession, paths: list[str], limit: int) -> DataFrame:
    """path, block (start of the split) and value of every line, in splits that stay as they are."""
    total = sum(length for path in paths for _, length in parts_of(spark, path))
    size = min(limit, max(SPLIT, total // spark.sparkContext.defaultParallelism))
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    # an open cost of a whole split: the number of cores has no part in the size of splits
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(name, str(size))
    path, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return own.read.option("lineSep", "\n").text(paths).select(path.alias("path"), block.alias("block"), "value")


def records(spark: SparkSession, paths: list[str], limit: int) -> DataFrame:
    """path and text of every record but the first (the header) of each file; the line end is taken off up to a CR.

    A split has *limit* bytes at most.
    """
    lines = _lines(spark, paths, limit)
    folder = work_folder(spark, "raw-records")
    lines.mapInArrow(_cut, _PIECES).write.option("compression", "zstd").parquet(f"{folder}/pieces")
    pieces = spark.read.schema(_PIECES).parquet(f"{folder}/pieces")
    _states(pieces).write.parquet(f"{folder}/states")
    states = spark.read.parquet(f"{folder}/states")  # its size is that of its file: one short row per split
    true = pieces.where(F.col("kind") != END).join(states, ["path", "block"])
    true = true.where((F.col("reading") == EITHER) | (F.col("reading") == F.col("state")))
    known = lines.join(F.broadcast(states.select("path", "block", "state")), ["path", "block"], "left")
    whole = known.select("path", "block", "state", "value").mapInArrow(_whole, "path string, text string")
    begun = F.when(F.col("kind") == TAIL, F.col("block")).otherwise(F.col("start"))
    parts = true.select("path", begun.alias("begun"), F.struct("block", "n", "text").alias("part"))
    put = F.sort_array(F.collect_list("part"))
    cut = parts.groupBy("path", "begun").agg(put.alias("parts")).where(~((F.col("begun") == 0) & (F.col("parts")[0]["n"] == 0)))
    # the first side gives the result its session
    return cut.select("path", F.array_join(F.col("parts.text"), "\n").alias("text")).unionByName(whole)


def values(text: Column, names: tuple[str, ...], options: dict[str, str]) -> list[Column]:
    """A record's values as texts. Nothing ends a line any more, so every character is kept."""
    corrupt = options.get("columnNameOfCorruptRecord")
    fields = [name if name == corrupt else f"c{k}" for k, name in enumerate(names)]
    row = F.from_csv(text, ", ".join(f"{f} STRING" for f in fields), {**options, "lineSep": "\x01"})
    return [row[f].alias(name) for f, name in zip(fields, names, strict=True)]
