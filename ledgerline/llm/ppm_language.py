"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to two bytes. A byte that a context has not seen
costs an escape and is predicted by the next shorter context, down to the uniform one; the bytes of
the longer context are excluded there (method C). With frozen counts the probability of a byte
depends on the two bytes before it only, so the trees are laid out once as a table of code lengths
for all languages, and a text's exact code length under each language is a sum of lookups. The
language with the shortest code wins; the score is its share of probability among all languages.

The trees are fitted on a bounded sample: ``sample_rows`` labelled rows per language, chosen by a
hash of the id, whole texts. The counts are made on the executors; the driver sees one row for each
(language, three bytes) only.

Edge cases: texts that are null or without a letter give ``und`` and score 0, and so does everything
if no row is labelled. Ties go to the language that sorts first. A row without an id is in neither
fold: it is predicted, never learned from. Repeated rows come out as often as they went in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import column, map_batches, unused

UNKNOWN = "und"
#: Labelled rows per language that the trees are fitted on.
SAMPLE_ROWS = 300
#: Two bytes that stand before every text.
START = b"\n\n"
STEP = 1 << 20


@dataclass
class Trees:
    """Code lengths in bits of each byte class after each context row, for all languages."""

    languages: list[str]
    classes: np.ndarray  # of each byte; the last class is every byte never seen
    rows: np.ndarray  # context (class, class) -> row of the table
    bits: np.ndarray  # [row * classes + class, language]

    def code_lengths(self, text: bytes) -> np.ndarray:
        """Bits of *text* under each language."""
        count = int(self.classes.max()) + 1
        total = np.zeros(len(self.languages))
        known = self.classes[np.frombuffer(START + text, dtype=np.uint8)]
        for a in range(0, len(text), STEP):
            part = known[a : a + STEP + 2]
            context = self.rows[part[:-2] * count + part[1:-1]]
            total += self.bits.take(context * count + part[2:], axis=0).sum(axis=0, dtype=np.float64)
        return total

    def predict(self, text: bytes) -> tuple[str, float]:
        lengths = self.code_lengths(text)
        best = int(np.argmin(lengths))
        return self.languages[best], float(1 / np.exp2(lengths[best] - lengths).sum())


def _escaped(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Probabilities of one order from its counts and those of the next shorter one; both [context, byte]."""
    seen = counts > 0
    total, kinds = counts.sum(axis=1, keepdims=True), seen.sum(axis=1, keepdims=True)
    left = 1 - np.where(seen, shorter, 0).sum(axis=1, keepdims=True)
    escape = kinds / np.maximum(total + kinds, 1) / np.maximum(left, 1e-12)
    learned = np.where(seen, counts / np.maximum(total + kinds, 1), escape * shorter)
    return np.where(total > 0, learned, shorter)


def build(languages: list[str], language: np.ndarray, gram: np.ndarray, count: np.ndarray) -> Trees:
    """Trees from counts of (language, three bytes as a number)."""
    used = np.unique(np.concatenate([gram >> 16, (gram >> 8) & 255, gram & 255, np.array([START[0]])]).astype(np.int64))
    classes = np.full(256, len(used), dtype=np.int64)
    classes[used] = np.arange(len(used))
    size = len(used) + 1
    a, b, c = classes[gram >> 16], classes[(gram >> 8) & 255], classes[gram & 255]
    contexts = np.unique(a * size + b)  # those that some language has seen; others have a row per last byte
    rows = np.tile(np.arange(size), size)
    rows[contexts] = size + np.arange(len(contexts))
    bits = np.empty(((size + len(contexts)) * size, len(languages)), dtype=np.float32)
    # The class of unseen bytes stands for one byte of them; the others are as likely.
    for k in range(len(languages)):
        own = language == k
        pairs = np.zeros((size, size))
        np.add.at(pairs, (b[own], c[own]), count[own])
        triples = np.zeros((len(contexts), size))
        np.add.at(triples, (np.searchsorted(contexts, a[own] * size + b[own]), c[own]), count[own])
        order0 = _escaped(pairs.sum(axis=0, keepdims=True), np.full((1, size), 1 / 256))
        order1 = _escaped(pairs, np.repeat(order0, size, axis=0))
        order2 = _escaped(triples, order1[contexts % size])
        bits[:, k] = -np.log2(np.concatenate([order1, order2]).ravel())
    return Trees(languages, classes, rows, bits)


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that is never learned from."""
    return F.coalesce(F.crc32(column(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def has_letter(text_col: str) -> Column:
    return F.coalesce(column(text_col).rlike(r"\p{L}"), F.lit(False))


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS
) -> Trees:
    """Trees from a bounded sample of the labelled rows outside the held-out fold."""
    usable = column(id_col).isNotNull() & column(text_col).isNotNull() & column(lang_col).isNotNull() & ~held_out(id_col)
    labelled = docs.where(usable).select(column(id_col).alias("_id"), column(lang_col).alias("_lang"), column(text_col).alias("_text"))
    first = Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id")
    # Thinned by the same hash first: with many tasks, not even each task's first rows meet in one.
    sizes = labelled.groupBy("_lang").agg(F.least(4 * F.lit(sample_rows) / F.count("*"), F.lit(1.0)).alias("_share"))  # one row per language
    rank = F.xxhash64("_id") / F.lit(2.0**64) + 0.5
    thin = labelled.select("_id", "_lang").join(F.broadcast(sizes), "_lang").where(rank <= F.col("_share")).drop("_share")
    chosen = thin.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= sample_rows)
    chosen = chosen.select("_id").distinct()
    # Ids repeat in bad data: the rows found are limited once more.
    texts = labelled.join(F.broadcast(chosen), "_id", "left_semi")
    texts = texts.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= sample_rows)
    texts = texts.select("_lang", F.col("_text").cast("binary").alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                b = np.frombuffer(START + text, dtype=np.uint8).astype(np.int32)
                gram, n = np.unique((b[:-2] << 16) | (b[1:-1] << 8) | b[2:], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(gram), pa.string()), pa.array(gram, pa.int32()), pa.array(n, pa.int64())],
                    names=["lang", "gram", "n"],
                )

    counts = map_batches(texts, count, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counts.toArrow()  # bounded by the sample
    names = found.column("lang").to_pylist()
    languages = sorted(set(names))
    number = {name: k for k, name in enumerate(languages)}
    return build(
        languages,
        np.array([number[x] for x in names], dtype=np.int64),
        found.column("gram").to_numpy().astype(np.int64),
        found.column("n").to_numpy(),
    )


def with_language(docs: DataFrame, trees: Trees, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """*docs* with the predicted language of each whole text and its score."""
    letter, raw = unused(docs, "_letter", "_bytes")
    source = docs.withColumns({letter: has_letter(text_col), raw: column(text_col).cast("binary")})
    kept = docs.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            languages, scores = [], []
            for letters, text in zip(batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1)):
                language, score = model.predict(text.as_py()) if letters and model.languages else (UNKNOWN, 0.0)
                languages.append(language)
                scores.append(score)
            columns = [batch.column(i) for i in range(len(kept))] + [pa.array(languages, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    return map_batches(source, run, f"{kinds}, `{names[0]}` string, `{names[1]}` double")


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc id, held_out, lang_pred, score of each row."""
    trees = fit(docs, id_col, text_col, lang_col)
    rows = docs.select(column(id_col).alias(id_col), held_out(id_col).alias("held_out"), column(text_col).alias("_text"))
    return with_language(rows, trees, "_text").drop("_text")


def drop_unknown(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = 0.5) -> DataFrame:
    """The rows of *docs* whose text has a letter and one learned language that is likelier than all others together.

    Languages are weighed against each other only: a text in a language that was not learned mostly
    stays. If nothing was learned, all rows stay.
    """
    trees = fit(docs, id_col, text_col, lang_col)
    if not trees.languages:
        return docs
    names = tuple(unused(docs, "_lang_pred", "_score"))
    told = with_language(docs, trees, text_col, names)
    return told.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= least)).select(*[column(c) for c in docs.columns])
