"""BPE encoding by dynamic programming over prefixes, and decoding.

For each prefix of a piece exactly one token can be the last one of the prefix's encoding. An
Aho-Corasick automaton over all tokens gives the tokens that end at each position (the suffixes of
the prefix that are tokens). The one that counts is the one whose start is a prefix with a last token
next to which it survives: merging the two tokens' parts in order must not first join something
across their border. The last token of every prefix is stored; following them back from the end
gives the ids, without merging anything.

A piece ends with the end-of-word mark, which is part of the last character's token. Normalising
and cutting a text into pieces is the library's, on stretches between ASCII white space: no piece
crosses it, and neither composition nor lower-casing looks across it. Encoded stretches are
remembered in a store of bounded size, so common words cost a lookup.

Edge cases: a null text counts as empty; it has no ids, the digests are those of empty strings.
Special tokens that stand in a text become their ids, as the library does it. Words of any length
work: time and memory are linear in the length. Repeated rows come out as often as they went in.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm.common import column, map_batches

END = "\0"


class Store:
    """A dictionary of bounded size: the older half goes when the younger one is full."""

    def __init__(self, size: int, longest: int = 64):
        self.size, self.longest, self.young, self.old = size, longest, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(key) <= self.longest:
            if len(self.young) >= self.size:
                self.old, self.young = self.young, {}
            self.young[key] = value


class PrefixBPE:
    """Encoder for a BPE vocabulary file with an end-of-word mark."""

    def __init__(self, path: str, store: int = 500_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_pattern = re.compile(b"(" + b"|".join(re.escape(s.encode()) for s in self.special) + b")")
        self.suffix = model["end_of_word_suffix"] or ""
        self.words = {i: t for t, i in model["vocab"].items()} | {i: s for s, i in self.special.items()}
        self.decoded = [self.words.get(i, "").encode() for i in range(max(self.words) + 1)]

        # Ranks: single characters first, then merges in order.
        mark = len(self.suffix)
        plain = lambda t: t[:-mark] + END if mark and t.endswith(self.suffix) else t
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made = {a + b for a, b in merges}
        single = [t for t in model["vocab"] if plain(t).rstrip(END) and len(plain(t).rstrip(END)) == 1 and t not in made]
        self.ids = [model["vocab"][t] for t in single]
        rank = {t: r for r, t in enumerate(single)}
        self.parts = [(r, r) for r in range(len(single))]
        self.joined: dict[tuple[int, int], int] = {}
        for a, b in merges:
            token = (a[:-mark] if mark and a.endswith(self.suffix) else a) + b
            left, right = rank[a], rank[b]
            self.joined[left, right] = rank[token] = len(self.ids)
            self.ids.append(model["vocab"][token])
            self.parts.append((left, right))
        self.lengths = [0] * len(self.ids)
        self.automaton = ahocorasick.Automaton()
        for token, r in rank.items():
            self.lengths[r] = len(plain(token))
            self.automaton.add_word(plain(token), r)
        self.automaton.make_automaton()
        self.fits_store: dict[tuple[int, int], bool] = {}
        self.store = Store(store)

    def fits(self, left: int, right: int) -> bool:
        """Whether merging leaves *left* and *right* side by side.

        Both are taken apart, the later merge first, down to the parts that touch at the border.
        At each step the two parts must not be joined earlier than the merge that is taken apart.
        """
        known = self.fits_store.get((left, right))
        if known is not None:
            return known
        a, b = left, right
        before = len(self.ids)  # a join across the border counts if its rank is below
        answer = True
        while True:
            across = self.joined.get((a, b))
            if across is not None and across < before:
                answer = False
                break
            inner_a, inner_b = self.parts[a][1], self.parts[b][0]
            whole_a, whole_b = inner_a == a, inner_b == b
            if whole_a and whole_b:
                break
            # The same merge on both sides happens on the left first.
            if not whole_a and (whole_b or a > b):
                before, a = a, inner_a
            else:
                before, b = b + 1, inner_b
        if len(self.fits_store) > 1_000_000:
            self.fits_store.clear()
        self.fits_store[left, right] = answer
        return answer

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece in byte characters, by its prefixes."""
        marked = piece + END if self.suffix else piece
        last: list[int] = [-1] * (len(marked) + 1)  # of each prefix: the rank of its last token
        lengths, fits = self.lengths, self.fits
        for end, r in self.automaton.iter(marked):
            end += 1
            if last[end] < 0:
                start = end - lengths[r]
                if start == 0 or ((before := last[start]) >= 0 and fits(before, r)):
                    last[end] = r
        ids, at = [], len(marked)
        while at > 0:
            r = last[at]
            ids.append(self.ids[r])
            at -= lengths[r]
        ids.reverse()
        return ids

    def _stretch(self, stretch: bytes) -> bytes:
        """Ids of text without ASCII white space."""
        text = self.normalizer.normalize_str(stretch.decode("utf-8", "replace"))
        ids: list[int] = []
        for piece, _ in self.pre_tokenizer.pre_tokenize_str(text):
            ids += self.encode_piece(piece)
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: bytes) -> np.ndarray:
        """All ids of a text."""
        out: list[bytes] = []
        parts = self.special_pattern.split(text) if self.special else [text]
        young, store = self.store.young.get, self.store
        for k, part in enumerate(parts):
            if k % 2:
                out.append(np.array([self.special[part.decode()]], dtype="<u4").tobytes())
                continue
            for stretch in part.split():
                ids = young(stretch)
                if ids is None:
                    ids = store.get(stretch)
                    if ids is None:
                        store.put(stretch, ids := self._stretch(stretch))
                    young = store.young.get
                out.append(ids)
        return np.frombuffer(b"".join(out), dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of ids, special tokens included: without a decoder the tokens stand side by side with spaces."""
        return b" ".join(map(self.decoded.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def encoder(name: str) -> PrefixBPE:
    """One encoder for each worker process; its store lives across tasks."""
    return PrefixBPE(public_tokenizers.path(name))


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "word_bpe_49k.json", keep_ids: bool = False,
    place_col: str | None = None,
) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 of each row; with *keep_ids* also the ids and the decoded text,
    with *place_col* that bigint column as ``position``."""
    kind = docs.select(column(id_col)).schema[0].dataType.simpleString()
    rows = docs.select(column(id_col).alias("id"), F.coalesce(column(text_col), F.lit("")).cast("binary").alias("text"), *([column(place_col)] if place_col else []))
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
    if keep_ids:
        schema, names = f"{schema}, ids array<int>, decoded string", [*names, "ids", "decoded"]
    if place_col:
        schema, names = f"{schema}, position bigint", [*names, "position"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for batch in batches:
            counts, digests, decodings, all_ids, texts = [], [], [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py())
                decoded = bpe.decode(ids)
                counts.append(len(ids))
                digests.append(hashlib.sha256(ids.tobytes()).hexdigest())
                decodings.append(hashlib.sha256(decoded).hexdigest())
                if keep_ids:
                    all_ids.append(ids.tolist())
                    texts.append(decoded.decode())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decodings, pa.string())]
            if keep_ids:
                columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
            if place_col:
                columns.append(batch.column(2))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(rows, run, schema)
