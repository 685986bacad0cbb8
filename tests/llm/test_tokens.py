"""BPE, token files and token counts against the library and brute force."""

import functools
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import length_histogram, prefix_bpe, token_files
from ledgerline.llm.library_bpe import library

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
TEXTS = [
    None,
    "",
    " ",
    "Hello, world! It's 2024 & the cat's 3rd.",
    "Ünïcode é é İstanbul ẞ 日本語 \U0001f600",
    "two  spaces\n\nlines \n x\t\r\n end  nb\x1c\x85",
    "a<|endoftext|>b <|startoftext|> c",
    "ab" * 3000,
    "Hello, world! It's 2024 & the cat's 3rd.",
]


def tokenizer(name):
    found = Tokenizer.from_file(public_tokenizers.path(name))
    found.no_truncation()
    found.no_padding()
    return found


def frame(spark, texts=TEXTS):
    rows = [(i if i % 4 else None, t, "n") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")


ALPHABET = st.text(st.sampled_from("aabbethingso  \n\t'.,!19é́İΣ日\U0001f600\x1c\x85 "), max_size=60)


@settings(max_examples=300, deadline=None)
@given(ALPHABET)
def test_prefixes_encode_like_the_library(text):
    ids = prefix_bpe.encoder(WORD).encode(text.encode())
    want = tokenizer_of(WORD).encode(text, add_special_tokens=False).ids
    assert ids.tolist() == want
    assert prefix_bpe.encoder(WORD).decode(ids).decode() == tokenizer_of(WORD).decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(ALPHABET)
def test_words_encode_like_the_library(text):
    encoder = library(BYTE)
    ids = np.frombuffer(encoder.encode(text.encode()), dtype=encoder.width).tolist()
    assert ids == tokenizer_of(BYTE).encode(text, add_special_tokens=False).ids


_loaded = {}


def tokenizer_of(name):
    return _loaded.setdefault(name, tokenizer(name))


def test_store_is_bounded():
    store = prefix_bpe.Store(10)
    for i in range(100):
        store.put(b"%d" % i, i)
        assert len(store.young) + len(store.old) <= 20
    store.put(b"x" * 1000, 1)
    assert store.get(b"x" * 1000) is None and store.get(b"99") == 99


def test_encode_documents_match_the_library(spark):
    found = prefix_bpe.encode_documents(frame(spark), keep_ids=True).collect()
    library_ = tokenizer_of(WORD)
    want = []
    for i, text in enumerate(TEXTS):
        ids = library_.encode(text or "", add_special_tokens=False).ids
        decoded = library_.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        want.append((str(i if i % 4 else None), len(ids), digest, hashlib.sha256(decoded.encode()).hexdigest(), ids, decoded))
    got = [(str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids, r.decoded) for r in found]
    assert sorted(got) == sorted(want)
    assert prefix_bpe.encode_documents(frame(spark, [])).count() == 0


def test_token_files_round_trip(spark, tmp_path):
    docs = frame(spark).union(frame(spark)).repartition(3)
    found = token_files.written_documents(docs, str(tmp_path / "files")).collect()
    rows = sorted([(i if i % 4 else None, t) for i, t in enumerate(TEXTS)] * 2, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    at, want = 0, []
    for doc_id, text in rows:
        ids = np.array(tokenizer_of(BYTE).encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        want.append((str(doc_id), at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in found) == sorted(want)


@pytest.mark.parametrize("bucket_keys", [1 << 18, 10])
def test_token_files_are_found_by_key(spark, tmp_path, monkeypatch, bucket_keys):
    monkeypatch.setattr(token_files, "BUCKET_KEYS", bucket_keys)
    folder = str(tmp_path / "files")
    docs = spark.range(0, 500, 2).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text"))
    token_files.write(docs, folder, shards=3)
    keys = spark.range(500).select(F.col("id").alias("key"), F.lit(0).alias("nth"))
    entries = token_files.look_up(keys, folder)
    found = token_files.read(entries, folder, keep_ids=True).collect()
    assert sorted(r.key for r in found) == list(range(0, 500, 2))
    for r in found[:20]:
        assert tokenizer_of(BYTE).decode(r.ids[:-1]) == f"text number {r.key}" and r.ids[-1] == 0


def test_token_files_of_nothing(spark, tmp_path):
    assert token_files.written_documents(frame(spark, []), str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    key = rng.choice(2**62, n, replace=False).astype(np.uint64) if n else np.empty(0, np.uint64)
    nth = np.zeros(n, dtype=np.uint64)
    levels, slots = token_files.build_index(key, nth)
    assert sorted(slots.tolist()) == list(range(n))
    index, entries = opened_index(key, nth)
    kept, found = index.find(key, nth)
    assert kept.tolist() == list(range(n)) and found.tolist() == entries.tolist()
    kept, _ = index.find(key + np.uint64(1 << 63), nth)
    assert not len(kept)


def opened_index(key, nth):
    levels, slots = token_files.build_index(key, nth)
    entries = np.zeros(len(key), dtype=token_files.SLOT)
    entries["print"], entries["start"] = token_files._prints(key, nth), np.arange(len(key)) * 7
    packed = token_files.packed_index(levels, slots, entries)
    return token_files.IndexFile(pa.BufferReader(packed), len(packed)), entries


@pytest.mark.parametrize("n", [20_000, 200_000])
def test_a_lookup_reads_a_few_pages_whatever_the_number_of_keys(n):
    key, nth = np.arange(n, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
    reads = []
    for k in range(0, n, n // 50):
        index, entries = opened_index_of(key, nth)
        kept, found = index.find(key[k : k + 1], nth[k : k + 1])
        assert found["start"].tolist() == [7 * k]
        reads.append(index.bytes_read // token_files.PAGE)
    assert sum(reads) / len(reads) < 6 and max(reads) <= 16  # head, a block for each level, an entry


@functools.lru_cache(1)
def _packed(n):
    key, nth = np.arange(n, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
    levels, slots = token_files.build_index(key, nth)
    entries = np.zeros(n, dtype=token_files.SLOT)
    entries["print"], entries["start"] = token_files._prints(key, nth), np.arange(n) * 7
    return token_files.packed_index(levels, slots, entries), entries


def opened_index_of(key, nth):
    packed, entries = _packed(len(key))
    return token_files.IndexFile(pa.BufferReader(packed), len(packed)), entries


def test_token_counts_match_brute_force(spark):
    rng = random.Random(5)
    texts = [" ".join("word" for _ in range(rng.randint(0, 700))) for _ in range(60)] + [None, ""]
    rows = [(i, t, rng.choice(["a", "b", None])) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    counts = [(r[2], len(tokenizer_of(BYTE).encode(r[1] or "", add_special_tokens=False).ids)) for r in rows]
    found = length_histogram.report(length_histogram.lengths(docs, ["source"]), ["source"]).collect()
    assert {(r.source, r.n_tokens) for r in found} == set(counts)
    for r in found:
        own = [n for s, n in counts if s == r.source]
        assert r.n_docs == own.count(r.n_tokens)
        assert r.docs_longer == sum(n > r.n_tokens for n in own)
        assert r.tokens_longer == sum(n for n in own if n > r.n_tokens)
        assert r.truncated_total == sum(min(n, r.n_tokens) for n in own)
        assert r.total_tokens == sum(own)
        assert r.quantile == pytest.approx(sum(n <= r.n_tokens for n in own) / len(own))
    whole = length_histogram.report(length_histogram.lengths(docs))
    for r in length_histogram.totals_at(whole, [0, 1, 100, 333, 10_000]).collect():
        assert r.truncated_total == sum(min(n, r.limit) for _, n in counts)
        assert r.docs_longer == sum(n > r.limit for _, n in counts)
    middle = length_histogram.length_at(whole, 0.5).first()[0]
    assert middle == sorted(n for _, n in counts)[(len(counts) - 1) // 2]
    assert length_histogram.report(length_histogram.lengths(docs.limit(0))).count() == 0


def test_totals_at_limits_of_groups(spark):
    counts = {"a": [2, 2, 9], "b": [5], None: [1, 30]}
    rows = [(s, n, own.count(n)) for s, own in counts.items() for n in sorted(set(own))]
    histogram = spark.createDataFrame(rows, "source string, n_tokens bigint, n_docs bigint")
    found = length_histogram.report(histogram, ["source"])
    totals = length_histogram.totals_at(found, [0, 4, 7, 100], ["source"]).collect()
    assert len(totals) == 12
    for r in totals:
        own = counts[r.source]
        assert r.docs_longer == sum(n > r.limit for n in own) and r.total_tokens == sum(own)
        assert r.truncated_total == sum(min(n, r.limit) for n in own)
    middle = {r.source: r.n_tokens for r in length_histogram.length_at(found, 0.5, ["source"]).collect()}
    assert middle == {"a": 2, "b": 5, None: 1}
