"""FM-index, and passages of a benchmark in documents, against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import fm_decontamination as fm

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        n = min(width, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                who = windows.get(tuple(words[i : i + n]))
                if who:
                    hit |= set(range(i, i + n))
                    found |= {str(w) for w in who if w is not None}
        out.append((doc, len(words), len(hit), sorted(found)))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def check(spark, docs, items, width=10, parts=3):
    left = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(parts)
    right = spark.createDataFrame(items, "item_id bigint, text string")
    found = fm.passages(left, right, width=width).collect()
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found]
    assert sorted(got, key=key) == sorted(brute(docs, items, width), key=key)
    return found


@pytest.mark.parametrize("seed", range(25))
def test_index_matches_plain_search(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, rng.integers(2, 9), rng.integers(1, 400))
    text[-1] = 0
    assert sorted(fm.suffix_array(text).tolist()) == list(range(len(text)))
    index = fm.FmIndex(text, sample=int(rng.integers(1, 9)))
    n = int(rng.integers(1, 5))
    phrases = rng.integers(1, max(2, text.max() + 1), (30, n))
    if text.max() == 0:
        return
    hit, low, high = index.search(phrases)
    places = {int(h): sorted(index.locate(np.arange(a, b)).tolist()) for h, a, b in zip(hit, low, high)}
    for i, phrase in enumerate(phrases):
        there = [p for p in range(len(text) - n + 1) if (text[p : p + n] == phrase).all()]
        assert places.get(i, []) == there
    for symbol in range(int(text.max()) + 1):
        where = rng.integers(0, len(text) + 1, 5)
        transform = text[fm.suffix_array(text) - 1]
        assert index.rank(np.full(5, symbol), where).tolist() == [(transform[:w] == symbol).sum() for w in where]


def test_words_and_hashes():
    texts = ["Ab c\x00d", None, "", "é\u2003ß x9", "_A_", "end", "end", "x" * 9000]
    words = fm.Words(pa.array(texts))
    body, at = words.spaced(np.arange(len(words.starts)))
    found = [body.tobytes()[a : b - 1].decode() for a, b in zip(at, at[1:])]
    assert found == [w for t in texts for w in words_of(t)]
    assert words.counts.tolist() == [len(words_of(t)) for t in texts]
    assert len(set(words.hashes.tolist())) == len(set(found))


def test_hashes_do_not_depend_on_the_pieces(monkeypatch):
    texts = pa.array(["one two three " * 50, "z" * 500 + " one"])
    whole = fm.Words(texts).hashes
    monkeypatch.setattr(fm, "PIECE", 64)
    fm._powers.cache_clear()
    assert (fm.Words(texts).hashes == whole).all()
    fm._powers.cache_clear()


def prose(rng, n, vocabulary=40):
    return [f"{rng.choice('abÄ')}{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    items = [(i, " ".join(prose(rng, rng.choice([0, 1, 3, 9, 10, 11, 30])))) for i in range(25)]
    docs = []
    for i in range(80):
        words = prose(rng, rng.choice([0, 5, 60, 300]), rng.choice([3, 40]))
        for _ in range(rng.randrange(3)):
            passage = words_of(rng.choice(items)[1])
            cut = rng.randrange(len(words) + 1)
            words[cut:cut] = passage[rng.randrange(2) :]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(words).upper() if i % 2 else " ".join(words)))
    check(spark, docs, items)


def test_bad_rows_hot_passages_and_long_texts(spark):
    rng = random.Random(9)
    passage = " ".join(prose(rng, 14, 1000))
    items = [(1, passage), (1, passage + " more"), (2, passage), (None, passage[9:]), (3, None), (4, ""), (10, "--"), (5, "w0 w1")]
    docs = [(7, passage)] * 60 + [(7, f"Before. {passage}! after")] * 60 + [(None, passage), (8, None), (9, ""), (10, "!?")]
    docs += [(11, "q " * 60_000 + passage + " " + "r" * 200_000), (12, "w0 w1 " * 20_000), (13, passage.rsplit(" ", 5)[0])]
    check(spark, docs, items)


def test_empty_tables(spark):
    docs = [(1, "a b c"), (2, None)]
    check(spark, docs, [])
    check(spark, docs, [(1, None), (2, "?")])
    check(spark, [], [(1, "a b c")])


def test_many_shards_and_blocks(spark, monkeypatch):
    rng = random.Random(4)
    items = [(i, " ".join(prose(rng, 12))) for i in range(40)]
    docs = [(i, " ".join(prose(rng, 30) + words_of(items[i % 40][1]) + prose(rng, 5))) for i in range(60)]
    left = spark.createDataFrame(docs, "doc_id bigint, text string")
    right = spark.createDataFrame(items, "item_id bigint, text string")
    folder = str(fm.work_folder(spark, "test-phrases"))
    shortest, sieve = fm._phrases(right, "item_id", "text", 10, folder)
    monkeypatch.setattr(fm, "BLOCK_ROWS", 7)
    shards = []
    for i in range(0, 60, 9):
        shard = fm.Shard(sieve, shortest)
        shard.add(pa.array([d[0] for d in docs[i : i + 9]]), pa.array([d[1] for d in docs[i : i + 9]]))
        n_hit, names, _ = shard.found(folder)
        shards += list(zip(n_hit.tolist(), names))
    assert [(n, x) for *_, n, x in brute(docs, items)] == shards
    assert left.count() == 60


def test_spans_cover_the_passage(spark):
    passage = "Zero one two three four five six seven eight nine ten"
    text = f"Ähm, {passage}. And: {passage}"
    docs = [(1, text)]
    (row,) = check(spark, docs, [(5, passage)])
    raw = text.encode()
    assert [raw[s.first_byte : s.end_byte].decode() for s in row.spans] == [passage, passage]
    assert [(s.first_word, s.words) for s in row.spans] == [(1, 11), (13, 11)]


def test_further_columns_and_other_names(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 5)], "doc_id int, text string, items string, _id int")
    items = spark.createDataFrame([("k", "a b", 1)], "item_id string, text string, n int")
    (row,) = fm.passages(docs, items).collect()
    assert (row.doc_id, row.n_hit, list(row["items"])) == (1, 2, ["k"])
    assert fm.contamination(docs, items).columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
