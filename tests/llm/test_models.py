"""Language identification, mixing, nearest vectors and the pipeline."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import mixing, permutation_index, ppm_language, prefix_bpe, simhash
from ledgerline.llm.common import ascii_lower, unused
from ledgerline.llm.queries import QUERIES, REST_WEIGHT, WEIGHTS

SF = "/root/testdata/sf0.001"


def test_helpers(spark):
    df = spark.createDataFrame([("ABCÄÖ",), ("Plain",), (None,)], "_x string")
    assert [r[0] for r in df.select(ascii_lower(F.col("_x"))).collect()] == ["abcÄÖ", "plain", None]
    assert unused(df, "_x", "_y", "_y") == ["_x_", "_y", "_y_"]


# Language


def test_code_lengths_are_exact():
    """The table against a plain walk through the context trees."""
    text, other = b"abracadabra abc", b"xyxyzzy"
    rows = []
    for k, t in enumerate((text, other)):
        whole = ppm_language.START + t
        for gram, n in Counter(whole[i : i + 3] for i in range(len(t))).items():
            rows.append((k, int.from_bytes(gram, "big"), n))
    trees = ppm_language.build(["one", "two"], *[np.array(c) for c in zip(*rows)])

    def probability(k, context, byte):
        own = [(g.to_bytes(3, "big"), n) for language, g, n in rows if language == k]
        levels = []
        for length in (0, 1, 2):
            seen = Counter()
            for g, n in own:
                if g[2 - length : 2] == context[2 - length :]:
                    seen[g[2]] += n
            levels.append(seen)

        def level(order, b):
            if order < 0:
                return 1 / 256
            seen = levels[order]
            if not seen:
                return level(order - 1, b)
            total, kinds = sum(seen.values()), len(seen)
            if seen[b]:
                return seen[b] / (total + kinds)
            left = 1 - sum(level(order - 1, x) for x in seen)
            return kinds / (total + kinds) * level(order - 1, b) / left

        return level(2, byte)

    for probe in (b"abra", b"zzy", b"q", b"", bytes(range(97, 123))):
        whole = ppm_language.START + probe
        want = [-sum(np.log2(probability(k, whole[i : i + 2], whole[i + 2])) for i in range(len(probe))) for k in (0, 1)]
        assert trees.code_lengths(probe) == pytest.approx(want, rel=1e-4)
    assert trees.predict(b"abracadabra")[0] == "one"


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: r for r in ppm_language.predict_languages(docs).collect()}
    right = [
        found[r.doc_id].lang_pred == r.lang
        for r in docs.where("lang is not null and text is not null").collect()
        if zlib.crc32(str(r.doc_id).encode()) % 3 == 1
    ]
    assert len(right) > 30 and np.mean(right) > 0.95
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 for i, r in found.items())


def test_language_of_bad_rows(spark):
    rows = [(i, "the cat and the dog", "en", "u") for i in range(6)] + [(i, "le chat et le chien", "fr", "u") for i in range(10, 16)]
    rows += [(20, None, "en", None), (21, "", None, "u"), (22, "123 !?", "fr", "u"), (None, "the cat", None, "u"), (23, "日", None, "u")]
    rows += [(0, "the cat and the dog", "en", "u")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    found = [(r.doc_id, r.lang_pred) for r in ppm_language.predict_languages(docs).collect()]
    assert len(found) == len(rows)
    assert {p for i, p in found if i in (20, 21, 22)} == {"und"}
    assert (None, "en") in found and {p for i, p in found if i is not None and i < 6} == {"en"}
    left = ppm_language.drop_unknown(docs)
    assert left.columns == docs.columns and {20, 21, 22}.isdisjoint({r.doc_id for r in left.collect()})
    assert ppm_language.predict_languages(docs.limit(0)).count() == 0
    nameless = ppm_language.predict_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nameless} == {("und", 0.0)}


def test_nothing_is_dropped_if_nothing_was_learned(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12", None), (3, None, None)], "doc_id bigint, text string, lang string")
    assert ppm_language.drop_unknown(docs).count() == 3


# Mixing


def pfair(shares):
    period, done, out = sum(shares), [0] * len(shares), []
    for slot in range(period):
        ready = [(-(-(done[i] + 1) * period // w), i) for i, w in enumerate(shares) if done[i] * period // w <= slot]
        i = min(ready)[1]
        out.append((slot, i, done[i], list(done)))
        done[i] += 1
    return out


@pytest.mark.parametrize("shares", [[1], [1, 1], [3, 2, 5], [20, 10, 8, *[3] * 17, 11], [97, 1, 2]])
def test_schedule_deviates_by_less_than_a_block(spark, shares):
    plan = [(r.slot, r.stream, r.nth, r.before) for r in mixing.schedule(spark, shares).orderBy("slot").collect()]
    assert plan == pfair(shares)
    for slot, _, _, before in plan:
        assert all(abs(b - slot * w / sum(shares)) < 1 for b, w in zip(before, shares))


def test_mix_is_a_permutation_in_pfair_order(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None, "zz"]), "keep") for i in range(500)] + [(1, "a", "keep")] * 3 + [(None, "b", None)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, slot string").repartition(4)
    mixed = mixing.mix(docs, {"a": 5, "b": 3}, 2, block_rows=4, names=("blk", "slt", "pos")).collect()
    assert sorted(r.pos for r in mixed) == list(range(len(rows)))
    assert Counter((r.doc_id, r.source, r.slot) for r in mixed) == Counter(rows)
    mixed.sort(key=lambda r: r.pos)
    assert [r.slt for r in mixed] == sorted(r.slt for r in mixed)
    stream = {"a": 0, "b": 1}
    plan = pfair([5, 3, 2])
    for r in mixed:
        slot, i, nth, _ = plan[r.slt % 10]
        assert i == stream.get(r.source, 2) and r.blk == nth + r.slt // 10 * [5, 3, 2][i]
    ordered = mixing.in_mixed_order(docs, {"a": 5, "b": 3}, 2, block_rows=4)
    assert ordered.columns == docs.columns
    assert [r.source for r in ordered.collect()] == [r.source for r in mixed]
    assert mixing.mix(docs.limit(0), {"a": 1}).count() == 0
    assert mixing.mix(docs, {}, 1, names=("blk", "slt", "pos")).count() == len(rows)
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 0})


# Nearest vectors


def test_nearest_vectors_match_brute_force_on_few(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=5).tolist(), 1.0) for i in range(60)]
    bad = [(100, None, 1.0), (120, [0.0] * 5, 1.0), (140, [1.0, None, 1.0, 1.0, 1.0], 1.0), (160, [float("nan")] * 5, 1.0)]
    bad += [(180, [float("inf")] + [1.0] * 4, 1.0), (200, [1.0, 2.0], 1.0), (220, [], 1.0), (None, [1.0] * 5, 1.0)]
    vectors = spark.createDataFrame(rows + bad + [rows[0], (61, rows[5][1], 2.0)], "vec_id bigint, embedding array<double>, score double")
    found = permutation_index.search(vectors, "id % 20 = 0", k=7).collect()
    ids = np.array([r[0] for r in rows] + [61])
    matrix = np.array([r[1] for r in rows] + [rows[5][1]])
    for q in (0, 20, 40):
        scores = matrix @ matrix[q]
        scores[q] = -np.inf
        order = np.lexsort((ids, -scores))[:7]
        own = sorted([r for r in found if r.query_id == q], key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 8))
        assert [r.vec_id for r in own] == ids[order].tolist()
        assert [r.score for r in own] == pytest.approx(scores[order].tolist(), rel=1e-12)
    assert {r.query_id for r in found} == {0, 20, 40}
    assert permutation_index.search(vectors.limit(0), "id % 20 = 0").count() == 0
    assert permutation_index.search(vectors.where("vec_id = 20"), "id % 20 = 0").count() == 0


def test_nearest_vectors_recall(spark):
    found = {}
    for r in QUERIES["op10_nearest_vectors"](spark, "/root/testdata/sf0.01").collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").toArrow()
    ids, matrix = table.column("vec_id").to_numpy(), np.array(table.column("embedding").to_pylist())
    recall = []
    for q in np.flatnonzero(ids % 20 == 0):
        scores = matrix @ matrix[q]
        scores[q] = -np.inf
        recall.append(len(found[ids[q]] & set(ids[np.lexsort((ids, -scores))[:20]].tolist())) / 20)
    assert np.mean(recall) >= 0.9


def test_nearest_vectors_with_many_copies(spark):
    """A third of the rows is one vector; queries at it, near it and elsewhere."""
    rng = np.random.default_rng(11)
    matrix = rng.normal(size=(1500, 16))
    matrix[rng.permutation(1500)[:500]] = matrix[0]
    matrix[20] = matrix[0] + 0.01
    matrix[40] = matrix[0]
    matrix[60] = 3.0
    rows = [(i, v.tolist()) for i, v in enumerate(matrix)]
    vectors = spark.createDataFrame(rows + [(7, matrix[0].tolist())] * 2, "vec_id bigint, embedding array<double>").repartition(5)
    found = {}
    for r in permutation_index.search(vectors, "id in (0, 20, 40)", k=20).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    copies = np.flatnonzero((matrix == matrix[0]).all(axis=1)).tolist()
    copies = sorted({*copies, 7})
    for q in (0, 20, 40):
        scores = matrix @ matrix[q]
        above = set(np.flatnonzero(scores > matrix[0] @ matrix[q] + 1e-9).tolist()) - {q}
        want = [c for c in copies if c != q and c not in above][: 20 - len(above & set(found[q]))]
        assert [i for i in found[q] if i in copies and i not in above] == want
        assert len(found[q]) == 20
    one = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(100)], "vec_id bigint, embedding array<double>")
    assert [r.vec_id for r in permutation_index.search(one, "id = 5", k=4).orderBy("rank").collect()] == [0, 1, 2, 3]
    twice = spark.createDataFrame([(0, [1.0, 1.0]), (1, [9.0, 9.0]), (1, [8.0, 8.0]), (2, [1.0, 2.0])], "vec_id bigint, embedding array<double>")
    assert [r.vec_id for r in permutation_index.search(twice, "id = 0", k=2).orderBy("rank").collect()] == [1, 2]


def test_compared_share_does_not_shrink():
    assert permutation_index.reach(5) == (5, 5) and permutation_index.reach(453) == (12, 24)
    for n in (453, 900, 1789, 3464, 4096, 9000):
        posts, visits = permutation_index.reach(n)
        assert posts * visits / n >= 12 * 24 / 453 and visits <= n


# Pipeline


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    told = {r.doc_id: r for r in ppm_language.predict_languages(docs).collect()}
    kept = [r for r in rows if told[r["doc_id"]].lang_pred != "und" and told[r["doc_id"]].score >= 0.5]
    best = {}
    for r in kept:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"])
        if low not in best or best[low]["doc_id"] < r["doc_id"]:
            best[low] = r
    left = sorted(best.values(), key=lambda r: r["doc_id"])
    prints = [simhash.fingerprint(r["text"].encode()) for r in left]
    root = list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    left = [r for i, r in enumerate(left) if root[i] == i]
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(found) == {r["doc_id"] for r in left}
    encoder = prefix_bpe.encoder("word_bpe_49k.json")
    assert all(found[r["doc_id"]].n_tokens == len(encoder.encode(r["text"].encode())) for r in left)


def test_stages_take_bad_rows(spark):
    rows = [(1, None, None, None, None), (None, "some words here", "en", "src0", 3), (2, "", "en", "src0", 0), (3, "12 34", "fr", None, 1)]
    rows += [(4, "some words here", "en", "src9", 3), (4, "some words here", "en", "src9", 3), (5, "x" * 100_000, "de", "new", 9)]
    docs = spark.createDataFrame([(*r, "e") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, position string")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF)
            if name != "encode":
                assert out.columns == docs.columns
            out.collect()


def test_production_weights_are_positive():
    assert min(WEIGHTS.values()) > 0 and len(corpus_pipeline.STAGES) == 5


def test_the_mix_decides_the_positions_of_the_pipeline(spark, tmp_path):
    """Positions that come out of encode are those of the mix, though files are read by size."""
    docs = spark.createDataFrame(
        [(i, "word " * (1 + i % 7 * 40), "en", f"src{i % 4}", 5) for i in range(400)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    stages = dict(corpus_pipeline.STAGES)
    mixed = stages["mix"](spark, docs, SF)
    path = str(tmp_path / "mixed")
    mixed.write.option("maxRecordsPerFile", 37).parquet(path)
    found = stages["encode"](spark, spark.read.parquet(path), SF).collect()
    want = {r.doc_id: r.p for r in mixing.mix(docs, WEIGHTS, REST_WEIGHT, names=("b", "s", "p")).collect()}
    assert {r.doc_id: r.position for r in found} == want and sorted(want.values()) == list(range(400))
    plain = stages["encode"](spark, docs, SF).collect()
    assert {r.doc_id: r.position for r in plain} != want
