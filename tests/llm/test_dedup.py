"""Exact and near dedup against brute force on small tables with bad rows."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from ledgerline.llm import content_dedup, simhash
from ledgerline.llm.components import components

ROWS = [
    (1, "Alpha beta", "a", "x"),
    (2, "alpha BETA", "b", "y"),
    (2, "alpha BETA", "b", "y"),
    (None, "ALPHA beta", None, None),
    (3, None, "a", "x"),
    (4, "", None, "z"),
    (5, "Äpfel", "a", "x"),
    (6, "äpfel", "a", "x"),
    (7, "x" * 50_000, "a", "x"),
    (None, "only here", "a", "x"),
]
SCHEMA = "doc_id bigint, text string, _hash string, `kept.x` string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def groups(rows, keep):
    out = {}
    for i, row in enumerate(rows):
        out.setdefault(lower(row[1]), []).append(i)
    result = []
    for text, members in out.items():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        best = (max(ids) if keep == "largest" else min(ids)) if ids else None
        for i in members:
            result.append((rows[i][0], best, len(members), hashlib.sha256(text.encode()).hexdigest()))
    return result


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_copies_match_brute_force(spark, keep):
    rows = ROWS + [(100 + i, "hot copy", "a", "x") for i in range(60)] + [(9, "same id and text", "a", "x")] * 40
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = content_dedup.exact_copies(docs, keep=keep).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=key)
    assert got == sorted(groups(rows, keep), key=key)
    # Exactly one row of each group stays, and it is one with the id that stays.
    stays = [r for r in found if r.kept]
    assert len({r.text_sha256 for r in found}) == len(stays)
    assert all(r.doc_id == r.keep_id for r in stays)

    left = content_dedup.drop_exact_copies(docs, keep=keep)
    assert left.columns == docs.columns
    kept = left.collect()
    assert len(kept) == len(stays) == len({lower(r.text) for r in kept})


def test_exact_copies_of_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert content_dedup.exact_copies(docs).count() == 0
    assert content_dedup.drop_exact_copies(docs).count() == 0
    with pytest.raises(ValueError):
        content_dedup.exact_copies(docs, keep="any")


def brute_print(text):
    words = [w.lower() for w in (text or "").encode().split()]
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 2:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def documents(seed=3):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(200)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(60, 300)))) for i in range(40)]
    for i in range(40, 90):
        text = rng.choice(rows[:40])[1].split(" ")
        text[rng.randrange(len(text))] = "changed"
        rows.append((i, " ".join(text)))
    return rows + [(90, None), (91, ""), (92, " \t\n"), (93, "One"), (94, "one two"), (95, "one\x0btwo\x1cthree"), (96, rows[0][1].upper())]


def test_near_copies_match_brute_force(spark):
    rows = documents()
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id bigint, text string, fingerprint string").repartition(3)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_copies(docs).collect()}
    prints = [brute_print(t) for _, t in rows]
    assert found == {rows[i][0]: (f"{prints[i]:016x}", rows[c][0]) for i, c in enumerate(brute_components(prints))}
    left = simhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, c in found.values()})


def test_near_copies_with_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (5, "a b c"), (None, None)], "doc_id bigint, text string")
    found = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_copies(docs).collect())
    assert found == [("5", "5"), ("5", "5"), ("None", "5"), ("None", "None")]
    assert simhash.near_copies(docs.limit(0)).count() == 0
    assert simhash.drop_near_copies(docs.limit(0)).count() == 0


def test_rows_that_share_an_id_are_judged_one_by_one(spark):
    text = " ".join(f"word{i}" for i in range(400))
    changed = (text.replace(f"word{i} ", "other ") for i in range(400))
    near = next(t for t in changed if (simhash.fingerprint(text.encode()) ^ simhash.fingerprint(t.encode())).bit_count() <= 2)
    far = " ".join(f"else{i}" for i in range(90))
    rows = [(1, text), (2, near), (2, far), (None, near), (None, "alone and without an id"), (3, None), (4, "")]
    left = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    got = sorted(map(tuple, left.collect()), key=str)
    assert got == sorted([(1, text), (2, far), (None, "alone and without an id"), (3, None)], key=str)


def test_a_class_with_very_many_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARE", 3)
    rows = documents(5)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in simhash.near_copies(docs).collect()}
    prints = [brute_print(t) for _, t in rows]
    assert found == {rows[i][0]: rows[c][0] for i, c in enumerate(brute_components(prints))}


@pytest.mark.parametrize("run_limit", [2048, 4])
@pytest.mark.parametrize("segments", [5, 7, 9])
def test_links_join_what_is_close(spark, run_limit, segments):
    rng = random.Random(segments)
    values = [rng.getrandbits(64) for _ in range(30)]
    for _ in range(90):
        v = rng.choice(values)
        for b in rng.sample(range(64), rng.randint(1, 3)):
            v ^= 1 << b
        values.append(v)
    values = sorted(set(values))
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    prints = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    found = simhash.links(prints, segments=segments, run_limit=run_limit)
    for r in found.collect():
        assert (r.a ^ r.b & (2**64 - 1)) is not None
    classes = {r.node: r.component for r in components(found).collect()}
    want = brute_components(values)
    ours = {}
    for i, s in enumerate(signed):
        ours.setdefault(classes.get(s, s), []).append(i)
    brute = {}
    for i, c in enumerate(want):
        brute.setdefault(c, []).append(i)
    assert sorted(map(tuple, ours.values())) == sorted(map(tuple, brute.values()))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 199), (199, 200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 160)} | {199: 199, 200: 199}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
