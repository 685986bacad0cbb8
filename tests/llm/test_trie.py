"""The trie of conversation prefixes against a trie of Python dictionaries."""

import hashlib
import random
import re
import zlib

import pytest

from ledgerline.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def own_turns(rows):
    out = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            out.setdefault(c, []).append(((turn is not None, turn or 0), digest, role, text))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in out.items()}


def brute(rows, share_heads):
    turns = own_turns(rows)
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4 if share_heads else 0
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = [*(turns.get(base, [])[:h] if h else []), *own[h:]]
    members = {}
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    out = []
    for path, who in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(re.findall("[^\x20\x09-\x0d]+", p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(who) if len(whole[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(who), len(path), parent, len(who), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def check(spark, rows, share_heads=True, parts=3, block=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = pt.prefix_trie(df, share_heads=share_heads, block=block)
    assert found.columns == COLUMNS
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute(rows, share_heads), key=key)


def random_rows(seed, n, texts=4, longest=14):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 200), n):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, rng.choice(["user", "bot"]), " ".join(["w"] * rng.randrange(texts))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, share, block", [(1, True, 4), (2, False, 4), (3, True, 1), (4, False, 3)])
def test_matches_brute_force(spark, seed, share, block):
    check(spark, random_rows(seed, 45), share, block=block)


def test_bad_rows_ties_and_equal_conversations(spark):
    rows = [(None, 1, "user", "lost"), (40, None, None, None), (40, None, "user", "a b"), (40, 3, "user", " \t a b\n"), (40, 3, "user", " \t a b\n")]
    rows += [(41, 1, "us", "er"), (42, 1, "user", ""), (43, 1, "", "user"), (44, -5, "user", "x" * 100_000), (44, -5, "bot", "x")]
    rows += [(100 + i, t, "user", f"turn {t}") for i in range(40) for t in range(9)]  # copies
    rows += [(300 + i, 0, "user", "same start") for i in range(30)] + [(300 + i, 1, "bot", f"{i}") for i in range(30)]
    rows += [(7, 0, "user", "one turn of a conversation whose base is missing")]
    for share in (True, False):
        check(spark, rows, share)


def test_one_conversation_over_many_partitions(spark):
    rows = [(20, t, "user", f"{t % 7} {t % 3}") for t in range(150)] + [(c, t, "user", f"{t % 7} {t % 3}") for c in (21, 22, 25) for t in range(0, 60, c - 19)]
    rows += [(23, 1, "user", "equal")] * 70 + [(c, 0, "bot", "") for c in range(60, 70)]
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, rows, True)
        check(spark, rows, False)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)


def test_prefix_sums_over_several_stretches(spark, monkeypatch):
    monkeypatch.setattr(pt, "SUPER", 2)
    monkeypatch.setattr(pt, "SHARE", 3)
    check(spark, random_rows(8, 30, texts=2, longest=60))


def test_empty_table_and_further_columns(spark):
    assert pt.prefix_trie(spark.createDataFrame([], SCHEMA), share_heads=True).isEmpty()
    df = spark.createDataFrame([(1, 0, "user", "a b", 5, "x")], SCHEMA + ", blk int, _c string")
    found = {r.depth: r for r in pt.prefix_trie(df).collect()}
    assert found[0].n_children == 1 and found[1].n_convs == 1 and found[1].parent_conv_id == 1 and found[0].parent_conv_id is None
