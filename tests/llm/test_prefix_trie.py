import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"
FIELDS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [(r, t) for _, r, t in sorted(v)] for c, v in convs.items()}
    members, ends = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        path = tuple(convs.get(base, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    found = []
    for node, m in members.items():
        below = [u for u in members if u[:len(node)] == node]
        kids = {u[:-1] for u in members if u}
        words = lambda u: len(re.findall(r"[^\x20\x09-\x0D]+", u[-1][1])) if u else 0
        found.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m),
                      sum(len(u) == len(node) + 1 for u in below), sum(u not in kids for u in below),
                      sum((len(members[u]) - 1) * words(u) for u in below),
                      hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()))
    return sorted(found, key=str)


def check(df, rows):
    assert sorted((tuple(r[f] for f in FIELDS) for r in T.prefix_trie(df).collect()), key=str) == brute(rows)


def drawn(seed, convs=60, most=6):
    rng = random.Random(seed)
    return [(c, turn, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "d  e f", ""]))
            for c in range(convs) for turn in range(rng.randrange(1, most))]


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    rows = drawn(seed)
    check(spark.createDataFrame(rows, SCHEMA).repartition(3), rows)


def test_odd_rows(spark):
    rows = [(0, None, "user", "a"), (0, 0, None, None), (0, 0, "user", "b"), (0, 0, "user", "b"), (1, 5, "user", "a"),
            (None, 0, "user", "a"), (None, None, None, None), (-1, 0, "user", "x"), (-20, 0, "user", "y"), (-21, 0, "u", "z"),
            (47, 0, "user", "no base"), (2**40, 1, "", ""), (7, 0, "us", "er"), (9, 0, "use", "r"), (3, 0, "user", "w " * 60_000)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", depth int, conv string, part int")
    check(df, rows)


def test_conversations_without_rebuilt_turns(spark):
    rows = [(c, 0, "user", "one") for c in range(21, 40)]  # their base has no rows
    check(spark.createDataFrame(rows, SCHEMA), rows)


def test_long_conversation_over_many_partitions(spark):
    rows = [(c, t, "user", f"t{t % 3}") for c in (20, 40) for t in range(60)] + drawn(5, 20, 4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        check(spark.createDataFrame(rows, SCHEMA).repartition(4), rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_copies_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 7)
    rows = [(c, t, "user", f"t{t}") for c in range(100) for t in range(3)]
    check(spark.createDataFrame(rows, SCHEMA), rows)


def test_no_rows(spark):
    assert T.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_collisions_are_found_and_avoided(spark, monkeypatch):
    """The first set of hashes has hardly any values: the check must notice and take the next one."""
    rows = drawn(1, 30)
    plain, tried = T._turn_hashes, []

    def weak(seed):
        tried.append(seed)
        return plain(seed) if seed else [(h % 2).alias(f"h{k}") for k, h in enumerate(plain(seed), 1)]

    monkeypatch.setattr(T, "_turn_hashes", weak)
    check(spark.createDataFrame(rows, SCHEMA), rows)
    assert max(tried) == 1


def test_products_compose():
    m = T.Monoid(3)
    rng = np.random.default_rng(0)
    turns = rng.integers(-2**62, 2**62, 20)
    v = m.value(0, turns)
    whole = (v * m.power(0, np.arange(20))).sum(dtype=np.uint64)
    for cut in (0, 1, 7, 20):
        head = (v[:cut] * m.power(0, np.arange(cut))).sum(dtype=np.uint64)
        tail = (v[cut:] * m.power(0, np.arange(20 - cut))).sum(dtype=np.uint64)
        assert m.then(0, np.array([cut]), head, tail)[0] == whole
        assert (m.power(0, np.array([-cut])) * (np.array([whole]) - head))[0] == tail
