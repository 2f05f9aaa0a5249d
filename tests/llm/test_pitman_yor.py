import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import pitman_yor as hpy


def tokens(text):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    return re.findall(rb"[^\x20\x09-\x0d]+", raw) + [b"\n"]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def check(got, rows):
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
                   sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows)
    found = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    assert [f[:5] for f in found] == [w[:5] for w in want]
    assert [f[5] for f in found] == pytest.approx([w[5] for w in want], abs=1e-6)
    assert all(r.score < 0 and r.perplexity >= 1 for r in got)


@pytest.fixture()
def small_bins(monkeypatch):
    """Many bins, restaurants cut into rooms and several chunks, as on large tables."""
    monkeypatch.setattr(hpy, "BIN_TOKENS", 5000)
    monkeypatch.setattr(hpy, "ROOM_TOKENS", 300)
    monkeypatch.setattr(hpy, "CHUNK_BYTES", 100_000)


@pytest.mark.parametrize("cut", [False, True])
def test_base_model_and_held_out_gain(documents, cut, request):
    if cut:
        request.getfixturevalue("small_bins")
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = hpy.score_texts(documents).collect()
    check(got, rows)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > 0.85 * sum(r.base_score for r in out)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_probabilities_sum_to_one():
    """The parent's over known words and the unknown one, and a restaurant's over the same outcomes."""
    rng = np.random.default_rng(3)
    tables = rng.integers(1, 9, 50).astype(float)
    outcomes = np.append(tables, 0.0)
    root = hpy.root_probability(outcomes, tables.sum(), 50.0, 0.4)
    assert root.sum() == pytest.approx(1.0)
    n = np.append(rng.integers(0, 6, 50), 0).astype(float)
    t = np.minimum(n, rng.integers(1, 4, 51))
    own = ((n - 0.7 * t) + (hpy.THETA + 0.7 * t.sum()) * root) / (hpy.THETA + n.sum())
    assert own.sum() == pytest.approx(1.0)


def test_seating_follows_the_exact_distribution():
    """Tables of one dish against enumeration: the weight of t tables is S(n, t) times the rising product of openings."""
    n, d, theta, base, others = 7, 0.6, 1.5, 0.2, 3.0
    s = {(1, 1): 1.0}
    for k in range(1, n):
        for t in range(1, k + 2):
            s[k + 1, t] = s.get((k, t - 1), 0.0) + (k - d * t) * s.get((k, t), 0.0)
    w = np.array([s[n, t] * np.prod([(theta + d * (others + j)) * base for j in range(t)]) for t in range(1, n + 1)])
    rng, size = np.random.default_rng(4), 60_000
    arg = np.full(size, float(n)), np.full(size, others), np.full(size, base), d, theta, rng
    now, weight = hpy._seat(*arg)
    for _ in range(6):
        new, new_weight = hpy._seat(*arg)
        take = np.log(rng.random(size)) < new_weight - weight
        now, weight = np.where(take, new, now), np.where(take, new_weight, weight)
    found = np.bincount(now.astype(int), minlength=n + 1)[1:] / size
    assert np.abs(found - w / w.sum()).max() < 0.01


@pytest.mark.parametrize("n,others,base", [(400, 50.0, 0.05), (3000, 2000.0, 0.2), (900, 5.0, 1e-4)])
def test_groups_agree_with_one_by_one(monkeypatch, n, others, base):
    size = 3000
    arg = np.full(size, float(n)), np.full(size, others), np.full(size, base), 0.7, 1.0
    fast, fast_w = hpy._seat(*arg, np.random.default_rng(1))
    monkeypatch.setattr(hpy, "ONE_BY_ONE", n + 1)
    slow, slow_w = hpy._seat(*arg, np.random.default_rng(2))
    assert fast.mean() == pytest.approx(slow.mean(), rel=0.02, abs=0.02)
    assert fast.std() == pytest.approx(slow.std(), rel=0.08, abs=0.04)
    assert fast_w.mean() == pytest.approx(slow_w.mean(), rel=0.002)


def exact_tables(n, others, base, d, theta):
    """Probabilities of 1 to n tables of a dish, by the recursion of the generalised Stirling numbers."""
    log_s = np.full(n + 2, -np.inf)
    log_s[1] = 0.0
    t = np.arange(1, n + 1)
    with np.errstate(divide="ignore"):
        for k in range(1, n):
            log_s[1:-1] = np.logaddexp(log_s[:-2], np.log(np.maximum(k - d * t, 0)) + log_s[1:-1])
    w = log_s[1:-1] + np.cumsum(np.log((theta + d * (others + t - 1)) * base))
    return np.exp(w - w.max()) / np.exp(w - w.max()).sum()


@pytest.mark.parametrize("n,others,base,d", [(20, 50, 0.01, 0.8), (20, 5, 0.3, 0.1), (200, 500, 0.01, 0.5),
                                             (200, 20, 0.001, 0.9), (2000, 5000, 0.01, 0.5), (2000, 5000, 0.01, 0.8),
                                             (2000, 20, 0.05, 0.5), (2000, 20, 0.05, 0.1)])
def test_sampled_tables_have_the_exact_mean(n, others, base, d):
    """As the rounds call it: many restaurants, each with one dish of n customers among dishes of one."""
    size = 400

    class Restaurants:
        contexts, tokens, is_cut = np.arange(size), np.arange(2), np.zeros(size, bool)
        context = np.repeat(np.arange(size), others + 1)
        token = np.tile(np.append(np.ones(others, int), 0), size)
        n = np.tile(np.append(np.ones(others, int), 0), size)

        def per_context(self, x):
            return np.bincount(self.context, weights=x, minlength=size)

    b = Restaurants()
    b.n = np.where(b.token == 0, n, 1)
    draws = hpy.sample_tables(b, np.array([base, 0.1]), np.empty(0), d, 1.0, np.random.default_rng(5), 3)
    found = np.array([x[b.token == 0] for x in draws])
    p = exact_tables(n, others, base, d, 1.0)
    mean = p @ np.arange(1, n + 1)
    sd = (p @ (np.arange(1, n + 1) - mean) ** 2) ** 0.5
    assert abs(found.mean() - mean) < 4 * sd / size ** 0.5 + 0.005 * mean, (found.mean(), mean, sd)
    assert found.std() == pytest.approx(sd, rel=0.15, abs=0.02)


@pytest.mark.parametrize("d", [0.05, 0.3, 0.5, 0.8, 0.95])
def test_stirling_numbers_agree_with_their_recursion(d):
    for n in (65, 300, 2000):
        log_s = np.full(n + 2, -np.inf)
        log_s[1] = 0.0
        t = np.arange(1, n + 1)
        with np.errstate(divide="ignore"):
            for k in range(1, n):
                log_s[1:-1] = np.logaddexp(log_s[:-2], np.log(np.maximum(k - d * t, 0)) + log_s[1:-1])
        got = hpy.log_stirling(np.full(n, n), t, d)
        diff = got - log_s[1:-1]
        assert np.abs(diff - diff[0]).max() < 1e-3, (n, np.abs(diff - diff[0]).argmax() + 1, np.abs(diff - diff[0]).max())


def test_steps_grow_with_the_logarithm():
    rng, calls = np.random.default_rng(1), []
    seat = lambda n: hpy._seat(np.array([n]), np.array([n / 10]), np.array([0.1]), 0.7, 1.0, rng)
    calls = [seat(float(n))[0][0] for n in (10**4, 10**6, 10**9)]
    assert all(0 < t < n for t, n in zip(calls, (10**4, 10**6, 10**9)))


def test_packing():
    for a in (np.empty(0, np.uint64), np.array([0]), np.array([255, 256, 70_000, 2**40]), np.array([2**64 - 1], np.uint64)):
        assert (hpy.unpack(hpy.pack(a, a))[1] == a).all()


def test_odd_rows(odd, odd_rows, small_bins):
    got = hpy.score_texts(odd).collect()
    check(got, odd_rows)


def test_nothing_to_learn_and_no_rows(spark, odd):
    alone = [i for i in range(1, 60) if held(i)][:3]
    got = hpy.score_texts(spark.createDataFrame([(i, "a b") for i in alone], "doc_id long, text string")).collect()
    assert [(r.n_known, r.train_tokens, r.score) for r in got] == [(0, 0, 0.0)] * 3
    assert hpy.score_texts(odd.limit(0)).count() == 0
