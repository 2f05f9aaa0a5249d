"""Scoring by a hierarchical Pitman-Yor language model over words.

Two levels of restaurants: one for each preceding word, all sharing the restaurant of single words as parent, whose own
base is diffuse (a new table there is a word never seen). Seating is drawn by Gibbs sampling, probabilities are
averaged over the samples.

Data flow. A chunk is a stretch of the input in one task; it counts its pairs of words and packs them, with the
documents they occur in, into one blob for each bin that the chunk touches. A bin owns the restaurants whose context
hashes to it; a restaurant of a frequent context is cut by its dishes into rooms in several bins. What bins need to know
of each other (customers and tables of a word in all restaurants, totals of a cut restaurant, totals of the corpus) is
summed by key and sent back to each bin that holds the key. So nothing passes through the driver but the frequent
contexts, and every task holds one bin.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .text import LOWER, SPACE, mix64, slices, word_hashes

#: Fixed hashes of the two marks around a text (no word can be told apart from them but by chance).
BEGIN, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
#: Text bytes of a chunk, tokens of a bin, customers of a room.
CHUNK_BYTES, BIN_TOKENS, ROOM_TOKENS = 8 << 20, 2_500_000, 1_000_000
#: A context is looked at for rooms when a chunk holds it with this share; at most so many contexts are cut.
FREQUENT = 1 << 16
#: Concentrations of the two levels.
THETA, THETA_ROOT = 1.0, 1.0
#: Customers seated one by one; beyond them as many at a time as this share of those seated, so that the number of
#: steps grows with the logarithm of a dish's customers.
ONE_BY_ONE, GROUP_SHARE = 48, 16
#: Sweeps of the restaurants of a bin before the first sample of a round, and Metropolis steps of a large dish in a sweep.
WARM, STEPS = 8, 2
#: Dishes of up to so many customers are drawn from their whole distribution.
SMALL = 64
#: Units of the sums of logarithms that travel as whole numbers.
_UNIT = float(1 << 32)

_CUT_MARK = np.uint64(0xA5A5A5A55A5A5A5A)


# ---- packing ----------------------------------------------------------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers >= 0 as bytes: narrow types, byte planes, compressed."""
    head, body = [len(arrays)], []
    for a in arrays:
        top = int(a.max()) if len(a) else 0
        width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
        head += [len(a), width]
        body.append(a.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes())
    raw = np.array(head, "<i8").tobytes() + b"".join(body)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob) -> list[np.ndarray]:
    blob = memoryview(blob)
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head, at, out = np.frombuffer(raw, "<i8", 2 * n, 8), 8 + 16 * n, []
    for size, width in head.reshape(-1, 2):
        planes = np.frombuffer(raw, np.uint8, size * width, at).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel())
        at += size * width
    return out


def _deltas(a: np.ndarray) -> np.ndarray:
    """Of ascending values; modulo 2**64, so that any order survives."""
    a = a.astype(np.uint64)
    return np.diff(a, prepend=np.uint64(0))


# ---- chunks -----------------------------------------------------------------------------------------------------

def _stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens with the end of each text, the token before each, and the row of each."""
    words, counts = word_hashes(texts, SPACE, LOWER)
    ends = np.cumsum(counts + 1) - 1
    token = np.empty(len(words) + len(counts), np.uint64)
    is_end = np.zeros(len(token), bool)
    is_end[ends] = True
    token[ends] = END
    token[~is_end] = words
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[ends - counts] = BEGIN
    return token, context, np.repeat(np.arange(len(counts)), counts + 1)


def _frequent(batches):
    """Tokens of each chunk (key null), and contexts that hold a share of at least 1 / FREQUENT of them."""
    for batch in slices(batches, 1, CHUNK_BYTES):
        _, context, _ = _stream(batch.column(1))
        keys, n = np.unique(context, return_counts=True)
        keys, n = keys[n * FREQUENT >= len(context)], n[n * FREQUENT >= len(context)]
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(keys.view(np.int64))]),
             pa.array(np.append([len(context)], n))], ["key", "n"])


def _bin_of(context: np.ndarray, token: np.ndarray, bins: int, cut: np.ndarray, rooms: np.ndarray) -> np.ndarray:
    """The bin of a pair; cut holds the sorted contexts that have several rooms."""
    place = context.copy()
    if len(cut):
        at = np.minimum(np.searchsorted(cut, context), len(cut) - 1)
        many = cut[at] == context
        place[many] = mix64(context[many] + np.uint64(1) + token[many] % rooms[at[many]])
    return ((place >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int32)


def _chunks(bins: int, cut: np.ndarray, rooms: np.ndarray):
    def run(batches):
        first = TaskContext.get().partitionId() << 40
        for batch in slices(batches, 1, CHUNK_BYTES):
            token, context, row = _stream(batch.column(1))
            train = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            ids = batch.column(0)
            null_id = ids.is_null().to_numpy(zero_copy_only=False)
            doc_id = ids.fill_null(0).to_numpy().view(np.uint64)
            names, token_no = np.unique(token, return_inverse=True)
            all_names = np.append(names, BEGIN)
            context_no = np.empty(len(token), np.int64)
            context_no[1:] = token_no[:-1]
            context_no[context == BEGIN] = len(names)
            pair = context_no * len(names) + token_no
            entry = np.sort(pair * np.int64(batch.num_rows) + row)
            del token, context, token_no, context_no, pair, row
            # One entry for each pair and row, with its multiplicity.
            at = np.flatnonzero(np.diff(entry, prepend=-1))
            times = np.diff(np.append(at, len(entry)))
            pair, row = np.divmod(entry[at], np.int64(batch.num_rows))
            at = np.flatnonzero(np.diff(pair, prepend=-1))
            entries = np.diff(np.append(at, len(pair)))
            customers = np.add.reduceat(times * train[row], at)
            pair = pair[at]
            c, t = pair // len(names), pair % len(names)
            b = _bin_of(all_names[c], names[t], bins, cut, rooms)
            order = np.argsort(b, kind="stable")
            begin = np.searchsorted(b[order], np.arange(bins + 1)) if bins <= len(order) else None
            groups = (np.flatnonzero(np.diff(begin)) if begin is not None else np.unique(b))
            starts = at
            blobs, owners = [], []
            for g in groups:
                if begin is not None:
                    own = order[begin[g]:begin[g + 1]]
                else:
                    lo, hi = np.searchsorted(b[order], [g, g + 1])
                    own = order[lo:hi]
                n_e = entries[own]
                pick = np.repeat(starts[own] - (np.cumsum(n_e) - n_e), n_e) + np.arange(n_e.sum())
                docs, doc_no = np.unique(row[pick], return_inverse=True)
                contexts, run = np.unique(c[own], return_inverse=True)
                toks, tok_no = np.unique(t[own], return_inverse=True)
                runs = np.bincount(run)
                blobs.append(pack(
                    _deltas(all_names[contexts]), runs, _deltas(names[toks]), tok_no, customers[own], n_e,
                    np.array([first], np.uint64), docs, _deltas(doc_id[docs]), null_id[docs].astype(np.uint8), doc_no,
                    times[pick] - 1))
                owners.append(g)
            first += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(np.array(owners, np.int32)), pa.array(blobs, pa.binary())],
                                             ["bin", "blob"])

    return run


# ---- bins -------------------------------------------------------------------------------------------------------

class Bin:
    """The restaurants of one bin: pairs in the order (context, token), with customers, and the documents' entries."""

    def __init__(self, blobs, cut: np.ndarray, entries: bool = False):
        all_ctx, all_tok, ctx, tok, n, self.parts = [], [], [], [], [], []
        at = c_at = t_at = 0
        for blob in blobs:
            contexts, runs, toks, tok_no, customers, n_e, first, docs, doc_id, null_id, doc_no, more = unpack(blob.as_buffer())
            all_ctx.append(np.cumsum(contexts.astype(np.uint64)))
            all_tok.append(np.cumsum(toks.astype(np.uint64)))
            ctx.append(np.repeat(np.arange(c_at, c_at + len(contexts)), runs))
            tok.append(tok_no.astype(np.int64) + t_at)
            c_at, t_at = c_at + len(contexts), t_at + len(toks)
            n.append(customers.astype(np.int64))
            if entries:
                pair = np.repeat(np.arange(at, at + len(tok_no), dtype=np.int32), n_e)
                self.parts.append((int(first[0]), docs, doc_id, null_id, doc_no, more, pair))
            at += len(tok_no)
        self.contexts, to_ctx = np.unique(np.concatenate(all_ctx), return_inverse=True)
        self.tokens, to_tok = np.unique(np.concatenate(all_tok), return_inverse=True)
        ctx, tok, n = to_ctx[np.concatenate(ctx)], to_tok[np.concatenate(tok)], np.concatenate(n)
        pair, self.of = np.unique(ctx * np.int64(len(self.tokens)) + tok, return_inverse=True)
        self.n = np.bincount(self.of, weights=n, minlength=len(pair)).astype(np.int64)
        self.context, self.token = pair // len(self.tokens), pair % len(self.tokens)
        self.is_cut = np.isin(self.contexts, cut)
        # Keys that are summed over bins: tokens, cut contexts, and 0 for the corpus.
        keys = np.concatenate([self.tokens, mix64(self.contexts[self.is_cut] ^ _CUT_MARK), np.zeros(1, np.uint64)])
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def per_context(self, x):
        return np.bincount(self.context, weights=x, minlength=len(self.contexts))

    def per_token(self, x):
        return np.bincount(self.token, weights=x, minlength=len(self.tokens))

    def message(self, token_rows, context_rows, total) -> np.ndarray:
        """Values in the order of the keys, a column for each quantity."""
        v = np.concatenate([np.stack(token_rows, 1), np.stack(context_rows, 1)[self.is_cut], np.array([total])])
        return v[self.order].astype(np.int64)

    def split(self, summed: np.ndarray):
        """The sums of all bins: by token, by context (own sums where it is not cut), of the corpus."""
        v = np.empty_like(summed)
        v[self.order] = summed
        t = len(self.tokens)
        return v[:t], v[t:-1], v[-1]

    def whole(self, own: np.ndarray, cut_sums: np.ndarray) -> np.ndarray:
        out = own.astype(np.float64).copy()
        out[self.is_cut] = cut_sums
        return out


def _seat(n: np.ndarray, others: np.ndarray, base: np.ndarray, d: float, theta: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """Seats n customers of each dish one after another; returns tables and the log of the path's importance weight.

    The dishes must come in descending order of n.
    others: tables of the other dishes in the restaurant; base: the parent's probability of the dish. With k seated at
    t tables the next customer opens a table in proportion to a = (theta + d * (others + t)) * base and joins one in
    proportion to k - d * t; the weight is the product of a + k - d * t over all steps, which a path's true probability
    has and its proposal has not.
    """
    t, log_w = np.ones(len(n)), np.zeros(len(n))
    falling = -n
    for k in range(1, ONE_BY_ONE):
        m = int(np.searchsorted(falling, -k, "left"))  # dishes with more than k customers
        if not m:
            break
        a, join = (theta + d * (others[:m] + t[:m])) * base[:m], k - d * t[:m]
        log_w[:m] += np.log(a + join)
        t[:m] += rng.random(m) * (a + join) < a
    m = int(np.searchsorted(falling, -ONE_BY_ONE, "left"))
    at, live = np.full(m, ONE_BY_ONE), np.arange(m)
    while len(live):
        k = np.minimum(np.maximum(1, at[live] // GROUP_SHARE), n[live].astype(np.int64) - at[live])
        middle = at[live] + (k - 1) / 2
        more = np.zeros(len(live))
        for _ in range(2):  # the group's chance of a new table, at the tables expected half way
            a = (theta + d * (others[live] + t[live] + more)) * base[live]
            chance = a / (a + np.maximum(middle - d * (t[live] + more), 1 - d))
            more = k * chance / 2
        new = rng.binomial(k, chance)
        a = (theta + d * (others[live] + t[live] + new / 2)) * base[live]
        log_w[live] += k * np.log(a + np.maximum(middle - d * (t[live] + new / 2), 1 - d))
        t[live] += new
        at[live] += k
        live = live[at[live] < n[live]]
    return t, log_w


def log_stirling(n: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """Logs of the generalised Stirling numbers S(n, t): the ways to seat n customers at t tables, weighted, up to a
    factor that depends on n alone.

    S(n, t) is n! / t! times the coefficient of z**n in ((1 - (1 - z)**d) / d)**t, an integral around 0. With z = exp(p)
    the path is a parabola around the cut p >= 0 or, where the saddle point is far from it, a line through that point.
    """
    out = np.empty(len(n))
    for at in range(0, len(n), 4096):
        own = slice(at, at + 4096)
        with np.errstate(all="ignore"):  # at the ends of the search
            out[own] = _log_stirling(n[own].astype(np.float64), t[own].astype(np.float64), d)
    return out


def _log_stirling(n, t, d):
    # The saddle point: t d r (1 - r)**(d - 1) = n (1 - (1 - r)**d), with v = -log(r).
    lo, hi = np.full(len(n), -80.0), np.full(len(n), 6.0)
    for _ in range(50):
        mid = (lo + hi) / 2
        e = -np.expm1(-np.exp(mid))
        mean = t * d * (1 - e) * e ** (d - 1) / -np.expm1(d * np.log(e))
        lo, hi = np.where(mean > n, mid, lo), np.where(mean > n, hi, mid)
    v = np.exp(hi)
    e = -np.expm1(-v)
    r, u = 1 - e, e ** d
    g = d * r * e ** (d - 1) / (1 - u)  # mean of one table's customers
    spread = t * np.maximum(g * (1 + r * (1 - d) / e - g), 1e-300)  # variance of all tables' customers
    line = v > 0.3
    v = np.where(line, v, np.maximum(v, 1.0 / n))
    y = (np.arange(65) / 64.0)[None, :]  # the other half of the path is its mirror image
    wide = np.where(line, np.minimum(np.pi, 12 / np.sqrt(spread)), np.minimum(8.0, np.sqrt(45 / (n * v)) + 1.0))
    wide = np.where(~line & (n * v * (1 - d) > 200), np.minimum(wide, 7 / (v * np.sqrt(spread))), wide)
    y = y * wide[:, None]
    p = np.where(line[:, None], -v[:, None] + 1j * y, -v[:, None] * (1 - 1j * y) ** 2)
    slope = np.where(line[:, None], 1.0 + 0j, 2 * v[:, None] * (1 - 1j * y))
    f = t[:, None] * np.log(-np.expm1(d * np.log(-np.expm1(p)))) - n[:, None] * p
    top = f.real.max(1)
    ends = np.where((y == 0) | (y >= wide[:, None]), 0.5, 1.0)
    total = (np.exp(f - top[:, None]) * slope * ends).real.sum(1) * wide
    found = top + np.log(np.maximum(total, 1e-300)) - _log_gamma(t + 1) - t * np.log(d)
    # Almost all customers alone: S(n, n) = 1, S(n, n - 1) = (1 - d) n (n - 1) / 2; the factor left out is n! / (64 pi).
    left_out = _log_gamma(n + 1) - np.log(64 * np.pi)
    found = np.where(t == n, -left_out, found)
    return np.where(t == n - 1, np.log((1 - d) * n * np.maximum(n - 1, 1) / 2) - left_out, found)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    shift = np.log(x) + np.log(x + 1) + np.log(x + 2) + np.log(x + 3) + np.log(x + 4) + np.log(x + 5) + np.log(x + 6)
    z = x + 7
    return ((z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5)
            - shift)


def _small_stirling(d: float) -> np.ndarray:
    """Logs of S(n, t) for all n up to SMALL, by their recursion."""
    out = np.full((SMALL + 1, SMALL + 2), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(1, SMALL + 1)
    for n in range(1, SMALL):
        with np.errstate(divide="ignore"):
            out[n + 1, 1:-1] = np.logaddexp(out[n, :-2], np.log(np.maximum(n - d * t, 0)) + out[n, 1:-1])
    return out


class _Large:
    """Tables of large dishes: a Metropolis chain whose proposals lie around the most likely number of tables."""

    def __init__(self, n: np.ndarray, t: np.ndarray, d: float):
        self.n, self.t, self.d = n, t, d
        self.log_s = log_stirling(n, t, d)

    def step(self, c: np.ndarray, steps: int, rng):
        """Redraws t from S(n, t) * c**t."""
        n, d = self.n, self.d
        lo, hi = np.full(len(n), -80.0), np.full(len(n), 0.0)  # n = c r (1 - r)**(d - 1), by log(1 - r)
        for _ in range(50):
            mid = (lo + hi) / 2
            more = c * -np.expm1(mid) * np.exp((d - 1) * mid) > n
            lo, hi = np.where(more, mid, lo), np.where(more, hi, mid)
        e = np.exp(hi)
        mean = c * (1 - e ** d) / d
        var = mean - n / (1 + (1 - e) * (1 - d) / e)
        mean = np.clip(mean, 1, n)
        scale = 0.65 * np.sqrt(np.clip(var, 0.05, n)) + 0.2

        def weight(t, log_s):
            a, h = (t - mean) / scale, 0.5 / scale
            chance = np.log(np.sinh(h)) - np.logaddexp(np.logaddexp(a, -a), np.log(2 * np.cosh(h)))
            return log_s + t * np.log(c) - chance

        now = weight(self.t, self.log_s)
        for _ in range(steps):
            x = rng.random(len(n))
            new = np.rint(mean + scale * np.log((x + 1e-300) / (1 - x)))
            inside = (new >= 1) & (new <= n)
            new = np.where(inside, new, self.t)
            log_s = log_stirling(n, new, d)
            then = weight(new, log_s)
            take = inside & (np.log(rng.random(len(n))) < then - now)
            self.t, self.log_s, now = (np.where(take, a, b) for a, b in ((new, self.t), (log_s, self.log_s), (then, now)))


def sample_tables(bin_: Bin, base: np.ndarray, cut_tables: np.ndarray, d: float, theta: float, rng,
                  samples: int, start: np.ndarray | None = None) -> list[np.ndarray]:
    """Tables of every pair in consecutive samples, given the parent's probabilities (by token).

    Gibbs sampling: a restaurant of T tables draws x from Gamma(theta / d + T, 1), given which its dishes are independent
    and have t tables in proportion to S(n, t) * (d * base * x)**t. Dishes of up to SMALL customers are drawn from that
    distribution; larger ones make STEPS Metropolis steps from the tables they have. The chain goes on from `start`
    (the tables of dishes with two customers or more), or begins with one seating path. Of a cut restaurant the tables
    in other rooms are held at their last sum.
    """
    t = (bin_.n > 0).astype(np.float64)
    many = np.flatnonzero(bin_.n > 1)
    away = np.zeros(len(bin_.contexts))
    if start is not None:
        t[bin_.n > 1] = start
    away[bin_.is_cut] = cut_tables - bin_.per_context(t)[bin_.is_cut]
    many = many[np.argsort(-bin_.n[many], kind="stable")]
    n, p, context = bin_.n[many].astype(np.float64), base[bin_.token[many]], bin_.context[many]
    if start is None:
        t[many], _ = _seat(n, (bin_.per_context(t) + away)[context] - t[many], p, d, theta, rng)
    split = int(np.searchsorted(-n, -SMALL, "left"))
    large = _Large(n[:split], t[many[:split]], d)
    edges = np.searchsorted(-n, -np.arange(SMALL + 1.0), "left"), np.searchsorted(-n, -np.arange(SMALL + 1.0), "right")
    log_s = _small_stirling(d)
    found = []
    for sweep in range(WARM + samples):
        x = rng.standard_gamma(theta / d + bin_.per_context(t) + away)
        c = np.maximum(d * p * x[context], 1e-300)
        if split:
            large.step(c[:split], STEPS, rng)
            t[many[:split]] = large.t
        for k in range(2, SMALL + 1):
            for lo in range(edges[0][k], edges[1][k], 1 << 16):
                own = slice(lo, min(lo + (1 << 16), edges[1][k]))
                w = log_s[k, 1:k + 1] + np.log(c[own])[:, None] * np.arange(1, k + 1)
                w = np.cumsum(np.exp(w - w.max(1, keepdims=True)), axis=1)
                t[many[own]] = 1 + (w[:, :-1] <= (rng.random(len(w)) * w[:, -1])[:, None]).sum(1)
        if sweep >= WARM:
            found.append(t.copy())
    return found


def discount(ones: float, twos: float) -> float:
    """The usual estimate from the numbers of things seen once and twice, kept inside (0, 1)."""
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones + twos else 0.5


def root_probability(tables: np.ndarray, total: float, kinds: float, d: float) -> np.ndarray:
    """The parent's probability of words with so many tables; 0 tables: of all words never seen together."""
    return np.where(tables > 0, np.maximum(tables - d, 1e-9), THETA_ROOT + d * kinds) / (THETA_ROOT + total)


# ---- rounds -----------------------------------------------------------------------------------------------------

_MESSAGE = pa.schema([("bin", pa.int32()), ("shard", pa.int32()), ("blob", pa.binary())])
_MESSAGE_DDL = "bin int, shard int, blob binary"


def _send(bin_no: int, keys: np.ndarray, values: np.ndarray, bins: int) -> pa.Table:
    shard = ((keys >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int32)
    edges = np.searchsorted(shard, np.arange(bins + 1)) if bins < 1 << 20 else np.append(
        np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
    rows = [(int(shard[lo]), pack(_deltas(keys[lo:hi]), *values[lo:hi].T)) for lo, hi in zip(edges[:-1], edges[1:]) if hi > lo]
    return pa.table([pa.array([bin_no] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int32()),
                     pa.array([r[1] for r in rows], pa.binary())], schema=_MESSAGE)


def _sum_keys(messages: pa.Table) -> pa.Table:
    """Sums by key, returned to each bin in the order it sent them, with a mark for the one bin that owns a key.

    A bin's message to itself (shard below 0) comes back as it is.
    """
    if messages["shard"][0].as_py() < 0:
        return messages
    parts = [unpack(b.as_buffer()) for b in messages["blob"]]
    who = messages["bin"].to_numpy()
    parts = [parts[i] for i in np.argsort(who)]
    who = np.sort(who)
    sizes = [len(p[0]) for p in parts]
    keys, first, of = np.unique(np.concatenate([np.cumsum(p[0].astype(np.uint64)) for p in parts]), return_index=True,
                                return_inverse=True)
    columns = [np.bincount(of, weights=np.concatenate(c), minlength=len(keys)).astype(np.int64)[of]
               for c in zip(*(p[1:] for p in parts))]
    owner = np.zeros(len(of), np.int64)
    owner[first] = 1
    cuts = np.cumsum(sizes)[:-1]
    back = [pack(*x) for x in zip(*(np.split(c, cuts) for c in (*columns, owner)))]
    shard = messages["shard"][0].as_py()
    return pa.table([pa.array(who, pa.int32()), pa.array([shard] * len(who), pa.int32()), pa.array(back, pa.binary())],
                    schema=_MESSAGE)


def _received(table: pa.Table, step: int) -> np.ndarray:
    """The answers of one round in the order of the keys; the last column is the owner's mark."""
    table = table.filter(pc.and_(pc.equal(table["step"], step), pc.greater_equal(table["shard"], 0))).sort_by("shard")
    parts = [np.stack([c.astype(np.int64) for c in unpack(b.as_buffer())], 1) for b in table["blob"]]
    return np.concatenate(parts)


def _kept(table: pa.Table, step: int) -> list[np.ndarray]:
    """The samples that a bin sent itself in a round: tables of the pairs with two customers or more."""
    own = table.filter(pc.and_(pc.equal(table["step"], step), pc.less(table["shard"], 0)))
    return unpack(own["blob"][0].as_buffer())


def _parent(sums: np.ndarray, samples: int) -> tuple[float, float]:
    """Kinds and discount of the parent, from what follows a round's samples: the same in seating and in scoring."""
    kinds, ones, twos = sums[samples:samples + 3]
    return float(kinds), discount(ones, twos)


def _levels(bin_: Bin, answers: np.ndarray):
    """After round 0: customers by token, customers and kinds by context, discount, and totals."""
    token, ctx, total = bin_.split(answers)
    seen = bin_.n > 0
    return (token, bin_.whole(bin_.per_context(bin_.n), ctx[:, 0]), ctx[:, 1], discount(total[2], total[3]), total,
            bin_.whole(bin_.per_context(seen), ctx[:, 1]))


class Model:
    """The functions of the rounds, as they run on one bin."""

    def __init__(self, bins: int, cut: np.ndarray, samples: int, burn_in: int, seed: int):
        self.bins, self.cut, self.samples, self.burn_in, self.seed = bins, cut, samples, burn_in, seed

    def _count(self, blobs: pa.Table) -> pa.Table:
        b = Bin(blobs["blob"], self.cut)
        seen = b.n > 0
        zero = np.zeros(len(b.tokens)), np.zeros(len(b.contexts))
        v = b.message([b.per_token(b.n), b.per_token(seen), zero[0], zero[0]],
                      [b.per_context(b.n), b.per_context(seen), zero[1], zero[1]],
                      [b.n.sum(), seen.sum(), (b.n == 1).sum(), (b.n == 2).sum()])
        return _send(blobs["bin"][0].as_py(), b.keys, v, self.bins)

    def count(self):
        """Round 0: customers and kinds."""
        return lambda blobs: self._count(blobs)

    def score(self):
        """Each document's share of a bin: tokens, known tokens, sums of log10 of both models."""
        return lambda key, blobs, answers: self._score(blobs, answers)

    def _draws(self, b: Bin, bin_no: int, step: int, answers: pa.Table) -> list[np.ndarray]:
        """The samples of a round given the tables after the round before (in round 1: one for each kind)."""
        first = _received(answers, 0)
        token, _, kinds_cut, d, total, _ = _levels(b, first)
        if step == 1:
            # Kinds and discount of the parent are counted in this round; it only sets the chain going.
            tables, all_tables, cut_tables, kinds, d_root = token[:, 1], total[1], kinds_cut, 0.0, 0.5
        else:
            t, ctx, sums = b.split(_received(answers, step - 1))
            tables, all_tables, cut_tables = t[:, 0], sums[0], ctx[:, 0]
            kinds, d_root = _parent(sums, 1)  # rounds before the last one draw one sample
        base = root_probability(tables.astype(float), float(all_tables), kinds, d_root)
        rng = np.random.default_rng([self.seed, step, bin_no])
        start = None if step == 1 else _kept(answers, step - 1)[-1].astype(np.float64)
        return sample_tables(b, base, cut_tables, d, THETA, rng, self.samples if step > self.burn_in else 1, start)

    def seat(self, step: int):
        """Round `step`: tables by word and by cut restaurant, and from the owners the kinds of words."""
        def run(key, blobs: pa.Table, answers: pa.Table) -> pa.Table:
            if not blobs.num_rows:
                return _MESSAGE.empty_table()
            b, bin_no = Bin(blobs["blob"], self.cut), blobs["bin"][0].as_py()
            draws = self._draws(b, bin_no, step, answers)
            first = _received(answers, 0)
            token, _, _ = b.split(first)
            mine = token[:, 4] == 1
            known = [(mine & (token[:, 0] > 0)).sum(), (mine & (token[:, 1] == 1)).sum(), (mine & (token[:, 1] == 2)).sum()]
            zero = [np.zeros(len(b.tokens))] * 3, [np.zeros(len(b.contexts))] * 3
            v = b.message([*(b.per_token(t) for t in draws), *zero[0]], [*(b.per_context(t) for t in draws), *zero[1]],
                          [*(t.sum() for t in draws), *known])
            sent = _send(bin_no, b.keys, v, self.bins)
            # The samples themselves go to the bin's next round.
            kept = pack(*(t[b.n > 1] for t in draws))
            own = pa.table([pa.array([bin_no], pa.int32()), pa.array([-1 - bin_no], pa.int32()), pa.array([kept], pa.binary())],
                           schema=_MESSAGE)
            return pa.concat_tables([sent, own])

        return run

    def _score(self, blobs: pa.Table, answers: pa.Table) -> pa.Table:
        if not blobs.num_rows:
            return _SHARE.empty_table()
        b, last = Bin(blobs["blob"], self.cut, entries=True), self.burn_in + 1
        draws = []
        for many in _kept(answers, last):
            draws.append((b.n > 0).astype(np.float64))
            draws[-1][b.n > 1] = many
        token, n_context, _, d, total, _ = _levels(b, _received(answers, 0))
        t_all, ctx_all, sums = b.split(_received(answers, last))
        s = self.samples
        kinds, d_root = _parent(sums, s)
        p = np.zeros(len(b.n))
        for i, t in enumerate(draws):
            root = root_probability(t_all[:, i].astype(float), float(sums[i]), kinds, d_root)[b.token]
            tables = b.whole(b.per_context(t), ctx_all[:, i])[b.context]
            n_u = n_context[b.context]
            own = ((b.n - d * t) + (THETA + d * tables) * root) / (THETA + n_u)
            p += np.where(n_u > 0, own, root)
        score, known = -np.log10(p / s), token[:, 0][b.token]
        base = np.log10(known + 1.0)
        rows = []
        for first, docs, doc_id, null_id, doc_no, more, pair in b.parts:
            of, times = b.of[pair], more.astype(np.float64) + 1
            add = lambda x: np.bincount(doc_no, weights=times * x, minlength=len(docs))  # noqa: E731, B023
            rows.append((first, pack(docs, doc_id, null_id, add(np.ones(len(of))), add(known[of] > 0),
                                     np.rint(add(base[of]) * _UNIT), np.rint(add(score[of]) * _UNIT))))
        return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                         pa.array([int(total[0])] * len(rows), pa.int64()), pa.array([int(kinds)] * len(rows), pa.int64())],
                        schema=_SHARE)


def _documents(shares: pa.Table) -> pa.Table:
    """The sums over all bins for the documents of one chunk."""
    parts = [unpack(b.as_buffer()) for b in shares["blob"]]
    docs, of = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    doc_id, null = np.zeros(len(docs), np.int64), np.zeros(len(docs), bool)
    doc_id[of] = np.concatenate([np.cumsum(p[1].astype(np.uint64)) for p in parts]).view(np.int64)
    null[of] = np.concatenate([p[2] for p in parts]).astype(bool)
    n_tokens, n_known, base, score = (np.bincount(of, weights=np.concatenate([p[k] for p in parts])) for k in range(3, 7))
    n, v = shares["train_tokens"][0].as_py(), shares["kinds"][0].as_py()
    return pa.table([
        pa.array(doc_id, mask=null), pa.array(n_tokens.astype(np.int64)), pa.array(n_known.astype(np.int64)),
        pa.array(np.full(len(docs), n)), pa.array(base / _UNIT - n_tokens * np.log10(n + v + 1.0)),
        pa.array(-score / _UNIT)], names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


_SHARE = pa.schema([("chunk", pa.int64()), ("blob", pa.binary()), ("train_tokens", pa.int64()), ("kinds", pa.int64())])
_SHARE_DDL = "chunk long, blob binary, train_tokens long, kinds long"


def held_out(ident: Column) -> Column:
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = 3, burn_in: int = 1,
                seed: int = 11) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Learns from the rows that `held_out` does not mark and scores all of them. score is the log10 probability of the
    text's words and its end under the mean of the samples' predictive probabilities; words never seen in training
    share one outcome. perplexity is 10 ** (-score / n_tokens).

    A null text counts as empty: it has its end alone. A null identifier is never held out. Rows that agree in
    everything are rows of their own. Other columns are not read; no rows give no rows. Without training rows N and V
    are 0 and every token is unknown. `docs` should read the same rows in the same order each time (a table does).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    seen = (rows.mapInArrow(_frequent, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
            .where(f"key IS NULL OR n >= {ROOM_TOKENS}").collect())  # FREQUENT keys at the most
    tokens = sum(r["n"] for r in seen if r["key"] is None)
    cut = sorted((np.uint64(r["key"] & (2**64 - 1)), r["n"]) for r in seen if r["key"] is not None)
    rooms = np.array([-(-n // ROOM_TOKENS) for _, n in cut], np.uint64)
    cut = np.array([k for k, _ in cut], np.uint64)
    bins = max(1, -(-tokens // BIN_TOKENS))
    model = Model(bins, cut, samples, burn_in, seed)

    blobs = rows.withColumn("train", ~held_out(F.col("doc_id"))).mapInArrow(_chunks(bins, cut, rooms), "bin int, blob binary")
    by_bin = blobs.groupBy("bin")

    def summed(messages: DataFrame, step: int) -> DataFrame:
        return messages.groupBy("shard").applyInArrow(_sum_keys, _MESSAGE_DDL).withColumn("step", F.lit(step))

    answers = summed(by_bin.applyInArrow(model.count(), _MESSAGE_DDL), 0)
    for step in range(1, burn_in + 2):
        messages = by_bin.cogroup(answers.groupBy("bin")).applyInArrow(model.seat(step), _MESSAGE_DDL)
        answers = answers.unionByName(summed(messages, step))
    shares = by_bin.cogroup(answers.groupBy("bin")).applyInArrow(model.score(), _SHARE_DDL)
    found = shares.groupBy("chunk").applyInArrow(
        _documents, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
