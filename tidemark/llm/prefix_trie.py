"""Prefix trie of rebuilt conversations from composable fingerprints of their turns."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import grouped, text_of, written
from .text import mix64

#: What counts as a word of a turn.
WORD = r"[^\x20\x09-\x0D]+"
#: Members' identifiers that one row holds while the members of a node are joined.
CHUNK = 4096

_SCANNED = "conv long, part int, i long, h1 long, h2 long, f1 long, f2 long, w long, words long, edge boolean"
_CARRY = "part int, conv long, n0 long, g1 long, g2 long, w0 long"
_TURNS = "conv long, i long, h1 long, h2 long, f1 long, f2 long, w long, words long"
_ROWS = "conv long, depth long, h1 long, h2 long, f1 long, f2 long, w long, words long, is_end boolean, w_all long"


class Monoid:
    """Sequences of turns as (length, sum of the turns' values times powers of a base), modulo 2**64, for two bases.

    (n, f) followed by (m, g) is (n + m, f + base**n * g). The bases are odd, so a known beginning can be taken off.
    """

    def __init__(self, seed: int):
        drawn = mix64(np.arange(1, 5, dtype=np.uint64) + np.uint64(4 * seed))
        self.salts = drawn[:2]
        self.bases = [int(b) // 8 * 8 + 5 for b in drawn[2:]]

    def value(self, k: int, turn: np.ndarray) -> np.ndarray:
        """The turn hashes of column k as values of the monoid."""
        return mix64(turn.view(np.uint64) ^ self.salts[k])

    def power(self, k: int, n: np.ndarray) -> np.ndarray:
        """base**n for whole arrays; n may be negative."""
        base = self.bases[k]
        out = np.ones(len(n), np.uint64)
        for sign in (1, -1):
            square, left = pow(base, sign, 2**64), np.maximum(sign * n, 0)
            while left.any():
                out = np.where(left & 1, out * np.uint64(square), out)
                square, left = square * square % 2**64, left >> 1
        return out

    def then(self, k: int, n: np.ndarray, f: np.ndarray, g: np.ndarray) -> np.ndarray:
        """The sum for (n, f) followed by something with the sum g."""
        return f + self.power(k, n) * g


def _longs(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64, copy=False) for n in names]


def _unsigned(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [x.view(np.uint64) for x in _longs(batch, *names)]


def _scan(monoid: Monoid):
    """Running products inside a sorted partition; `edge` marks the last rows of its first and its last conversation."""

    def run(batches):
        part = TaskContext.get().partitionId()
        now, n, f, w = None, 0, [np.uint64(0)] * 2, 0
        in_first, held = True, None

        def out(cols, edge):
            rows = len(cols[0])
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0]), pa.array(np.full(rows, part, np.int32)), *map(pa.array, cols[1:]), pa.array(edge)],
                ["conv", "part", "i", "h1", "h2", "f1", "f2", "w", "words", "edge"])

        for batch in batches:
            if not batch.num_rows:
                continue
            conv, h1, h2, words = _longs(batch, "conv", "h1", "h2", "words")
            size = len(conv)
            new = np.ones(size, bool)
            new[1:] = conv[1:] != conv[:-1]
            new[0] = conv[0] != now
            starts = np.flatnonzero(new)
            begin = np.maximum.accumulate(np.where(new, np.arange(size), -1))  # -1: goes on from the batch before
            place = np.where(begin < 0, n + np.arange(size), np.arange(size) - begin)
            at = np.maximum(begin, 0)
            fs = []
            for k, h in enumerate((h1, h2)):
                total = np.zeros(size + 1, np.uint64)
                np.cumsum(monoid.value(k, h) * monoid.power(k, place), out=total[1:])
                fs.append(total[1:] - total[at] + np.where(begin < 0, f[k], np.uint64(0)))
            total = np.concatenate([[0], np.cumsum(words)])
            w_all = total[1:] - total[at] + np.where(begin < 0, w, 0)
            # The partition's first conversation ends where a second one starts.
            stop = size if not in_first else next((int(s) for s in starts if s or now is not None), size)
            cols = [conv, place + 1, h1, h2, fs[0].view(np.int64), fs[1].view(np.int64), w_all, words]
            if held is not None:
                yield out(held, np.array([in_first and stop == 0]))
            edge = np.zeros(size, bool)
            if in_first and 0 < stop < size:
                edge[stop - 1] = True
            in_first = in_first and stop == size
            if size > 1:
                yield out([c[:-1] for c in cols], edge[:-1])
            held = [c[-1:] for c in cols]
            now, n, f, w = conv[-1], int(place[-1]) + 1, [x[-1] for x in fs], int(w_all[-1])
        if held is not None:
            yield out(held, np.array([True]))

    return run


def _carry(monoid: Monoid):
    """What precedes a conversation's rows in a partition, from its edges in the partitions before."""

    def run(table: pa.Table) -> pa.Table:
        t = table.sort_by("part")
        part, conv, size, w = (t[c].to_numpy() for c in ("part", "conv", "i", "w"))
        f = [t[c].to_numpy().view(np.uint64) for c in ("f1", "f2")]
        before = np.cumsum(size) - size
        g = []
        for k in (0, 1):
            terms = f[k] * monoid.power(k, before)
            g.append((np.cumsum(terms, dtype=np.uint64) - terms).view(np.int64))
        return pa.table({"part": part, "conv": conv, "n0": before, "g1": g[0], "g2": g[1], "w0": np.cumsum(w) - w})

    return run


def _joined_on(monoid: Monoid):
    """Rows of a partition behind what precedes them."""

    def run(batches):
        for b in batches:
            conv, i, h1, h2, w, words, n0, w0 = _longs(b, "conv", "i", "h1", "h2", "w", "words", "n0", "w0")
            f = [monoid.then(k, n0, g, x) for k, (x, g) in enumerate(zip(_unsigned(b, "f1", "f2"), _unsigned(b, "g1", "g2")))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (conv, i + n0, h1, h2, f[0].view(np.int64), f[1].view(np.int64), w + w0, words)],
                ["conv", "i", "h1", "h2", "f1", "f2", "w", "words"])

    return run


def _rebuilt(monoid: Monoid):
    """Own turns behind the base's head: head times (own beginning taken off own product)."""

    def run(batches):
        for b in batches:
            conv, i, h1, h2, w, words, h, hp, n, wb, wc, wn = _longs(
                b, "conv", "i", "h1", "h2", "w", "words", "h", "hp", "n", "wb", "wc", "w_all")
            f = []
            for k, (x, head, own) in enumerate(zip(_unsigned(b, "f1", "f2"), _unsigned(b, "b1", "b2"),
                                                   _unsigned(b, "c1", "c2"))):
                f.append((head + monoid.power(k, hp - h) * (x - own)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (conv, hp + i - h, h1, h2, *f, wb + w - wc, words, i == n, wn)],
                ["conv", "depth", "h1", "h2", "f1", "f2", "w", "words", "is_end", "w_all"])

    return run


def _parents(monoid: Monoid):
    """The parent's fingerprint: the node's without its last turn."""

    def run(batches):
        for b in batches:
            depth, h1, h2 = _longs(b, "depth", "h1", "h2")
            for k, (f, h) in enumerate(zip(_unsigned(b, "f1", "f2"), (h1, h2))):
                p = np.where(depth > 0, f - monoid.value(k, h) * monoid.power(k, np.maximum(depth - 1, 0)), f)
                b = b.append_column(f"p{k + 1}", pa.array(p.view(np.int64)))
            yield b

    return run


_KEY = ["depth", "f1", "f2"]


def _chunks(batches):
    """Sorted members of each node, joined to texts of at most CHUNK identifiers."""
    for g in grouped(batches, _KEY):
        conv = g["conv"].to_pylist()
        for at in range(0, len(conv), CHUNK):
            yield pa.RecordBatch.from_pylist([{**{c: g[c][0].as_py() for c in _KEY}, "lead": conv[at],
                                               "ids": ",".join(map(str, conv[at:at + CHUNK]))}])


def _digests(batches):
    """One digest a node over its chunks in order; only the digest's state is held."""
    now, digest = None, None

    def out():
        return pa.RecordBatch.from_pylist([{**dict(zip(_KEY, now)), "ends_sha256": digest.hexdigest()}])

    for batch in batches:
        for d, f1, f2, ids in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "ids"))):
            if (d, f1, f2) != now:
                if now is not None:
                    yield out()
                now, digest = (d, f1, f2), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if now is not None:
        yield out()


def base_of(conv: Column) -> Column:
    """The conversation whose head a conversation takes over."""
    return conv - conv % 20


def head_length(conv: Column) -> Column:
    """How many of the base's turns stand before a conversation's own: 0 to 3."""
    return F.crc32(conv.cast("string")) % 4


def _head(heads: Column, place: Column, field: str) -> Column:
    """A product of the first `place` turns (0 to 3)."""
    return F.when(place > 0, F.get(heads, (place - 1).cast("int"))[field]).otherwise(F.lit(0))


def stored_turns(rows: DataFrame, monoid: Monoid, seed: int) -> DataFrame:
    """(conv, i, h1, h2, f1, f2, w, words): turn i of its conversation by hash, and products over turns 1 to i.

    Rows are range-partitioned by (conv, turn, role, text), so a long conversation lies in many partitions; each gives
    running products, and at most two rows of each carry them on to the next.
    """
    keys = ["conv", "turn", "role"]
    ties = written(rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("conv").alias("tc"), F.col("turn").alias("tt"), F.col("role").alias("tr")), "ties")
    # Texts travel for order only where turn and role agree; the list of those is a file, so its size is known.
    same = (F.col("conv") == F.col("tc")) & F.col("turn").eqNullSafe(F.col("tt")) & (F.col("role") == F.col("tr"))
    slim = rows.join(ties, same, "left").select(
        *keys, F.when(F.col("tc").isNotNull(), F.col("text")).alias("tie"), *_turn_hashes(seed),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie")]
    scanned = written(slim.repartitionByRange(*order).sortWithinPartitions(*order)
                      .select("conv", "h1", "h2", "words").mapInArrow(_scan(monoid), _SCANNED), "scanned")
    carried = (scanned.where("edge").groupBy("conv").applyInArrow(_carry(monoid), _CARRY).where("n0 > 0"))
    # At most one row for each partition of the sort.
    behind = scanned.join(F.broadcast(carried), ["part", "conv"], "left").fillna(0, ["n0", "g1", "g2", "w0"])
    return written(behind.mapInArrow(_joined_on(monoid), _TURNS), "turns")


def _turn_hashes(seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed + k), "role", "text").alias(f"h{k}") for k in (1, 2)]


def _different_texts(rows: DataFrame, seed: int) -> bool:
    """Whether some turns have equal hashes and different roles or texts."""
    texts = rows.select(*_turn_hashes(seed), "role", "text").distinct()
    return not texts.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def rebuilt_prefixes(turns: DataFrame, monoid: Monoid, base=base_of, head=head_length) -> DataFrame:
    """One row for each conversation and depth from 0: its fingerprint, last turn's hash, words so far; no texts."""
    at = F.struct("i", "f1", "f2", "w", "h1", "h2", "words")
    convs = written(turns.groupBy("conv").agg(
        F.max("i").alias("n"), F.max("w").alias("w_own"),
        F.sort_array(F.collect_list(F.when(F.col("i") <= 3, at))).alias("heads")), "conversations")
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("nb"), F.col("heads").alias("bh"))
    info = (convs.withColumn("h", head(F.col("conv"))).withColumn("base", base(F.col("conv")))
            .join(bases.hint("merge"), "base", "left")
            .withColumn("hp", F.least("h", F.coalesce("nb", F.lit(0)))))
    own = F.least("h", "n")
    info = info.withColumns(
        {name: _head(F.col("bh"), F.col("hp"), field) for name, field in (("b1", "f1"), ("b2", "f2"), ("wb", "w"))}
        | {name: _head(F.col("heads"), own, field) for name, field in (("c1", "f1"), ("c2", "f2"), ("wc", "w"))})
    info = written(info.withColumn("w_all", F.col("wb") + F.col("w_own") - F.col("wc")), "rebuilding")
    tails = (turns.join(info.where("n > h").drop("heads", "bh", "base", "nb", "w_own").hint("merge"), "conv")
             .where("i > h").mapInArrow(_rebuilt(monoid), _ROWS))
    zero = F.lit(0).cast("long")
    roots = F.array(F.struct(zero.alias("i"), zero.alias("f1"), zero.alias("f2"), zero.alias("w"), zero.alias("h1"),
                             zero.alias("h2"), zero.alias("words")))
    taken = F.concat(roots, F.filter(F.coalesce("bh", F.array()), lambda x: x["i"] <= F.col("hp")))
    heads = (info.withColumn("t", F.explode(taken)).select(
        "conv", F.col("t.i").alias("depth"), *[F.col(f"t.{c}").alias(c) for c in ("h1", "h2", "f1", "f2", "w", "words")],
        ((F.col("t.i") == F.col("hp")) & (F.col("n") <= F.col("h"))).alias("is_end"), "w_all"))
    return written(heads.unionByName(tails), "prefixes")


def _digest_of_ends(prefixes: DataFrame) -> DataFrame:
    ends = prefixes.where("is_end").select(*_KEY, "conv")
    chunks = (ends.repartitionByRange(*_KEY, "conv").sortWithinPartitions(*_KEY, "conv")
              .mapInArrow(_chunks, "depth long, f1 long, f2 long, lead long, ids string"))
    return (chunks.repartition(*_KEY).sortWithinPartitions(*_KEY, "lead").select(*_KEY, "ids")
            .mapInArrow(_digests, "depth long, f1 long, f2 long, ends_sha256 string"))


def prefix_trie(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", base=base_of, head=head_length) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations, the textless root included.

    A rebuilt conversation is the first `head` turns (0 to 3) of the conversation `base` (all if it has fewer, none if
    it is absent) and its own turns behind its first `head`. A node is a distinct sequence of the first `depth` rebuilt
    turns (role, text); members are the conversations that start with it. Returns conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Method: a stored conversation has running products of its turns' hashes; a rebuilt one's are the base's head times
    its own product without the beginning, so no rebuilt text ever exists. Rows with equal depth and product form a
    node. They are verified: every member refers to a stored turn with the node's last turn hash, and stored turns with
    equal hashes have equal roles and texts, compared in full. As the parent's product follows from the node's and the
    last turn, verified nodes have one parent, so by induction members agree from the first turn. Where any check
    fails, everything is done anew with other hashes.

    Sums over subtrees need no walk: a conversation is a node's smallest member from some depth on to its end, so each
    of its prefixes saves the words up to that depth, and a leaf counts for the one conversation that is its smallest.

    Turns are ordered by (turn, role, text), null turns first; repeated rows are turns of their own; null roles and
    texts are empty. Rows without a conv_id belong to no conversation. Texts may be of any length and are only hashed,
    counted and compared. No rows give no nodes, not even a root. Other columns are not read.
    """
    rows = rows.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), text_of(role_col).alias("role"),
        text_of(text_col).alias("text"))
    seed = 0
    while True:
        monoid = Monoid(seed)
        if not _different_texts(rows, seed):
            prefixes = rebuilt_prefixes(stored_turns(rows, monoid, seed), monoid, base, head)
            groups = written(prefixes.groupBy(*_KEY).agg(
                F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("h1").alias("h1"),
                F.min("h2").alias("h2"), F.max("h1").alias("top1"), F.max("h2").alias("top2"), F.max("words").alias("words"),
                F.max("w").alias("w")), "groups")
            if groups.where("h1 <> top1 OR h2 <> top2").isEmpty():
                break
        seed += 1
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in groups.schema)
    nodes = written(groups.mapInArrow(_parents(monoid), f"{fields}, p1 long, p2 long"), "nodes")
    above = (F.col("depth") - 1).alias("depth")
    kids = nodes.where("depth > 0").groupBy(above, F.col("p1").alias("f1"), F.col("p2").alias("f2")).agg(
        F.count("*").alias("n_children"))
    nodes = written(nodes.join(kids, _KEY, "left").fillna(0, ["n_children"]), "trie")
    owners = nodes.groupBy(F.col("conv_id").alias("conv")).agg(
        F.min(F.struct("depth", (F.col("w") - F.col("words")).alias("w"))).alias("top"),
        F.max(F.struct("depth", "n_children")).alias("end"))
    owners = written(owners.select("conv", F.col("top.depth").alias("from_depth"), F.col("top.w").alias("from_w"),
                                   (F.col("end.n_children") == 0).alias("leaf")), "owners")
    each = prefixes.join(owners.hint("merge"), "conv", "left")
    shared = F.col("from_depth").isNull() | (F.col("depth") < F.col("from_depth"))
    saved = F.when(shared, F.coalesce("from_w", "w_all") - (F.col("w") - F.col("words"))).otherwise(F.lit(0))
    sums = each.groupBy(*_KEY).agg(F.sum(F.coalesce("leaf", F.lit(False)).cast("long")).alias("n_leaves"),
                                   F.sum(saved).alias("saved_tokens"))
    parent = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"),
                          F.col("conv_id").alias("parent_conv_id"))
    # A root's parent would be a node of depth -1, so it has none.
    found = (nodes.join(sums.hint("merge"), _KEY).join(parent.hint("merge"), ["depth", "p1", "p2"], "left")
             .join(_digest_of_ends(prefixes).hint("merge"), _KEY, "left"))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
