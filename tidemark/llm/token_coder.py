"""Token ids in compressed binary files: an adaptive context-mixing range coder over independent blocks.

A section's counts say where order 0 begins. From there every block learns for itself: shares of groups of ids, guesses
after one and two ids, and the weights that mix the three.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, text_of, written
from .text import slices, utf8

#: Ids of a block, blocks that are coded side by side, ids of a section (the unit a task holds), sections of a file. A
#: section has at most about 20 bytes for each id, so a file stays far below the 2 GB that its reader takes.
BLOCK_IDS, LANES, SECTION_IDS, FILE_SECTIONS = 4096, 1024, 4_000_000, 4
#: No section is longer, so that its blocks are coded at once; a longer document is a section of its own.
SECTION_MOST = BLOCK_IDS * LANES
#: Slots of the tables that predict the id after one and after two ids; both start empty in every block.
SLOTS = 4096
#: Order 0: GROUPS groups of ids, whose shares (BITS bits, none narrower than LEAST) move by 1/16 to each id's group, and
#: fixed shares inside a group (INSIDE bits), from the section's counts.
GROUPS, BITS, LEAST, RATE, INSIDE = 16, 15, 24, 4, 14
#: Weights of the predictions, of SCALE in all; they move by 1/16 in WEIGHT steps. A context is both confidences and
#: whether the guesses agree.
SCALE, WEIGHT, CONTEXTS = 128, 4096, 32
_ORDER0 = BITS + INSIDE
_TOTAL_BITS = _ORDER0 + 7
#: The coder's range lies between 2**LOW and 2**TOP; it gives and takes 16 bits at a time.
TOP, LOW = 56, 40
#: Where groups begin to begin with; LEAST and all the rest as the width of groups that move on.
_START = (np.arange(GROUPS + 1) * ((1 << BITS) // GROUPS)).astype(np.uint16)
_PLACE = np.arange(1, GROUPS, dtype=np.int16)[:, None]
_LEASTS, _REST = _PLACE * np.int16(LEAST), np.int16((1 << BITS) - LEAST * GROUPS)
#: By the number of words that leave: how far bits move, and those that stay (a carry stays until a word leaves).
_SHIFT = np.array([0, 16, 32], np.uint64)
_STAY = np.array([(1 << TOP + 1) - 1, (1 << TOP) - 1, (1 << TOP) - 1], np.uint64)
_WIDTH = np.int64((2 << INSIDE) - 1)
_INSIDE = np.int64((1 << INSIDE) - 1)

MAGIC = b"TDMK"

#: Distinct pieces of text whose ids a task keeps; new ones that are tokenised at a time.
CACHED, JOINED = 350_000, 32
#: ASCII letters; ASCII white space, in the widest sense; last bytes of other white space in UTF-8, after these first bytes.
_LETTER = np.array([chr(i).isalpha() and i < 128 for i in range(256)])
_SPACE = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_TAIL = np.isin(np.arange(256), [0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F])
_LEAD = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])


class _Table:
    """A section's ids by rank, the most frequent first, in groups of like weight; order 0 begins with it in every block.

    `inside` and `width`: where an id's share begins in its group, and how wide it is, of 2**INSIDE.
    """

    def __init__(self, ids: np.ndarray, bounds: np.ndarray, width: np.ndarray):
        self.ids, self.bounds, self.width = ids, bounds, width.astype(np.int64)
        self.group = np.repeat(np.arange(GROUPS), np.diff(bounds))
        total = np.concatenate([[0], np.cumsum(self.width)])
        self.inside = total[:-1] - total[bounds[self.group]]
        self.packed = self.group << 2 * INSIDE + 1 | self.inside << INSIDE + 1 | self.width

    @classmethod
    def of(cls, ids: np.ndarray) -> _Table:
        counts = np.bincount(ids, minlength=1)
        found = np.flatnonzero(counts)
        found = found[np.argsort(-counts[found], kind="stable")]
        n = counts[found]
        # Half by count, half by number of ids, so that no group has more ids than its shares can hold.
        weight = np.cumsum(n / n.sum() + 1 / len(n)) / 2
        bounds = np.concatenate([[0], np.searchsorted(weight, np.arange(1, GROUPS) / GROUPS), [len(n)]])
        width = np.ones(len(n), np.int64)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b > a:
                room = (1 << INSIDE) - (b - a)
                ends = np.cumsum(n[a:b]) * room // n[a:b].sum()
                width[a:b] += np.diff(ends, prepend=0)
        return cls(found, bounds, width)

    def pack(self) -> bytes:
        body = zlib.compress(self.ids.astype("<u2").tobytes() + self.width.astype("<u2").tobytes(), 1)
        return struct.pack(f"<III{GROUPS + 1}I", len(self.ids), len(body), zlib.crc32(body), *self.bounds) + body

    @classmethod
    def unpack(cls, data: memoryview) -> tuple[_Table, int]:
        head = struct.calcsize(f"<III{GROUPS + 1}I")
        n, size, crc, *bounds = struct.unpack_from(f"<III{GROUPS + 1}I", data)
        body = bytes(data[head:head + size])
        if zlib.crc32(body) != crc:
            raise ValueError("damaged table of ids")
        both = np.frombuffer(zlib.decompress(body), "<u2").astype(np.int64)
        return cls(both[:n], np.array(bounds), both[n:]), head + size

    def by_share(self) -> np.ndarray:
        """The rank that holds each share of each group."""
        found = np.zeros((GROUPS, 1 << INSIDE), np.uint16)
        for g, (a, b) in enumerate(zip(self.bounds[:-1], self.bounds[1:])):
            if b > a:
                    found[g] = np.repeat(np.arange(a, b), self.width[a:b])
        return found.ravel()


class _Lanes:
    """Models of many blocks in step. An id's probability is a sum over three predictions by adaptive weights:

    weight 2 on the guess after the last two ids, weight 1 on that after the last one, the rest on order 0. Guesses are
    held with a confidence of 0 to 3; weights are learnt for each pair of confidences. Ids are ranks of the table.
    """

    def __init__(self, lanes: int, table: _Table):
        self.table, self.lanes = table, lanes
        self.shares = np.repeat(_START[:, None], lanes, axis=1)  # where groups begin, a row for each, and their end
        self.guess = np.zeros(2 * lanes * SLOTS, np.int32)  # 4 * rank + confidence, after one id and after two
        # To begin with, sure guesses weigh more. The weights of the guesses after one and two ids lie in 16 bits each.
        sure2, sure1 = np.arange(CONTEXTS) >> 3, np.arange(CONTEXTS) >> 1 & 3
        weights = (sure2 * WEIGHT // 5 << 16) + (3 - sure2) * sure1 * WEIGHT // 20
        self.weights = np.tile(weights.astype(np.int32), lanes)
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.lane = np.arange(lanes)
        self.slots, self.contexts = np.arange(2 * lanes).reshape(2, lanes) * SLOTS, self.lane * CONTEXTS
        self.range = np.full(lanes, 1 << TOP, np.uint64)

    def group_of(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the groups begin in each lane, and their shares."""
        at = group * self.lanes
        at += self.lane[:at.shape[-1]]
        flat = self.shares.ravel()
        low = flat.take(at, mode="clip")
        at += self.lanes
        share = flat.take(at, mode="clip")
        share -= low
        return low.astype(np.int64), share.astype(np.int64)

    def order0(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where order 0 puts ranks, how wide, of 2**(BITS + INSIDE), and their groups."""
        packed = self.table.packed.take(rank, mode="clip")
        group = packed >> (2 * INSIDE + 1)
        low, share = self.group_of(group)
        low <<= INSIDE
        low += share * (packed >> (INSIDE + 1) & _INSIDE)
        packed &= _WIDTH
        share *= packed
        return low, share, group

    def ids(self, n: int, wanted: np.ndarray | None) -> np.ndarray:
        """Codes the next rank of the first n lanes, the wanted one or that which the data hold."""
        last, before = self.last[:n], self.before[:n]
        slots = np.empty((2, n), np.int64)  # first rows: after one id; second rows: after two
        np.multiply(last, 40503, out=slots[0])
        np.multiply(before, 60493, out=slots[1])
        slots[1] += slots[0]
        slots >>= 4
        slots &= SLOTS - 1
        slots += self.slots[:, :n]
        held = self.guess.take(slots, mode="clip")
        sure, guess = held & 3, held >> 2
        context = sure[1] << 2
        context += sure[0]
        context <<= 1
        context += guess[0] == guess[1]
        context = context + self.contexts[:n]
        packed = self.weights.take(context, mode="clip")
        weight = np.empty((2, n), np.int32)
        np.bitwise_and(packed, 0xFFFF, out=weight[0])
        np.right_shift(packed, 16, out=weight[1])
        peak = weight * (SCALE - 4)
        peak >>= 12
        rest = (SCALE - peak[0] - peak[1]).astype(np.int64)
        step = self.range[:n] >> np.uint64(_TOTAL_BITS)
        wanted, group, low, width = self.place(step, guess, peak, rest, wanted)
        self.narrow(n, step, low.view(np.uint64), width.view(np.uint64))
        # Shares move to the group.
        rows = self.shares[1:GROUPS, :n].view(np.int16)
        move = group.astype(np.int16) - _PLACE
        move >>= 15
        move &= _REST
        move += _LEASTS
        move -= rows
        move >>= RATE
        rows += move
        # Weights move to the guess that was right, that after two ids first.
        now = wanted.astype(np.int32)
        right = (guess == now).astype(np.int32)
        better = right * WEIGHT
        better[0] -= better[0] & better[1]
        better -= weight
        better >>= 4
        weight += better
        packed = weight[1] << 16
        packed |= weight[0]
        self.weights[context] = packed
        # Guesses gain or lose confidence; those without any give way.
        moved = held + right
        moved += right
        moved -= 1
        held |= 3
        np.minimum(moved, held, out=moved)
        guess <<= 2
        now <<= 2
        moved = np.where(moved < guess, now, moved)
        self.guess[slots] = moved
        self.before[:n] = last
        self.last[:n] = wanted
        return wanted


class _Encoder(_Lanes):
    def __init__(self, lanes: int, most: int, table: _Table):
        super().__init__(lanes, table)
        self.low, self.step = np.zeros(lanes, np.uint64), 0
        # The low end at each step, and how many of its words leave then; two more steps at the end.
        self.base, self.leave = np.empty((most + 2, lanes), np.uint64), np.zeros((most + 2, lanes), np.uint8)

    def place(self, step, guess, peak, rest, wanted):
        low, width, group = self.order0(wanted)
        now = wanted.astype(np.int32)
        low *= rest
        width *= rest
        for part, where in ((low, guess < now), (width, guess == now)):
            peaks = peak * where
            peaks[0] += peaks[1]
            peaks = peaks[0].astype(np.int64)
            peaks <<= _ORDER0
            part += peaks
        return wanted, group, low, width

    def narrow(self, n, step, low, width):
        base, leave, span = self.base[self.step, :n], self.leave[self.step, :n], step * width
        np.multiply(step, low, out=base)
        base += self.low[:n]
        np.add((span < np.uint64(1 << LOW)).view(np.uint8), (span < np.uint64(1 << LOW - 16)).view(np.uint8), out=leave)
        shift = _SHIFT.take(leave, mode="clip")
        np.left_shift(base, shift, out=self.low[:n])
        self.low[:n] &= _STAY.take(leave, mode="clip")
        np.left_shift(span, shift, out=self.range[:n])
        self.step += 1

    def words(self) -> list[bytes]:
        self.base[-2], self.base[-1] = self.low, (self.low & np.uint64((1 << LOW - 16) - 1)) << np.uint64(32)
        self.leave[-2:] = 2
        out = []
        for first in range(0, self.lanes, 64):
            base, leave = self.base[:, first:first + 64].T, self.leave[:, first:first + 64].T
            both = np.empty((*base.shape, 2), np.uint32)
            both[..., 0] = base >> np.uint64(LOW)
            both[..., 1] = base >> np.uint64(LOW - 16) & np.uint64(0xFFFF)
            words = both[leave[..., None] > np.arange(2, dtype=np.uint8)]
            over = np.flatnonzero(words >> np.uint32(16))
            while len(over):  # a 17th bit is a carry to the word before
                words[over] &= np.uint32(0xFFFF)
                over -= 1
                words[over] += np.uint32(1)
                over = over[words[over] > 0xFFFF]
            sizes = leave.sum(1, dtype=np.int64)
            out += [w.tobytes() for w in np.split(words.astype(">u2"), np.cumsum(sizes)[:-1])]
        return out


class _Decoder(_Lanes):
    def __init__(self, words: list[np.ndarray], table: _Table):
        super().__init__(len(words), table)
        data = np.concatenate(words + [np.zeros(9, np.uint8)])
        start = np.concatenate([[0], np.cumsum([len(w) for w in words])[:-1]])
        code = np.zeros(len(words), np.uint64)
        for k in range(TOP // 8):
            code = (code << np.uint64(8)) | data[start + k]
        # Words begin at odd bytes, as TOP bits are an odd number of them; each with the word that follows.
        odd = data[1:len(data) - 1 + len(data) % 2].view(">u2")
        self.pairs = odd.astype(np.uint32)
        self.pairs <<= np.uint32(16)
        self.pairs[:-1] |= odd[1:]
        self.code, self.at = code, start + TOP // 8 - 1 >> 1
        self.ranks = table.by_share()

    def place(self, step, guess, peak, rest, wanted):
        n = len(step)
        value = self.code[:n] // step
        value = np.minimum(value, np.uint64((1 << _TOTAL_BITS) - 1)).view(np.int64)
        # Whether it lies on a guess: behind the other guess, if that is lower, that one's peak comes on top.
        low, width, group = self.order0(guess)
        low *= rest
        low += (peak[::-1] * (guess[::-1] < guess)).astype(np.int64) << _ORDER0
        width *= rest
        width += (peak + peak[::-1] * (guess[0] == guess[1])).astype(np.int64) << _ORDER0
        off = value - low
        here = off.view(np.uint64) < width.view(np.uint64)
        behind = (off >= 0) > here
        peaks = peak * behind
        peaks = (peaks[0] + peaks[1]).astype(np.int64) << _ORDER0
        # If not, order 0 without the peaks; whole numbers this small divide exactly.
        value = ((value - peaks) / rest).astype(np.int64)
        np.minimum(value, (1 << _ORDER0) - 1, out=value)
        under = self.shares[1:GROUPS, :n] <= (value >> INSIDE).astype(np.uint16)
        found_group = np.add.reduce(under.view(np.int8), axis=0, dtype=np.int8).astype(np.int64)
        begin, share = self.group_of(found_group)
        begin <<= INSIDE
        value -= begin
        inside = (value / share).astype(np.int64)
        inside += found_group << INSIDE
        found = self.ranks.take(inside, mode="clip").astype(np.int64)
        packed = self.table.packed.take(found, mode="clip")
        begin += share * (packed >> (INSIDE + 1) & _INSIDE)
        begin *= rest
        begin += peaks
        packed &= _WIDTH
        share *= packed
        share *= rest
        held = np.flatnonzero(here)
        lane = held % n
        for mine, its in ((found, guess), (found_group, group), (begin, low), (share, width)):
            mine[lane] = its.ravel()[held]
        return found, found_group, begin, share

    def narrow(self, n, step, low, width):
        span, code, at = step * width, self.code[:n], self.at[:n]
        low = step * low
        code -= low
        words = (span < np.uint64(1 << LOW)).view(np.uint8) + (span < np.uint64(1 << LOW - 16)).view(np.uint8)
        shift = _SHIFT.take(words, mode="clip")
        code <<= shift
        code |= self.pairs.take(at, mode="clip") >> (np.uint64(32) - shift)
        at += words
        np.left_shift(span, shift, out=self.range[:n])


def encode(ids: np.ndarray) -> bytes:
    """A table of the ids, all below 2**16, and blocks of BLOCK_IDS ids: number of ids, of bytes, CRC-32 of the ids, bytes.

    Every block starts anew from the table, so each can be read without the others.
    """
    if not len(ids):
        return b""
    if ids.min() < 0 or ids.max() >= 1 << 16:
        raise ValueError("ids must lie in 0 to 65535")
    table = _Table.of(ids)
    ranks = np.zeros(1 << 16, np.uint16)
    ranks[table.ids] = np.arange(len(table.ids))
    out = [table.pack()]
    for at in range(0, len(ids), BLOCK_IDS * LANES):
        part = ids[at:at + BLOCK_IDS * LANES]
        blocks = [part[i:i + BLOCK_IDS] for i in range(0, len(part), BLOCK_IDS)]
        full = np.zeros((len(blocks), len(blocks[0])), np.uint16)
        full.ravel()[:len(part)] = ranks[part]
        coder, full = _Encoder(len(blocks), len(blocks[0]), table), np.ascontiguousarray(full.T)
        for k in range(len(full)):
            n = len(blocks) - (len(blocks[-1]) <= k)  # only the last block may be shorter
            coder.ids(n, full[k, :n].astype(np.int64))
        for block, words in zip(blocks, coder.words()):
            crc = zlib.crc32(block.astype("<u4").tobytes())
            out.append(struct.pack("<III", len(block), len(words), crc) + words)
    return b"".join(out)


def decode(data: memoryview) -> np.ndarray:
    """The ids of a table and its blocks; a block whose checksum differs raises ValueError."""
    if not len(data):
        return np.empty(0, np.uint16)
    table, at = _Table.unpack(data)
    blocks = []
    while at < len(data):
        n, size, crc = struct.unpack_from("<III", data, at)
        blocks.append((n, crc, np.frombuffer(data, np.uint8, size, at + 12)))
        at += 12 + size
    out = []
    for first in range(0, len(blocks), LANES):
        group = sorted(range(first, min(first + LANES, len(blocks))), key=lambda i: -blocks[i][0])
        sizes = np.array([blocks[i][0] for i in group])
        coder = _Decoder([blocks[i][2] for i in group], table)
        ranks = np.zeros((int(sizes[0]), len(group)), np.uint16)
        for k in range(len(ranks)):
            n = int((sizes > k).sum())
            ranks[k, :n] = coder.ids(n, None)
        columns = table.ids.astype(np.uint16)[np.ascontiguousarray(ranks.T)]
        place = {i: p for p, i in enumerate(group)}
        for i in range(first, first + len(group)):
            block = columns[place[i], :blocks[i][0]]
            if zlib.crc32(block.astype("<u4").tobytes()) != blocks[i][1]:
                raise ValueError("damaged block")
            out.append(block)
    return np.concatenate(out)


# ---- tokens -----------------------------------------------------------------------------------------------------

class _Words:
    """Pieces of text already tokenised, and the ids of each; place 0 is the end id."""

    def __init__(self, tokenizer, end_id: int):
        self.tokenizer, self.end_id = tokenizer, end_id
        special = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
        # No text is cut in front of a character that special tokens hold.
        free = ~np.isin(np.arange(256), list("".join(special.values()).encode())) & (np.arange(256) < 128)
        self.space, self.mark = free & _SPACE, free & ~_SPACE & ~_LETTER
        # A byte-level token has a character for each byte.
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = np.zeros(max([*vocabulary.values(), *special]) + 1, np.int64)
        self.bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.bytes[list(special)] = [len(t.encode()) for t in special.values()]
        self.clear()

    def clear(self):
        self.pieces = pa.array([], pa.large_string())
        self.flat = np.array([self.end_id], np.int32)
        self.start, self.size = np.zeros(1, np.int64), np.ones(1, np.int64)

    def __len__(self):
        return len(self.pieces)

    def _joined(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of pieces that lie side by side, tokenised together, and how many each has; None unless the ids' bytes
        end where the pieces do."""
        edges = [*begins[:-1:JOINED], begins[-1]]
        texts = (data[a:b].tobytes().decode() for a, b in zip(edges[:-1], edges[1:]))
        ids = np.concatenate([np.array(self.tokenizer.encode_batch_fast([t], add_special_tokens=False)[0].ids, np.int32)
                              for t in texts])
        ends = np.cumsum(self.bytes[ids])
        last = np.searchsorted(ends, begins[1:])
        if last[-1] != len(ids) - 1 or (ends[last] != begins[1:]).any():
            return None
        return ids, np.diff(last, prepend=-1)

    def _learn(self, pieces: pa.Array) -> np.ndarray:
        """Tokenises new pieces and returns their places. Those that begin with a space or line end and do not end in
        white space, which would join what follows, are tokenised many at a time."""
        data, begins = utf8(pieces)
        first, last = data[begins[:-1]], data[begins[1:] - 1]
        spaced = ((first == 32) | (first == 10)) & ~_SPACE[last] & ~_TAIL[last]
        own, found = pieces.filter(pa.array(spaced)), None
        if len(own):
            found = self._joined(*utf8(own))
        if found is None:
            spaced[:] = False
        own, rest = pieces.filter(pa.array(spaced)), pieces.filter(pa.array(~spaced))
        ids, sizes = ([], []) if found is None else ([found[0]], [found[1]])
        for one in self.tokenizer.encode_batch_fast(rest.to_pylist(), add_special_tokens=False) if len(rest) else []:
            ids.append(np.array(one.ids, np.int32))
            sizes.append([len(one.ids)])
        ids, sizes = np.concatenate(ids), np.concatenate(sizes).astype(np.int64)
        places = np.empty(len(pieces), np.int64)
        places[np.argsort(~spaced, kind="stable")] = len(self.start) + np.arange(len(pieces))
        self.pieces = pa.concat_arrays([self.pieces, own, rest])
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(sizes) - sizes])
        self.size, self.flat = np.concatenate([self.size, sizes]), np.concatenate([self.flat, ids])
        return places

    def places(self, pieces: pa.Array) -> np.ndarray:
        """Places of distinct pieces."""
        found = pc.index_in(pieces, self.pieces)
        places = found.fill_null(-1).to_numpy().astype(np.int64) + 1
        if found.null_count:
            places[places == 0] = self._learn(pieces.filter(found.is_null()))
        return places

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces, and how many each has."""
        size = self.size[places]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.start[places] - (ends - size), size) + np.arange(ends[-1])], size


def _begins(data: np.ndarray, offsets: np.ndarray, words: _Words) -> np.ndarray:
    """Where pieces of the texts begin that lie side by side in `data`; every piece has a byte at least."""
    begin = np.zeros(len(data) + 1, bool)
    space = _SPACE[data]
    begin[1:-1] = words.space[data[1:]] & ~space[:-1]
    begin[1:-1] |= words.mark[data[1:]] & _LETTER[data[:-1]]
    wide = np.flatnonzero(begin[1:-1] & _TAIL[data[:-1]])  # place of the byte before
    if len(wide):
        begin[wide[_LEAD[data[np.maximum(wide - 1, 0)]] | _LEAD[data[np.maximum(wide - 2, 0)]]] + 1] = False
    begin[offsets] = True
    return np.flatnonzero(begin[:-1])


def token_ids(texts: list[str] | pa.Array, words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each followed by the end id, and their number for each text.

    The byte-level pre-tokeniser always parts a character from white space behind it, and an ASCII letter from an ASCII
    character behind it that is none. Texts are cut there, unless the character may be white space itself, and each
    distinct piece is tokenised once.
    """
    data, offsets = utf8(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts)
    begins = _begins(data, offsets, words) if len(data) else np.empty(0, np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(np.append(begins, len(data))), pa.py_buffer(data))
    pieces = pieces.dictionary_encode()
    ends = np.searchsorted(begins, offsets[1:]) + np.arange(1, len(offsets))  # behind the end ids
    places = np.zeros(len(begins) + len(offsets) - 1, np.int64)
    of_text = np.ones(len(places), bool)
    of_text[ends - 1] = False
    places[of_text] = words.places(pieces.dictionary)[pieces.indices.to_numpy()]
    ids, size = words.take(places)
    total = np.concatenate([[0], np.cumsum(size)])[ends]
    if len(words) > CACHED:
        words.clear()
    return ids, np.diff(total, prepend=0)


def _section(part: int, number: int, docs: list, sizes: list, ids: list) -> bytes:
    """Header, directory (identifier, whether it is null, number of ids) and blocks of some whole documents."""
    doc = pa.concat_arrays(docs)
    body = encode(np.concatenate(ids))
    size = np.concatenate(sizes)
    directory = (doc.fill_null(0).to_numpy().astype("<i8").tobytes()
                 + doc.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes() + size.astype("<u8").tobytes())
    return MAGIC + struct.pack("<IIQQI", part, number, len(doc), len(body), zlib.crc32(directory)) + directory + body


def _encoded(path: str, end_id: int):
    def run(batches):
        from tokenizers import Tokenizer

        words = _Words(Tokenizer.from_file(path), end_id)
        part, number = TaskContext.get().partitionId(), 0
        docs, sizes, ids, held = [], [], [], 0

        def done():
            return pa.RecordBatch.from_arrays([pa.array([_section(part, number, docs, sizes, ids)], pa.binary())], ["section"])

        for batch in slices(batches, 1, 2 << 20):
            found, size = token_ids(batch.column(1), words)
            if len(found) and not 0 <= found.min() <= found.max() < 1 << 16:
                raise ValueError("ids must lie in 0 to 65535")
            doc, found, ends = batch.column(0).to_pylist(), found.astype(np.uint16), np.cumsum(size)
            first = 0
            while first < len(doc):
                before = ends[first - 1] if first else 0
                last = int(np.searchsorted(ends, before + SECTION_MOST - held, "right"))
                if last <= first and held:  # the next document does not fit
                    yield done()
                    docs, sizes, ids, held, number = [], [], [], 0, number + 1
                    continue
                last = max(last, first + 1)
                docs.append(pa.array(doc[first:last], pa.int64()))  # a slice would hold its whole batch
                sizes.append(size[first:last])
                ids.append(found[before:ends[last - 1]])
                held, first = held + len(ids[-1]), last
            if held >= SECTION_IDS:
                yield done()
                docs, sizes, ids, held, number = [], [], [], 0, number + 1
        if docs:
            yield done()

    return run


def write_ids(docs: DataFrame, place: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
              text_col: str = "text") -> None:
    """Writes the ids of all texts, in ascending order of (identifier, text hash), into files below `place`.

    Sampled splitters deal the documents out by that order, each task writes a file of sections, each section ends in
    a line end that readers skip. Null texts are empty and have the end id alone; null identifiers come first; repeated
    rows are repeated. Other columns are not read. Ids must be below 65536.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    (rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_encoded(tokenizer, end_id), "section binary")
     .select(F.col("section").cast("string").alias("value"))
     .write.option("lineSep", "\n").option("maxRecordsPerFile", FILE_SECTIONS).text(place))


def _decoded(batches):
    for batch in batches:
        for content in batch.column(0):
            data, at = memoryview(content.as_buffer()), 0
            while at < len(data):
                if data[at:at + 4] != MAGIC:
                    raise ValueError("not a section of token ids")
                part, number, n, size, crc = struct.unpack_from("<IIQQI", data, at + 4)
                at += 32
                directory = data[at:at + 17 * n]
                if zlib.crc32(directory) != crc:
                    raise ValueError("damaged directory")
                doc, null = np.frombuffer(directory, "<i8", n), np.frombuffer(directory, np.uint8, n, 8 * n)
                sizes = np.frombuffer(directory, "<u8", n, 9 * n).astype(np.int64)
                ids = decode(data[at + 17 * n:at + 17 * n + size])
                at += 17 * n + size + 1
                ends = np.cumsum(sizes)
                crcs = [zlib.crc32(ids[e - s:e].astype("<u4").tobytes()) for e, s in zip(ends, sizes)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, number, np.int32)),
                    pa.array(doc, mask=null.astype(bool)), pa.array(ends - sizes), pa.array(sizes),
                    pa.array(crcs, pa.int64())], ["part", "section", "doc_id", "inside", "n_tokens", "ids_crc32"])


def read_ids(spark: SparkSession, place: str) -> DataFrame:
    """One row per document in the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Every block and directory is checked. An empty folder gives no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(place).select("content")
    found = written(files.mapInArrow(_decoded, "part int, section int, doc_id long, inside long, n_tokens long, "
                                     "ids_crc32 long"), "read-ids")
    sections = found.groupBy("part", "section").agg(F.sum("n_tokens").alias("n"))
    parts = sections.groupBy("part").agg(F.sum("n").alias("n"))  # a row for each file
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("parts_before"))
    within = Window.partitionBy("part").orderBy("section")
    starts = (sections.withColumn("first", F.sum("n").over(within) - F.col("n")).drop("n").join(before, "part")
              .select("part", "section", (F.col("first") + F.col("parts_before")).alias("first")))
    return found.join(starts, ["part", "section"]).select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int = 2, **columns) -> DataFrame:
    """Writes the ids into the shared folder and returns what the files say of each document."""
    place = scratch(docs.sparkSession, "ids")
    write_ids(docs, place, tokenizer, end_id, **columns)
    return read_ids(docs.sparkSession, place)
