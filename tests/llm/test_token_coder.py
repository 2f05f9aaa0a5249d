import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import token_coder

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 2047, 2048, 2049, 9000])
@pytest.mark.parametrize("top", [1, 3, 700, 65536])
def test_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, top, n)
    assert (token_coder.decode(memoryview(token_coder.encode(ids))) == ids).all()


def test_predictions_save_space():
    ids = np.tile(np.random.default_rng(1).integers(0, 50_000, 64), 100)
    assert len(token_coder.encode(ids)) < len(ids) / 4


def test_extreme_symbols_carry():
    ids = np.concatenate([np.full(3000, 65535), np.zeros(3000, int), np.arange(3000) * 21 % 65536, np.full(3000, 65535)])
    assert (token_coder.decode(memoryview(token_coder.encode(ids))) == ids).all()


def test_damage_is_found():
    data = bytearray(token_coder.encode(np.arange(3000)))
    data[200] ^= 1
    with pytest.raises(ValueError):
        token_coder.decode(memoryview(bytes(data)))
    with pytest.raises(ValueError):
        token_coder.encode(np.array([65536]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab '.\n\t\0 é中!1<|endoftext|>", max_size=40), min_size=1, max_size=5))
def test_pieces_give_the_library_s_ids(tokenizer, texts):
    ids, sizes = token_coder.token_ids(texts, token_coder._Words(tokenizer, 2))
    want = [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert list(sizes) == [len(w) for w in want] and list(ids) == [i for w in want for i in w]


@pytest.mark.parametrize("texts", [
    ["a b\n\nc d\n", "hi\n", "yo\n"], ["a c\n ", "b\n", "x y"], ["a\r\n", "b\r\n\r\nc", "d\t ", "e\t \tf", "g\u3000\n"],
])
def test_pieces_that_end_in_white_space(tokenizer, texts):
    """New pieces must not join each other, nor keep wrong ids for later texts."""
    words = token_coder._Words(tokenizer, 2)
    for some in (texts, texts[::-1]):
        ids, sizes = token_coder.token_ids(some, words)
        want = [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in some]
        assert list(sizes) == [len(w) for w in want] and list(ids) == [i for w in want for i in w]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "B", "é", "à", "中", " ", "  ", "\n", "\r\n", "\t", "\x1c", "\x85", "\xa0",
                                          "\u2003", "\u2028", "\u3000", "'s", "'", ".", ",", "7", "\0", "<|endoftext|>"]),
                         max_size=30).map("".join), min_size=1, max_size=5))
def test_cuts_at_any_white_space_and_marks(tokenizer, texts):
    words = token_coder._Words(tokenizer, 2)
    for some in (texts, texts[::-1]):
        ids, sizes = token_coder.token_ids(some, words)
        want = [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in some]
        assert list(sizes) == [len(w) for w in want] and list(ids) == [i for w in want for i in w]


class Counting:
    """A tokenizer that adds up the characters given to it."""

    def __init__(self, tokenizer):
        self.tokenizer, self.read = tokenizer, 0

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode(self, text, **options):
        self.read += len(text)
        return self.tokenizer.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.read += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("text", ["a few words.  More words,\n\nand so on\t \n" * 500, "one, two. one. two, " * 500])
def test_each_piece_is_tokenised_once(tokenizer, text):
    """Also in texts with runs of white space, and with marks behind words."""
    counting = Counting(tokenizer)
    ids, _ = token_coder.token_ids([text], token_coder._Words(counting, 2))
    assert list(ids) == tokenizer.encode(text, add_special_tokens=False).ids + [2]
    assert counting.read < 60


def test_pieces_tokenised_alone_where_bytes_do_not_tell(tokenizer):
    words = token_coder._Words(tokenizer, 2)
    words.bytes[:] = 1
    ids, _ = token_coder.token_ids([" some words of a text", " and others"], words)
    assert list(ids) == [i for t in (" some words of a text", " and others")
                         for i in tokenizer.encode(t, add_special_tokens=False).ids + [2]]


def brute(rows, tokenizer):
    out, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_files_of_documents(documents, tokenizer):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = [tuple(r) for r in token_coder.write_and_read(documents, PATH).collect()]
    assert sorted(got) == brute(rows, tokenizer)


def test_odd_rows(odd, odd_rows, tokenizer, monkeypatch):
    monkeypatch.setattr(token_coder, "SECTION_IDS", 50)
    got = [tuple(r) for r in token_coder.write_and_read(odd, PATH).collect()]
    want = brute(odd_rows, tokenizer)
    # Rows that share an identifier are in the order of a hash, so starts are compared as a whole.
    assert sorted((str(i), n, c) for i, _, n, c in got) == sorted((str(i), n, c) for i, _, n, c in want)
    spans = sorted((s, n) for _, s, n, _ in got)
    assert spans[0][0] == 0 and all(s + n == t for (s, n), (t, _) in zip(spans, spans[1:]))
    order = [i for _, _, i in sorted((s, n, i) for i, s, n, _ in got)]
    assert [i for i in order if i is not None] == sorted(i for i, _ in odd_rows if i is not None)
    assert order[:2] == [None, None]


def test_no_rows(odd):
    assert token_coder.write_and_read(odd.limit(0), PATH).count() == 0


def entropy(ids):
    share = np.bincount(ids)
    share = share[share > 0] / len(ids)
    return -(share * np.log2(share)).sum()


def test_real_ids_take_less_than_their_order_0_entropy(documents, tokenizer):
    texts = [r.text for r in documents.select("text").collect()]
    ids, _ = token_coder.token_ids(texts, token_coder._Words(tokenizer, 2))
    assert len(token_coder.encode(ids)) * 8 / len(ids) < entropy(ids)


def test_each_order_adds_to_the_prediction():
    """Ids that follow from the last one, or from the last two, cost far less than their order-0 entropy."""
    rng = np.random.default_rng(4)
    after = rng.permutation(200)
    one = np.zeros(40_000, int)
    for i in range(1, len(one)):
        one[i] = after[one[i - 1]] if rng.random() < 0.9 else rng.integers(200)
    two = np.zeros(40_000, int)
    for i in range(2, len(two)):
        two[i] = (two[i - 1] * 7 + two[i - 2] * 3 + 1) % 40 if rng.random() < 0.9 else rng.integers(40)
    for ids in (one, two):
        assert len(token_coder.encode(ids)) * 8 / len(ids) < 0.75 * entropy(ids)


def test_blocks_are_independent():
    ids = np.random.default_rng(2).integers(0, 500, 3 * token_coder.BLOCK_IDS)
    data = memoryview(token_coder.encode(ids))
    _, at = token_coder._Table.unpack(data)
    for k in range(3):
        size = 12 + int.from_bytes(data[at + 4:at + 8], "little")
        alone = bytes(data[:token_coder._Table.unpack(data)[1]]) + bytes(data[at:at + size])
        found = token_coder.decode(memoryview(alone))
        assert (found == ids[k * token_coder.BLOCK_IDS:(k + 1) * token_coder.BLOCK_IDS]).all()
        at += size


@pytest.mark.parametrize("distinct", [1, 2, 15, 17, 65536])
def test_shares_of_a_table(distinct):
    ids = np.concatenate([np.arange(distinct), np.zeros(100_000, int)])
    table = token_coder._Table.of(ids)
    assert sorted(table.ids) == list(range(distinct)) and (table.width >= 1).all()
    for a, b in zip(table.bounds[:-1], table.bounds[1:]):
        assert a == b or table.width[a:b].sum() == 1 << token_coder.INSIDE
    again, _ = token_coder._Table.unpack(memoryview(table.pack()))
    assert (again.ids == table.ids).all() and (again.inside == table.inside).all()


def test_files_hold_a_bounded_number_of_sections(spark, documents, monkeypatch):
    monkeypatch.setattr(token_coder, "SECTION_IDS", 5000)
    place = token_coder.scratch(spark, "bounded")
    many = documents
    for _ in range(5):
        many = many.unionByName(many)
    token_coder.write_ids(many.coalesce(1), place, PATH, 2)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(place).select("content").collect()
    assert len(files) > 1 and max(f.content.count(token_coder.MAGIC) for f in files) <= token_coder.FILE_SECTIONS


def test_decoder_holds_few_bytes_for_each_byte_of_a_section():
    table, words = token_coder._Table.of(np.arange(500)), [np.zeros(1 << 23, np.uint8)]
    tracemalloc.start()
    try:
        token_coder._Decoder(words, table)
        assert tracemalloc.get_traced_memory()[1] < 6 * len(words[0])
    finally:
        tracemalloc.stop()


def test_sections_hold_whole_documents_up_to_their_size(monkeypatch):
    """No section is a few blocks longer than what is coded side by side; a longer document is a section of its own."""
    monkeypatch.setattr(token_coder, "SECTION_MOST", 1000)
    sizes = []
    monkeypatch.setattr(token_coder, "_section", lambda part, number, docs, size, ids: sizes.append(
        (number, [s for some in size for s in some], sum(map(len, ids)))) or b"")
    task = SimpleNamespace(partitionId=lambda: 0)
    monkeypatch.setattr(token_coder, "TaskContext", SimpleNamespace(get=lambda: task))
    texts = ["a b c"] * 700 + ["a " * 3000] + ["", None] + ["a b"] * 400
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    list(token_coder._encoded(PATH, 2)(iter([batch])))
    assert [n for n, _, _ in sizes] == list(range(len(sizes)))
    assert sum(len(s) for _, s, _ in sizes) == len(texts) and all(sum(s) == n for _, s, n in sizes)
    assert all(n <= 1000 or len(s) == 1 for _, s, n in sizes) and max(n for _, _, n in sizes) > 3000
