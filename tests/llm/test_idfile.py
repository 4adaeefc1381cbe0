import functools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import idfile as I
from tidemark.llm import mixing as M

TEXTS = ["", "a", " A  b\n", "Hello WORLD's <|endoftext|> x<|startoftext|>y 12345", "x" * 5000, "é é ́a ΣΑΣ İ", "日本 語 😀", "\t\x0b\x0c \x1c\x85\xa0 z", "the the the " * 4000, "don't 've a.b,C-(d) <|ENDOFTEXT|> I'M.'s"]


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(I.locate(I.VOCABULARY))


def library(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.text(alphabet="abAB1'.,-()s \n\t\x0b\x0c\x1c\x85\xa0é́Σςİ😀<|endoftx>", max_size=40), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_words_are_encoded_as_whole_texts_are(texts):
    w = I.words(I.VOCABULARY)
    assert w.parted
    found = list(w.encode(pa.array(texts)))
    ids, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
    want = [library(t) for t in texts]
    assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(x) for x in want]


@given(st.lists(st.text(alphabet="aB1é\u0338\u0301 '<|>!\"#$%&()*+,-./:;=?@[\\]^_`{}~", max_size=40), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_marks_part_words(texts):
    ids, sizes = (np.concatenate(x) for x in zip(*I.words(I.VOCABULARY).encode(pa.array(texts)), strict=True))
    want = [library(t) for t in texts]
    assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(x) for x in want]


def test_slots_of_words_are_bounded_and_forgotten():
    w = I.Words(I.VOCABULARY)
    text = " ".join(f"word{i}" for i in range(30_000))
    first = np.concatenate([x for x, _ in w.encode(pa.array([text, "y" * 100]))])
    assert first.tolist() == library(text) + library("y" * 100) and len(w.keys) == I.SLOTS
    w.used = I.POOL + 1
    assert np.concatenate([x for x, _ in w.encode(pa.array([text]))]).tolist() == library(text) and w.used < I.POOL


@given(st.lists(st.lists(st.integers(0, 9) | st.integers(0, M.MOST_IDS - 1), max_size=70), max_size=6))
@settings(max_examples=60, deadline=None)
def test_blocks_come_back(blocks):
    blocks = [np.array(b, np.uint32) for b in blocks]
    back = M.decode(M.encode(blocks), [len(b) for b in blocks])
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(back, blocks, strict=True))


@pytest.mark.parametrize("kind", ["one id", "noise", "text", "pairs", "rare changes"])
def test_long_blocks_come_back_and_are_small(kind):
    r = np.random.default_rng(5)
    n = 6000
    ids = {
        "one id": np.zeros(n), "noise": r.integers(0, M.MOST_IDS, n), "text": np.minimum(r.zipf(1.2, n), 60_000), "pairs": np.tile(r.integers(0, 60_000, 300), n // 300),
        "rare changes": np.where(r.random(n) < 0.002, r.integers(0, 60_000, n), 7),
    }[kind].astype(np.uint32)
    blocks = [ids, ids[:100], ids[: n - 1], ids[:0]]
    data = M.encode(blocks)
    assert all((a == b).all() for a, b in zip(M.decode(data, [len(b) for b in blocks]), blocks, strict=True))
    most = {"one id": 0.05, "noise": 17.2, "text": 12, "pairs": 3, "rare changes": 0.3}[kind]
    assert 8 * len(data[0]) / n < most
    # A block is read on its own, whatever stands beside it.
    assert (M.decode(data[1:2], [100])[0] == ids[:100]).all()


def test_ranks_beyond_the_most_are_refused():
    with pytest.raises(ValueError, match="ranks"):
        M.encode([np.array([M.MOST_IDS], np.uint32)])


@given(st.lists(st.integers(0, 3) | st.integers(0, 49_407), max_size=60), st.integers(1, 60))
@settings(max_examples=100, deadline=None)
def test_phrases_are_spelt_as_they_were(ids, times):
    ids = np.array(ids * times, np.int32)
    data = I.packed(0, 0, np.array([1]), np.array([True]), np.array([len(ids)]), ids, 16)
    assert (I.unpacked(data)[5] == ids).all()


def test_ids_that_go_together_are_coded_in_one_step(monkeypatch):
    r = np.random.default_rng(2)
    words = [r.integers(0, 3000, r.integers(2, 5)) for _ in range(500)]
    ids = np.concatenate([words[i] for i in r.integers(0, 500, 20_000)]).astype(np.int32)
    steps = []
    code = M.encode
    monkeypatch.setattr(I.mixing, "encode", lambda blocks: steps.extend(map(len, blocks)) or code(blocks))
    data = I.packed(0, 0, np.array([1]), np.array([True]), np.array([len(ids)]), ids)
    assert sum(steps) < 0.55 * len(ids) and (I.unpacked(data)[5] == ids).all()


def test_new_words_are_encoded_many_at_a_time():
    w = I.Words(I.VOCABULARY)
    calls = []
    library_of = w.library
    w.library = lambda texts: calls.extend(texts) or library_of(texts)
    text = " ".join(f"new{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)) + " x<y <|endoftext|> é#a b=c`d [e]_f"
    assert np.concatenate([x for x, _ in w.encode(pa.array([text]))]).tolist() == library(text)
    assert len(calls) < 30


def test_words_of_letters_go_to_the_model_alone():
    w = I.Words(I.VOCABULARY)
    calls = []
    library_of = w.library
    w.library = lambda texts: calls.extend(texts) or library_of(texts)
    text = " ".join(f"NEW{chr(97 + i % 26)}é{chr(0xC0 + i % 20)}{chr(97 + i // 26)}" for i in range(600)) + " a,b 's"
    assert np.concatenate([x for x, _ in w.encode(pa.array([text]))]).tolist() == library(text)
    assert sum(map(len, calls)) < 100


@given(st.lists(st.text(alphabet="aZß×÷ªºµÀÖØÞÿéÉſK\u0301\u0345ŸΣ' 1", max_size=30), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_latin_letters_beside_others(texts):
    ids, sizes = (np.concatenate(x) for x in zip(*I.words(I.VOCABULARY).encode(pa.array(texts)), strict=True))
    want = [library(t) for t in texts]
    assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(x) for x in want]


def test_only_what_followed_the_same_ids_is_asked_for(monkeypatch):
    asked = []
    choose = M.Encoder.choose
    monkeypatch.setattr(M.Encoder, "choose", lambda self, n, lanes, *rest: asked.append(len(lanes)) or choose(self, n, lanes, *rest))
    ids = np.random.default_rng(3).permutation(60_000)[:1000].astype(np.uint32)
    again = np.concatenate((ids[:100], ids[:100]))
    for block, least, most in ((ids, 0, 5), (again, 95, 105)):
        asked.clear()
        data = M.encode([block])
        assert least <= sum(asked) <= most
        assert (M.decode(data, [len(block)])[0] == block).all()


@pytest.mark.parametrize("steps", [1, 2, 700])
def test_coding_costs_what_the_model_says(monkeypatch, steps):
    """A block takes the bits of its frequencies, and up to 64 for the coder's state."""
    r = np.random.default_rng(steps)
    ids = np.where(r.random(steps) < 0.3, 65_534, r.integers(0, 65_535, steps)).astype(np.uint32)
    bits = []
    number, choose = M.Encoder.number, M.Encoder.choose

    def counted(self, n, table, others, rank):
        size = int(rank[0] + 1).bit_length() - 1
        ends = [*table[0].tolist(), 1 << M.TOTAL]
        if not len(others):
            bits.append(M.TOTAL - np.log2(ends[size + 1] - ends[size]) + size)
        return number(self, n, table, others, rank)

    def asked(self, n, lanes, first, second, answer):
        for x, y, k in zip(first.tolist(), second.tolist(), answer.tolist(), strict=True):
            bits.append(16 - np.log2([x, y, 65536 - x - y][k]))
        return choose(self, n, lanes, first, second, answer)

    monkeypatch.setattr(M.Encoder, "number", counted)
    monkeypatch.setattr(M.Encoder, "choose", asked)
    data = M.encode([ids])[0]
    assert sum(bits) < 8 * len(data) < sum(bits) + 64 + 1
    monkeypatch.undo()
    assert (M.decode([data], [steps])[0] == ids).all()


def test_damage_is_noticed():
    ids = np.random.default_rng(1).integers(0, 500, 3000).astype(np.int32)
    data = I.packed(3, 1, np.array([5, 6]), np.array([True, False]), np.array([1000, 2000]), ids, 512)
    part, number, doc_ids, named, sizes, back = I.unpacked(data)
    assert (part, number, doc_ids.tolist(), named.tolist(), sizes.tolist()) == (3, 1, [5, 6], [True, False], [1000, 2000]) and (back == ids).all()
    for at in (0, 20, 70, len(data) // 2, len(data) - 8):
        with pytest.raises(ValueError, match="token file"):
            I.unpacked(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])
    with pytest.raises(ValueError, match="cut short"):
        I.unpacked(data[:-10])


def brute(rows):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library(text), I.END_ID]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def found(df):
    return [tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()]


def test_documents_in_order(spark):
    rows = [(100 - 3 * i, t) for i, t in enumerate(TEXTS)] + [(7000, None), (-5, "the end"), (None, "no id")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, start int, part string").repartition(4)
    want = brute(rows)
    assert found(I.stored(df)) == want
    # Small files and blocks: many files of a part.
    assert found(I.stored(df, most_ids=50, block=16)) == want
    assert found(I.stored(df.limit(0))) == []


def test_repeated_rows_and_ids(spark):
    rows = [(1, "same text")] * 40 + [(None, "x")] * 3 + [(2, None)] * 2
    assert found(I.stored(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == brute(rows)


def test_ids_are_read_back(spark, tmp_path):
    rows = list(enumerate(TEXTS))
    I.write(spark.createDataFrame(rows, "doc_id long, text string"), f"file://{tmp_path}/ids")
    got = {r.doc_id: r.ids for r in I.read(spark, f"file://{tmp_path}/ids", with_ids=True).collect()}
    assert got == {i: [*library(t), I.END_ID] for i, t in rows}
