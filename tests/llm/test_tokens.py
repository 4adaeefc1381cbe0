import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import tokens as T

TEXTS = ["", "a", " a", "a  b", "Hello  world\n\n next <|endoftext|> it's 12 345", "x" * 5000, ("wörd " * 3000).strip(), "a b c  d", "\t\n ", "日本 語 текст 😀 ok", "ab \x1c cd \x85 e"]


@given(st.text(alphabet="ab1'. \n\té😀 \x1c<|endoftext|>", max_size=60))
@settings(max_examples=300, deadline=None)
def test_parting_changes_nothing(text):
    assert T.encode_text(text, long=3).tolist() == T.encoding().encode_ordinary(text)
    assert "".join(T.parts(text)) == text
    tok = T.counter(T.VOCABULARY)
    assert tok.count([text]) == tok.sizes([text])


@given(st.text(alphabet="ab12'. ,\n\té😀 \x1c、。字_-²٣!", min_size=20, max_size=200))
@settings(max_examples=1500, deadline=None)
def test_parting_without_spaces_changes_nothing(text):
    assert "".join(T.pieces(text, 5)) == text
    assert T.encode_text(text, long=5).tolist() == T.encoding().encode_ordinary(text)
    tok = T.counter(T.VOCABULARY)
    assert sum(tok.sizes(T.parts(text, 5))) == tok.sizes([text])[0]


@pytest.mark.parametrize("text", ["word\n" * 120_000, "我们在城市的中心，看到了。" * 12_000, "word " * 60_000, "a,b" * 90_000, "x" * 90_000 + " y"], ids=["lines", "Chinese", "spaces", "marks", "one word"])
def test_long_texts_are_parted(spark, text):
    found = T.pieces(text)
    assert "".join(found) == text and (max(map(len, found)) < 2 * T.LONG or "x" * 90_000 in text)
    want = T.encoding().encode_ordinary(text)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = T.round_trip(df).first()
    assert r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest() and r.round_trips
    assert T.count(df).first().n_tokens == T.counter(T.VOCABULARY).sizes([text])[0]


def test_what_a_worker_remembers_is_bounded():
    tok = T.Counter(T.VOCABULARY)
    tok.count([" ".join(f"w{i}" + "x" * 200 for i in range(3000))])
    assert all(len(k) <= T.SHORT for k in tok.known)


def rows(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate([*TEXTS, None, "a"])], "doc_id long, text string, n_tokens string, ids int")


def test_round_trip(spark):
    got = {r.doc_id: r for r in T.round_trip(rows(spark)).collect()}
    for i, t in enumerate([*TEXTS, "", "a"]):
        ids = T.encoding().encode_ordinary(t)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() and got[i].round_trips
    assert T.round_trip(rows(spark).limit(0)).count() == 0


def test_encode_then_decode(spark):
    ids = T.encode(rows(spark))
    assert {r.doc_id: bytes(r.decoded).decode() for r in T.decode(ids).collect()} == dict(enumerate([*TEXTS, "", "a"]))
    assert T.decode_ids([255]) and T.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first().decoded == b""


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_are_the_librarys(spark, name):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in T.count(rows(spark), vocabulary=name).collect()}
    if name.endswith("json"):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(T.locate(name))
        size = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    else:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=T.locate(name))
        size = lambda t: len(sp.encode(t))
    for i, t in enumerate([*TEXTS, "", "a"]):
        assert got[i] == (len(t.encode()), size(t), size(t) > 512), (name, t[:20])


def test_documents_whole(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {r.doc_id: r.n_tokens for r in T.op4_bpe_round_trip(spark, sf).collect()}
    assert got == {k: len(T.encoding().encode_ordinary(t)) for k, t in texts.items()}
    tok = T.counter(T.VOCABULARY)
    assert {r.doc_id: r.n_tokens for r in T.op9_token_counts(spark, sf).collect()} == dict(zip(texts, tok.sizes(list(texts.values()))))
