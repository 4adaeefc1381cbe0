import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import toxicity as X
from tidemark.llm.bytes import chunks


def run_of(texts):
    [(_, _, buf, at)] = list(chunks(pa.array(texts)))
    return buf, at


def word(w):
    return X.hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w.encode())]))[0]


def test_terms_of_texts():
    got = X.row_terms(*run_of(["Idiot, idiots! ÉTÉ été x1y", "", None, "a"]))
    one = [h for r, h in zip(*got) if r == 0]
    assert one.count(word("été")) == 2 and one.count(word("idiot")) == 2 and word("x") in one and word("y") in one
    assert one.count(word("idio")) == 2
    assert [int((got[0] == r).sum()) > 0 for r in range(4)] == [True, False, False, True]
    first, h, tf = X.bags(*run_of(["b a b", None, "a"]))
    assert first.tolist() == [0, 2, 2, 3] and {(int(x), int(n)) for x, n in zip(h[:2], tf[:2])} == {(int(word("a")) >> 16, 1), (int(word("b")) >> 16, 2)}


def index_of(rows, *more):
    first = np.cumsum([0, *(len(at) for at, _ in rows)])
    return X.Index(first, np.concatenate([at for at, _ in rows]).astype(np.int32), np.concatenate([w for _, w in rows]).astype(np.float32), *more)


def test_index_is_exact(monkeypatch):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(700):
        at = np.sort(rng.choice(200, rng.integers(0, 12), replace=False, p=np.arange(1, 201) / 20100))
        w = rng.random(len(at)) ** 4 + 0.01
        rows.append((at, w / max(np.linalg.norm(w), 1e-9)))
    dense = np.zeros((700, 200))
    for i, (at, w) in enumerate(rows):
        dense[i, at] = w
    for common, block, short in ((0, 8, 0), (16, 64, 5), (200, 16, 64), (16, 1000, 64), (0, 64, 20)):
        monkeypatch.setattr(X, "SHORT", short)
        index = index_of(rows, 200, common, block)
        for i, (at, w) in enumerate(rows[:150]):
            for without in (-1, i):
                cos = dense[:, at] @ w
                if without >= 0:
                    cos[without] = 0
                want = np.sort(cos[cos > 1e-9])[::-1][:15]
                place, got = index.nearest(at, w, 15, None, without)
                assert np.allclose(got, want, atol=1e-5) and np.allclose(cos[place], got, atol=1e-5) and without not in place


def test_blocks_are_passed_over():
    """Rare words decide: few blocks are read, and the neighbours are still exact."""
    heavy = lambda i: 0.99 if i % 128 < 32 else 0.2
    rows = [(np.array([i // 128, 300]), np.array([heavy(i), 0.1])) for i in range(1600)]
    index = index_of(rows, 301, 1, 16)
    read = []
    real = X.ranges
    X.ranges = lambda a, b: (read.append(int((b - a).sum())), real(a, b))[1]
    try:
        at, cosine = index.nearest(np.array([7, 300]), np.array([0.99, 0.1]), 8)
    finally:
        X.ranges = real
    assert at.tolist() == list(range(896, 904)) and np.allclose(cosine, 0.99**2 + 0.1**2, atol=1e-4) and 0 < sum(read) < 100


def tokens_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[a-z]+", low)
    return collections.Counter(words + [w[:k] for w in words for k in X.PREFIXES if len(w) > k])


def test_scores_are_those_of_brute_force(spark):
    """Neighbours, cosines and scores from counted words, without any hash, block or bucket."""
    rng = np.random.default_rng(11)
    vocab = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(500)]
    texts, labels = {}, {}
    for i in range(420):
        toxic = int(i % 5 == 0 and i % 3 != 0)
        texts[i] = " ".join([*rng.choice(vocab, rng.integers(5, 40)), *(["Vile", "scum"][: 1 + i % 2] * toxic)])
        if i < 300:
            labels[i] = toxic
    texts |= {900: None, 901: "", 902: "zz unknown words", 903: "vile scum"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    model = X.fit(docs, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"), X.Settings(common=20, block=8))
    got = {r.doc_id: r for r in X.score(docs, model).collect()}

    bag = {i: tokens_of(t) for i, t in texts.items()}
    learnt = [i for i in labels if zlib.crc32(str(i).encode()) % 5]
    assert sorted(model.examples) == sorted(learnt)
    df = collections.Counter(w for b in bag.values() for w in b)
    pos = [i for i in learnt if labels[i]]
    neg = [i for i in learnt if not labels[i]]
    vocabulary = {w for i in learnt for w in bag[i]}

    def weight(w):
        a, b = sum(w in bag[i] for i in pos), sum(w in bag[i] for i in neg)
        n, both = len(learnt), a + b
        under = math.sqrt(both * (n - both) * len(pos) * len(neg))
        phi = abs(a * len(neg) - b * len(pos)) / under if under and w in vocabulary else 0.0
        return math.log(1 + len(texts) / df[w]) * (0.02 + phi)

    weights = {w: weight(w) for w in df}

    def vector(i):
        v = {w: (1 + math.log(n)) * weights[w] for w, n in bag[i].items()}
        size = math.sqrt(sum(x * x for x in v.values())) or 1
        return {w: x / size for w, x in v.items()}

    examples = {i: vector(i) for i in learnt}
    # Words of no example share hashed counts, which may add up two of them; those texts are compared loosely.
    for i in [*range(0, 420, 7), 900, 901, 902, 903]:
        v = vector(i)
        cos = {e: sum(x * examples[e].get(w, 0) for w, x in v.items()) for e in learnt}
        near = sorted((c for c in cos.values() if c > 1e-9), reverse=True)[:15]
        assert [round(e.similarity, 3) for e in got[i].evidence] == [round(c, 3) for c in near[:3]]
        assert all(abs(cos[e.example] - e.similarity) < 1e-3 and e.toxic == labels[e.example] for e in got[i].evidence)
        best = sorted(((c, e) for e, c in cos.items() if c > 1e-9), reverse=True)[:15]
        if len(best) < 15 or best[-1][0] - sorted(cos.values(), reverse=True)[15] > 1e-6:
            vote = {e: model.vote[list(model.examples).index(e)] for _, e in best}
            num = sum(vote[e] * c * c * labels[e] for c, e in best) + 0.15 * len(pos) / len(learnt)
            den = sum(vote[e] * c * c for c, e in best) + 0.15
            assert abs(got[i].score - model.calibrated(num / den)) < 1e-3
    assert got[903].score > 0.5 and got[902].score == got[901].score == got[900].score < 0.5


def test_held_out_labels(spark):
    """Planted: toxic documents hold words of a small set, or words with a prefix."""
    rng = np.random.default_rng(4)
    vocab = [f"w{''.join(rng.choice(list('abcdefgh'), 5))}" for _ in range(400)]
    rows, labels = [], []
    for i in range(1500):
        words = list(rng.choice(vocab, 80))
        toxic = int(rng.random() < 0.15)
        if toxic:
            for _ in range(4):
                words[rng.integers(80)] = rng.choice(["scumbag,", "Vileword", "rotten!"]) if i % 2 else "grumpf" + "".join(rng.choice(list("aeiou"), 4))
        rows.append((i, " ".join(words), 0.5))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = X.fit(docs, known)
    got = {r.doc_id: r for r in X.score(docs, model).collect()}
    held = [i for i in range(1500) if zlib.crc32(str(i).encode()) % 5 == 0]
    right = [(got[i].score >= 0.5) == bool(labels[i][1]) for i in held]
    assert np.mean(right) > 0.99 and all(0 <= r.score <= 1 for r in got.values())
    assert not set(model.examples) & set(held)
    assert all(e.toxic == labels[e.example][1] for r in got.values() for e in r.evidence)
    kept = X.keep_clean(docs, known)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.score < 0.5}


def test_every_telling_term_is_kept(spark):
    """The word of few toxic texts counts however many stronger words there are."""
    rng = np.random.default_rng(7)
    strong = ["".join(rng.choice(list("abcdefghijklm"), 9)) for _ in range(400)]  # six terms each
    rows = [(i, " ".join(strong), 1) for i in range(80)] + [(i, f"grumble n{i}", 1) for i in range(80, 110)] + [(i, f"plain text m{i} as it is", 0) for i in range(110, 500)]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5] + [(1000, "they grumble here", None)]
    docs = spark.createDataFrame([(i, f"{t} {i}") for i, t, _ in rows], "doc_id long, text string")
    model = X.fit(docs, spark.createDataFrame([(i, x) for i, _, x in rows if x is not None], "doc_id long, toxic int"))
    assert len(model.vectors.terms) > 2000
    got = {r.doc_id: r for r in X.score(docs, model).collect()}
    assert got[1000].score >= 0.5 and got[1000].evidence[0].toxic == 1 and got[1000].evidence[0].similarity > 0.5


def test_edge_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (4, "x " * 50_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in X.score(docs, X.fit(docs, none)).collect()} == {0.0}
    one = spark.createDataFrame([(1, 1), (2, None), (3, 7), (None, 1)], "doc_id long, toxic int")
    assert X.score(docs, X.fit(docs, one)).count() == 6
    assert X.score(docs.limit(0), X.fit(docs.limit(0), none)).count() == 0
    assert X.keep_clean(docs, none).count() == 6


def test_documents_whole(spark):
    sf = "/root/testdata/sf0.01"
    got = X.op5_toxicity(spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(got) == docs.count() and got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    assert {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in docs.select("doc_id").collect()} == dict(zip(got.doc_id, got.held_out))
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(X.held_out(F.col("doc_id"))).toPandas().merge(got, on="doc_id")
    assert (labels.toxic == labels.predicted).mean() > 0.9


def test_freed_memory_is_given_back():
    import re
    import subprocess
    import sys

    program = """
import re
from tidemark.llm.shared import give_back
held = lambda: int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024
kept = [bytes(60_000) for _ in range(2_000)]
kept = kept[::100]
before = held()
give_back()
print(before, held())
"""
    before, after = map(int, re.findall(r"\d+", subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, check=True).stdout)[-2:])
    assert after < before - 60
