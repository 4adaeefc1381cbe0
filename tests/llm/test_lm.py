import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa

from tidemark.llm import lm as L
from tidemark.llm.bytes import chunks

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    tokens = [WORD.findall((t or "").translate(LOWER)) + [None] for _, t in rows]
    c = collections.Counter()
    for (d, _), w in zip(rows, tokens):
        if d is None or zlib.crc32(str(d).encode()) % 5 != 1:
            c.update(w)
    n, v = sum(c.values()), len(c)
    return [(d, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)) for (d, _), w in zip(rows, tokens)]


def compare(spark, rows, settings):
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, token int")
    model, counts = L.fit(docs, settings)
    got = sorted(L.score(docs, model, counts).collect(), key=repr)
    want = sorted(brute(rows), key=repr)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (repr(r.doc_id), r.n_tokens)), sorted(want, key=lambda r: (repr(r[0]), r[1]))):
        assert (g.doc_id, g.n_tokens, g.n_known, model.n) == w[:4] and abs(g.base_score - w[4]) < 1e-6
        assert g.score <= 1e-9 and math.isfinite(g.score)
    return model


ROWS = [(i, f"the cat {i} sat On the mat {i % 7}\n é{i % 3}") for i in range(300)] + [(900, None), (901, ""), (902, " \n"), (None, "the cat"), (3, "again"), (903, "zz " * 60_000)]


def test_counts_and_base_score(spark):
    compare(spark, ROWS, L.Settings(rounds=1, shares=2))
    compare(spark, ROWS, L.Settings(rounds=1, shares=2, frequent=5))  # most words through the join
    compare(spark, [(1, "a"), (2, "b b")], L.Settings(rounds=1, shares=1))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    model, counts = L.fit(docs)
    assert model.n == 0 and L.score(docs, model, counts).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    only = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    model, counts = L.fit(only)
    r = L.score(only, model, counts).first()
    assert (r.n_tokens, r.n_known) == (3, 0) and math.isfinite(r.score) and math.isfinite(r.base_score)


def test_model_is_a_distribution(spark):
    """Class probabilities add up to one, so do a class' leaves, and the words of a hashed leaf with its unknown word."""
    model = compare(spark, ROWS, L.Settings(rounds=3, shares=2))
    for _, _, buf, at in chunks(pa.array([t for _, t in ROWS[:50]])):
        h, bins, first = L.tokens(buf, at)
        history = model.history(h, first)
        k, leaf, _ = model.outcomes(h, bins)
        assert k.max() < L.CLASSES and leaf.max() < L.LEAVES
        assert np.allclose(model.probabilities(model.class_rows(history)).sum(axis=1), 1, atol=1e-5)
        p = model.probabilities(model.leaf_rows(history, k))
        assert np.allclose(p.sum(axis=1), 1, atol=1e-5)
        named = {tuple(x) for x in np.stack((model.outcome // L.LEAVES, model.outcome % L.LEAVES), axis=1)}
        for i, kind in enumerate(k):  # a leaf without a word is never likely
            if kind >= L.SINGLE:
                assert all(p[i, j] < 1e-9 for j in range(L.OWN) if (kind, j) not in named)
    words = {}
    for _, _, buf, at in chunks(pa.array([t for d, t in ROWS if d is None or zlib.crc32(str(d).encode()) % 5 != 1])):
        h, bins, _ = L.tokens(buf, at)
        k, leaf, own = model.outcomes(h, bins)
        for x, kind, j, mine, b in zip(h, k, leaf, own, bins):
            words.setdefault((kind, j, bool(mine), int(b) if not mine else -1), collections.Counter())[x] += 1
    for (_, j, mine, b), c in words.items():
        if mine:
            assert len(c) == 1
        else:
            assert j >= L.OWN and model.bin_n[b] == sum(c.values()) and model.bin_v[b] == len(c)
            total = model.bin_n[b] + 0.5 * (model.bin_v[b] + 1)
            assert abs((sum(c.values()) + 0.5 * len(c) + 0.5) / total - 1) < 1e-12


def brute_score(model, text, counts):
    """log10 of the model's probability of a text, token by token, from the weights alone."""
    [(_, _, buf, at)] = list(chunks(pa.array([text or ""])))
    h, bins, first = L.tokens(buf, at)
    outcome = dict(zip(map(int, model.named), map(int, model.outcome)))
    mixed = lambda x: int(L.mix(np.array([x & (1 << 64) - 1], np.uint64))[0])
    total = 0.0
    for i in range(len(h)):
        one = int(h[i - 1]) if i >= 1 else 1
        two = int(h[i - 2]) if i >= 2 else 2
        history = [mixed(one), mixed(two ^ 0x51), mixed(one * 3 + mixed(two))]
        of = outcome.get(int(h[i]), (L.SINGLE + int(bins[i]) // L.HASHED) * L.LEAVES + L.OWN + int(bins[i]) % L.HASHED)
        k, leaf = divmod(of, L.LEAVES)
        rows = [int(L.STARTS[j]) + (x >> (64 - L.BITS[j])) for j, x in enumerate(history)] + [L.BIAS]
        z = model.weights[rows].astype(float).sum(axis=0)
        total += (z[k] - z.max() - math.log(np.exp(z - z.max()).sum())) / math.log(10)
        if k >= L.SINGLE:
            spread = mixed(k + 0x636C617373)
            rows = [int(L.STARTS[len(L.BITS) + j]) + (mixed(x ^ spread) >> (64 - L.LEAF_BITS[j])) for j, x in enumerate(history)] + [L.BIAS + 1 + k]
            z = model.weights[rows].astype(float).sum(axis=0)
            total += (z[leaf] - z.max() - math.log(np.exp(z - z.max()).sum())) / math.log(10)
        if int(h[i]) not in outcome:
            b = int(bins[i])
            total += math.log10((counts.get(int(h[i].view(np.int64)), 0) + 0.5) / (model.bin_n[b] + 0.5 * (model.bin_v[b] + 1)))
    return total


def test_scores_are_those_of_a_brute_force_model(spark):
    texts = {d: t for d, t in ROWS[:60] + ROWS[300:305]} | {905: "never seen words the mat"}
    for frequent in (400_000, 5):
        docs = spark.createDataFrame(ROWS + [(905, texts[905])], "doc_id long, text string")
        model, counts = L.fit(docs, L.Settings(rounds=2, shares=4, frequent=frequent))
        known = {r.token: r.c for r in counts.collect()}
        got = {r.doc_id: r.score for r in L.score(docs.where("text is null or length(text) < 1000"), model, counts).collect()}
        for d, t in texts.items():
            if d != 3:  # that id has two texts
                assert abs(got[d] - brute_score(model, t, known)) < 1e-3, d


def test_scores_follow_their_rows_through_any_plan(spark):
    """A repartitioned, joined or united input gets the scores of its texts, row by row."""
    docs = spark.createDataFrame([(i, f"word{i} " * (i % 17 + 1) + f"and more of it {i % 5}", i % 3) for i in range(600)], "doc_id long, text string, extra int")
    model, counts = L.fit(docs, L.Settings(rounds=1, shares=1, frequent=50))
    want = {r.doc_id: (r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 3)) for r in L.score(docs.coalesce(1), model, counts).collect()}
    assert len(want) == 600 and len({w[2] for w in want.values()}) > 50
    left, right = docs.select("doc_id", "extra"), docs.select("doc_id", "text")
    for plan in (docs.repartition(16), left.join(right, "doc_id"), docs.where("extra = 0").union(docs.where("extra <> 0")), docs.distinct()):
        got = {r.doc_id: (r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 3)) for r in L.score(plan, model, counts).collect()}
        assert got == want
    twice = L.score(docs.union(docs), model, counts).collect()
    assert len(twice) == 1200 and all((r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 3)) == want[r.doc_id] for r in twice)


def test_equal_histories_are_worked_out_once(monkeypatch):
    """Copies of a text cost a round one softmax for each different history, and count as often as they occur."""
    text = " ".join(f"w{i % 40} the" for i in range(300))
    [counts] = L.count_tokens([pa.RecordBatch.from_arrays([pa.array([text] * 50)], ["text"])])
    h, c, of = (x.to_numpy() for x in counts.columns)
    bins = {int(b): (int(c[of == b].sum()), int((of == b).sum())) for b in np.unique(of)}
    model = L.start(dict(zip(h.view(np.uint64).tolist(), of.tolist())), bins, int(c.sum()), len(h), h.view(np.uint64), c)
    worked = []
    real = L.Model.probabilities
    monkeypatch.setattr(L.Model, "probabilities", lambda m, rows, *more: worked.append(len(rows)) or real(m, rows, *more))
    [out] = L.slopes(model, [pa.RecordBatch.from_arrays([pa.array([text] * 50)], ["text"])])
    assert sum(worked) < 0.02 * model.n
    got = np.zeros((-(-L.ROWS // L.BLOCK) * L.BLOCK, 2 * L.LEAVES))
    for block, sums in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
        piece = L.unpacked(sums)
        got[block * L.BLOCK : block * L.BLOCK + len(piece)] = piece
    want = np.zeros((len(got), 2, L.LEAVES))
    [(_, _, buf, at)] = chunks(pa.array([text]))
    h, bins, first = L.tokens(buf, at)
    k, leaf, _ = model.outcomes(h, bins)
    history, many = model.history(h, first), k >= L.SINGLE
    for rows, target in ((model.class_rows(history), k), (model.leaf_rows([x[many] for x in history], k[many]), leaf[many])):
        p = real(model, rows)
        for r, t, x in zip(rows, target, p):
            want[r, 0] += 50 * x
            want[r, 1, t] += 50
    assert np.allclose(got, want.reshape(len(got), -1), rtol=2e-3, atol=0.05)


def test_sums_by_row():
    r = np.random.default_rng(4)
    for rows in (np.zeros(0, np.int32), np.full(9, 3, np.int32), r.integers(0, 30, 500).astype(np.int32), np.sort(r.integers(0, 30, 500)).astype(np.int32), np.arange(40, dtype=np.int32)):
        p, sums, want = r.random((len(rows), 5)), np.ones((40, 5)), np.ones((40, 5))
        L.grouped(sums, rows, p)
        np.add.at(want, rows, p)
        assert np.allclose(sums, want)


def test_rounds_take_every_training_row(spark, monkeypatch):
    """Each training token is observed once over all rounds, and copies of one text aren't all in one round."""
    rows = [(i, f"w{i} x y") for i in range(200)] + [(i, "copy of one text") for i in range(200, 400)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    observed = []
    real = L.stepped
    monkeypatch.setattr(L, "stepped", lambda w, e, o, s: (observed.append(o[L.BIAS].sum()), real(w, e, o, s))[1])
    model, _ = L.fit(docs, L.Settings())
    assert len(observed) == L.Settings().rounds and abs(sum(observed) - model.n) < 1e-2 * model.n
    got = docs.where("text like 'copy%'").groupBy(L.in_round(L.Settings()).alias("r")).count().collect()
    assert len(got) == L.Settings().rounds and max(r["count"] for r in got) < 100


def test_packed_sums_keep_their_size():
    block = np.abs(np.random.default_rng(1).normal(size=(64, 2 * L.LEAVES))) * np.logspace(-3, 7, 64)[:, None]
    back = L.unpacked(L.packed(block))
    assert np.allclose(back, block, rtol=1e-3, atol=block.max(axis=1, keepdims=True) * 1e-6)
    assert (L.unpacked(L.packed(np.zeros((64, 2 * L.LEAVES)))) == 0).all()


def test_better_than_the_base_on_held_out_texts(spark):
    got = L.op8_lm_scoring(spark, "/root/testdata/sf0.01").toPandas()
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum() and held.n_known.lt(held.n_tokens).any()
    assert set(got.doc_id[got.held_out]) == {d for d in got.doc_id if zlib.crc32(str(d).encode()) % 5 == 1}


def test_documents_whole(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: r for r in L.op8_lm_scoring(spark, sf).collect()}
    for d, n, known, train, base in brute(rows):
        assert (got[d].n_tokens, got[d].n_known, got[d].train_tokens) == (n, known, train) and abs(got[d].base_score - base) < 1e-6
