import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import jaccard as J
from tidemark.llm.bytes import chunks, mix, spans
from tidemark.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[i : i + 5]) for i in range(len(w) - 4)))


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    root = {d: d for d, _ in sets if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return sorted(((d, len(x), None if d is None else find(d)) for d, x in sets), key=repr)


def check(spark, rows, **plan):
    df = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, n int, key string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(df, plan=J.Plan(**plan)).collect()), key=repr)
    assert got == brute(rows)


def edited(rng, words, share):
    return [rng.choice("pqrstuv") + str(rng.random())[2:5] if rng.random() < share else w for w in words]


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(20_000))
    check(spark, [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A B"), (6, "a b c d e"), (7, "a b c d e"), (8, long), (9, long + " x"), (10, "É b"), (11, "é b"), (None, "a b"), (12, "a b"), (13, "a b c d"), (4, "a b")])
    check(spark, [(5, "k l m n o p"), (5, "a b c d e f"), (2, "a b c d e f"), (9, "k l m n o p"), (9, "z z z")])
    df = spark.createDataFrame([], "doc_id long, text string")
    assert J.near_duplicates(df).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_near_copies_of_all_sizes(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(25):
        base = [rng.choice("abcdefghij") * rng.randint(1, 3) + str(rng.randint(0, 400)) for _ in range(rng.choice([4, 5, 6, 8, 12, 20, 40, 80, 200, 600]))]
        rows.append(base)
        for _ in range(rng.randint(1, 6)):
            rows.append(edited(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.04])))
        if rng.random() < 0.5:
            rows.append(base[rng.randint(0, 3) :] + ["tail"] * rng.randint(0, 2))
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    check(spark, [(i, " ".join(w)) for i, w in zip(ids, rows)])


def test_chains_and_shared_passages(spark):
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"x{i}_{k}" for k in range(rng.randint(8, 40))])) for i in range(120)]
    base = [f"c{k}" for k in range(150)]
    for i in range(60):  # every text links with the next only
        base = base[2:] + [f"d{i}_0", f"d{i}_1"] if i % 2 else [f"e{i}"] + base[1:]
        rows.append((1000 - i, " ".join(base)))
    check(spark, rows)


def template_rows(rng, n, share):
    """Texts that share a passage, each in a copy with a few edits now and then."""
    passage = [f"p{i}" for i in range(int(160 * share))]
    rows = []
    for i in range(n):
        own = [f"x{i}_{k}" for k in range(160 - len(passage))]
        rows.append((2 * i, " ".join(passage + own)))
        if i % 7 == 0:
            rows.append((2 * i + 1, " ".join(passage + own[:-6] + ["edit"] * 6)))
    return rows


@pytest.mark.parametrize("hot", [0, 1, 5])
def test_hot_lists_lose_no_link(spark, hot):
    rng = random.Random(8)
    rows = template_rows(rng, 60, 0.6) + [(1000 + d, t) for d, t in template_rows(rng, 40, 0.86)]
    check(spark, rows, hot=hot)
    test_near_copies = [rng.choice("abcdefghij") + str(rng.randint(0, 60)) for _ in range(100)]
    check(spark, [(i, " ".join(edited(rng, test_near_copies, 0.02))) for i in range(60)], hot=hot)


def test_work_of_a_template_grows_in_proportion(spark, monkeypatch):
    """Twice the texts of a template give about twice the candidates, not four times."""
    counts = []
    real = J.verify
    monkeypatch.setattr(J, "verify", lambda pairs, docs, plan, label: (counts.append((label, pairs.count())), real(pairs, docs, plan, label))[1])
    for n in (150, 300):
        df = spark.createDataFrame(template_rows(random.Random(1), n, 0.75), "doc_id long, text string")
        J.near_duplicates(df, plan=J.Plan(hot=20)).count()
    rest = [c for label, c in counts if label == "rest"]
    assert rest[1] <= 3 * max(rest[0], 10) and rest[1] < 300


def near_copies(rng, n, most):
    """A text and copies of it, each with up to ``most`` words changed, left out or put in."""
    base = [f"b{i}" for i in range(150)]
    rows = []
    for d in range(n):
        words = list(base)
        for _ in range(rng.randint(0, most) if d else 0):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice(([], ["e" + str(rng.randint(0, 9))], [f"e{d}", words[at]]))
        rows.append((d, " ".join(words)))
    return rows


@pytest.mark.parametrize("hot", [0, 3, 40])
def test_hot_lists_of_near_copies_of_all_sizes_lose_no_link(spark, hot):
    rng = random.Random(hot)
    check(spark, near_copies(rng, 150, 9) + [(500 + d, t + " " + " ".join(f"t{i}" for i in range(d % 40))) for d, t in near_copies(rng, 80, 4)], hot=hot)


def test_a_large_group_of_near_copies_gives_few_candidates(spark, monkeypatch):
    """What all copies share brings together only those that differ in little enough to link."""
    counts = []
    real = J.by_prefix
    monkeypatch.setattr(J, "by_prefix", lambda *a: (found := real(*a), counts.append(found.count()))[0])
    rows = near_copies(random.Random(3), 400, 8)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in J.near_duplicates(df, plan=J.Plan(hot=20)).collect()} == {d: c for d, _, c in brute(rows)}
    assert counts and counts[0] < 10 * len(rows)


def test_the_last_salt_is_enough_for_any_set(spark, monkeypatch):
    monkeypatch.setattr(J, "SALTS", 1)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(90)]
    docs = [(i, " ".join(edited(rng, base, 0.02))) for i in range(20)] + [(100 + i, f"a{i} b c d e f"[: 3 + i]) for i in range(8)]
    sets = [(d, shingles(t)) for d, t in docs]
    for _, _, buf, at in chunks(pa.array([t for _, t in docs])):
        s, ends = J.sets_of(buf, at, 5)
        n = np.diff(ends)
        plan = J.Plan()
        bands = plan.bands(int(n.max()))
        band = np.searchsorted(bands, np.maximum(n, 1), "right") - 1
        m, deep = plan.segments(bands, band, 0)
        owner, seg, a, z, _, _ = J.cut(s, ends, m, 0, band)
        assert (J.weights(owner, seg, z - a, deep, len(n)) >= plan.errors(n) + 1).all() and [len(x) for _, x in sets] == n.tolist()


def test_threshold_is_exact(spark):
    """Sets whose Jaccard similarity is 0.8 exactly link, those just below don't."""
    words = [f"w{i}" for i in range(400)]
    rows = []
    for k, n in enumerate((4, 8, 12, 40, 80, 200)):
        one = words[: n + 4]
        rows += [(10 * k + 1, " ".join([f"k{k}", *one])), (10 * k + 2, " ".join([f"k{k}", *one, *[f"t{k}_{i}" for i in range((n + 1) // 4)]])), (10 * k + 3, " ".join([f"k{k}", *one, *[f"u{k}_{i}" for i in range((n + 1) // 4 + 1)]]))]
    check(spark, rows)


def test_no_link_is_lost_by_the_partition():
    """Every linked pair shares a list among those that the smaller set looks into, for all its slack."""
    rng = np.random.default_rng(1)
    plan = J.Plan()
    for n in [1, 2, 3, 4, 5, 7, 9, 13, 30, 77, 200]:
        for _ in range(6):
            x = np.unique(mix(rng.integers(0, 1 << 62, n).astype(np.uint64)))
            most = len(x) * 5 // 4 - len(x)
            y = np.unique(np.concatenate((x, mix(rng.integers(0, 1 << 62, rng.integers(0, most + 1)).astype(np.uint64)))))
            bands = plan.bands(len(y) + 1)
            band = np.array([np.searchsorted(bands, len(x), "right") - 1])
            m, deep = plan.segments(bands, band)
            owner, seg, a, z, sums, _ = J.cut(x, np.array([0, len(x)]), m, 0, band)
            w = J.weights(owner, seg, z - a, deep, 1)[0]
            if w < plan.errors(np.array([len(x)]))[0] + 1:
                continue  # another salt is taken then
            _, seg2, a2, z2, sums2, _ = J.cut(y, np.array([0, len(y)]), m, 0, band)
            mine, other = dict(zip(seg, sums)), dict(zip(seg2, sums2))
            assert len(y) - len(x) <= plan.errors(np.array([len(x)]))[0]
            assert any(other.get(k) == v for k, v in mine.items())


def test_parity_maps_bound_the_difference():
    rng = np.random.default_rng(2)
    x, y = (np.unique(mix(rng.integers(0, 300, k).astype(np.uint64))) for k in (120, 150))
    maps = np.array(J.parity(np.concatenate((x, y)), np.array([0, len(x), len(x) + len(y)]))).view(np.uint64)
    assert sum(int(a ^ b).bit_count() for a, b in maps) <= len(set(x) ^ set(y))


def test_words_are_split_as_the_contract_says():
    texts = ["a b\tc\nd", "", "x y z", None, " lead trail "]
    got = []
    for _, _, buf, at in chunks(pa.array(texts)):
        s, e, first = spans(buf, at)
        got += [[bytes(buf[a:b]).decode() for a, b in zip(s[i:j], e[i:j])] for i, j in zip(first[:-1], first[1:])]
    assert got == [WORD.findall(t or "") for t in texts]
    assert [len(list(chunks(pa.array(["é" * 10] * 7), 25))), len(list(chunks(pa.array(texts).slice(2, 2))))] == [7, 1]


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(500, x) for x in range(501, 600)] + [(7, 7)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_of_repeated_rows(spark):
    rows = [(1, "a b c d e f", 1), (1, "a b c d e f", 2), (2, "a b c d e f", 3), (3, None, 4), (3, None, 5), (None, "a b c d e f", 6), (None, "a b c d e f", 7)]
    got = J.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, k int")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got) == [(False, 1, "a b c d e f"), (False, 3, ""), (False, 3, ""), (True, 0, "a b c d e f"), (True, 0, "a b c d e f")]


def test_one_of_each(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("source", "component_id")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {d for d, n, c in brute(rows) if d == c}
    got = J.one_of_each(docs)
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == want
    small = J.one_of_each(docs, plan=J.Plan(most_broadcast=0))  # by shuffles
    assert {r.doc_id for r in small.collect()} == want


def test_columns_of_any_name_stay(spark):
    """Names that the operator uses itself, with points or in another case, are kept as they are."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, 5, 6, 7, 8), (2, text, 5, 6, 7, 8), (1, text, 5, 6, 7, 9), (3, "other words that stand alone here", 1, 2, 3, 4), (None, text, 0, 0, 0, 0)]
    df = spark.createDataFrame(rows, ["doc_id", "text", "__key", "key", "key_", "a.b"])
    out = J.one_of_each(df)
    assert out.columns == df.columns
    got = sorted(map(tuple, out.collect()), key=str)
    assert [r[0] for r in got] == [1, 3, None] and got[0][1] == text
