import re

import pytest

from tidemark.llm import decontaminate as D
from tidemark.llm.bytes import word_bytes

ITEM = "Yesterday Kim bought 2 apples for 99 cents each and gave 1 of them to Max before Kim went home by the old train."
FILL = "Some other text stands before it and more of the same kind. "


def brute_words(text):
    return re.findall(r"[^\W_]+", text.lower())


def pairs(spark, docs, items, **args):
    d = spark.createDataFrame([(i, t, 1.0, "s") for i, t in docs], "doc_id long, text string, share double, slots string")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, hash string")
    return {(r.doc_id, r.item_id): r for r in D.contaminated(d, b, D.Settings(**args)).collect()}


def test_reparameterised(spark):
    docs = [
        (1, FILL + ITEM),
        (2, FILL + ITEM.replace("Kim", "Bob Miller").replace("Max", "Lisa").replace("2 apples", "40 apples").replace("99 cents", "7.5 euros").replace("1 of", "nine of")),
        (3, ITEM.replace("before Kim", "before Eve")),  # one changed name leaves the passage
        (5, ITEM.upper()),  # shouted, but the same question
        (6, FILL * 20),
        (7, ITEM.replace("apples", "pears").replace("gave", "sold").replace("train", "bus")),
        (8, " ".join(ITEM.split()[:7])),
        (9, "\n".join([ITEM] * 3)),
    ]
    got = pairs(spark, docs, [(50, ITEM)])
    assert {d for d, _ in got} - {7} == {1, 2, 3, 5, 9}
    assert got[1, 50].verbatim and not got[2, 50].verbatim and got[1, 50].share == got[2, 50].share == 1.0


def test_slots_must_be_consistent(spark):
    item = "then when {0} met {1} at noon and {0} told {1} that later {0} would see {1} at home before {0} left {1} there"
    names = "Ann Bob Cid Dot Eve Fay Gus Hal".split()
    scattered = item
    for n in names:  # the same name becomes another one each time
        k = min(i for i in (scattered.find("{0}"), scattered.find("{1}")) if i >= 0)
        scattered = scattered[:k] + n + scattered[k + 3 :]
    docs = [(1, item.format("Kim", "Max")), (2, item.format("Ann", "Bob")), (3, scattered), (4, item.format("Ann", "Ann")), (5, FILL + "where " + item.format("Kim", "Max"))]
    got = pairs(spark, docs, [(50, item.format("Kim", "Max"))])
    assert {d for d, _ in got} == {1, 2, 5} and not got[2, 50].verbatim


def test_few_literal_words(spark):
    """Items and windows of numbers and names are found word by word; short items of three literal words with other values too."""
    dense = "Add 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15"
    items = [(1, "What is 17 times 23?"), (2, "12 + 7 = 19"), (3, dense)]
    docs = [(1, FILL + "What is 17 times 23? " + FILL), (2, FILL + "12 + 7 = 19"), (3, FILL + dense), (4, "what is 5 times 6"), (5, "13 + 8 = 21"), (6, FILL + dense.replace("1", "3")), (7, FILL * 3)]
    got = pairs(spark, docs, items)
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 1)}
    assert got[1, 1].verbatim and got[2, 2].verbatim and got[3, 3].verbatim and not got[4, 1].verbatim


NAMES = "Kim Max Ann Bob Cid Dot Eve Fay Gus Hal Ian Jo Lea Mia Ned Ora".split()


def brute_found(doc, item, width=8, least=0.25, consistent=0.67):
    """Whether a lower-cased template of one holds the other: windows by hand, a slot at a time."""

    def template(text):
        out, opens = [], True
        for m in re.finditer(r"\w+|[.!?]", text):
            w = m[0]
            if w in ".!?":
                opens = True
                continue
            kind = "N" if w.isdigit() else "U" if w.lower() in ("apples", "km", "miles") and w.lower() in D.UNITS else "P" if w[0].isupper() and not opens else ""
            if not (kind == "P" and out and out[-1][0] == "P" and not opens):
                out.append((kind, w.lower()))
            opens = False
        return out

    a, b = template(doc), template(item)
    windows = lambda t: [(i, tuple(k or w for k, w in t[i : i + width])) for i in range(len(t) - width + 1)]
    where = {}
    for i, w in windows(b):
        where.setdefault(w, []).append(i)
    shifts = {}
    for i, w in windows(a):
        for j in where.get(w, ()):
            shifts.setdefault(i - j, []).append((i, j))
    places = set()
    for found in shifts.values():
        zs = {j: [(b[j + k][1], a[i + k][1]) for k in range(width) if b[j + k][0]] for i, j in found}
        count = {}
        for z in zs.values():
            for p in z:
                count[p] = count.get(p, 0) + 1
        ties = lambda p: [q for q in count if q != p and (q[0] == p[0] or q[1] == p[1]) and count[q] >= count[p]]
        assert all(count[q] > count[p] for p in count for q in ties(p))  # the texts have no ties
        ok = [j for j, z in zs.items() if not any(ties(p) for p in z)]
        if len(ok) >= consistent * len(zs):
            places |= set(ok)
    return len(places) >= least * (len(b) - width + 1)


def test_planted_items_with_other_values(spark):
    """Many items re-parameterised, with consistent and with mixed-up values, against a brute-force version."""
    import random

    rng = random.Random(4)
    words = [f"w{a}{b}" for a in "abcdefgh" for b in "klmnopq"]
    word = lambda: "".join(c for c in rng.choice(words) if not c.isdigit())
    items, docs = [], []
    for k in range(30):
        body = [rng.choice(["{a}", "{b}", "{n}"]) if rng.random() < 0.25 else word() + word() for _ in range(40)]
        body[0] = "given"
        text = " ".join(body)
        make = lambda a, b, n: text.replace("{a}", a).replace("{b}", b).replace("{n}", str(n))
        items.append((k, make("Kim", "Max", 7)))
        docs.append((10 * k, make("Kim", "Max", 7)))
        docs.append((10 * k + 1, "Some words stand here first . " + make(*rng.sample(NAMES, 2), rng.randint(10, 99))))
        mixed = text
        while "{" in mixed:
            at = mixed.index("{")
            mixed = mixed[:at] + (str(rng.randint(100, 10**6)) if mixed[at + 1] == "n" else rng.choice(NAMES) + rng.choice("abcdefg") * 3) + mixed[at + 3 :]
        docs.append((10 * k + 2, mixed))
    got = set(pairs(spark, docs, items))
    compared = 0
    for d, t in docs:
        for k, item in items:
            if d // 10 != k:
                assert (d, k) not in got
                continue
            try:
                want = brute_found(t, item)
            except AssertionError:
                continue  # ties are broken by hashes
            compared += 1
            assert ((d, k) in got) == want, (t, item)
    assert compared >= 60 and {10 * k for k in range(30)} | {10 * k + 1 for k in range(30)} <= {d for d, _ in got}


def test_weak_windows_take_nothing_away(spark):
    """An item mostly of numbers is still found by its worded windows alone when the numbers differ."""
    numbers = lambda k: " ".join(str(i * k) for i in range(1, 60))
    item = "the red bus drove down the hill to the old town and stopped "
    got = pairs(spark, [(1, item + numbers(7))], [(1, item + numbers(3))])
    assert set(got) == {(1, 1)} and not got[1, 1].verbatim


def test_edge_rows(spark):
    docs = [(1, None), (2, ""), (3, "a"), (None, ITEM), (4, ITEM), (4, ITEM), (5, "x " * 100_000 + ITEM), (6, "red green blue pink grey")]
    got = pairs(spark, docs, [(1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "a"), (5, "red green blue pink grey"), (None, ITEM), (7, "5 km 7 kg 8 cm")])
    assert set(got) == {(4, 1), (5, 1), (6, 5)}  # a word or a few placeholders are no passage
    assert pairs(spark, [], [(1, ITEM)]) == {} and pairs(spark, docs, []) == {}


@pytest.mark.parametrize("text,words", [("a 3.5 b, c.", ["a", "3.5", "b", "c"]), ("1,000,000 x", ["1,000,000", "x"]), ("don’t “quote” «x» y·z", ["don", "t", "quote", "x", "y", "z"]), ("É été Straße", ["É", "été", "Straße"])])
def test_words(text, words):
    import numpy as np

    raw = np.frombuffer(text.encode(), np.uint8)
    mask = word_bytes(raw)
    out = bytes(np.where(mask, raw, 0x20).astype(np.uint8)).decode().split()
    assert out == words


def test_documents_whole(spark):
    """Against a brute-force search for runs of eight words; the items of the tables have no placeholders."""
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: brute_words(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: brute_words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    runs = {}
    for i, w in items.items():
        for k in range(len(w) - 7):
            runs.setdefault(tuple(w[k : k + 8]), set()).add((i, k))
    want = set()
    for d, w in docs.items():
        hits = {}
        for k in range(len(w) - 7):
            for i, p in runs.get(tuple(w[k : k + 8]), ()):
                hits.setdefault(i, set()).add(p)
        want |= {(d, i) for i, ps in hits.items() if len(ps) >= 0.5 * (len(items[i]) - 7)}
    got = {(r.doc_id, r.item_id) for r in D.op7_decontamination(spark, sf).collect()}
    assert got == want and want


def test_decontaminate(spark, sf):
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    bad = {r.doc_id for r in D.contaminated(docs, bench).collect()}
    for settings in (D.Settings(), D.Settings(most_broadcast=0)):
        kept = D.decontaminate(docs, bench, settings)
        assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - bad
