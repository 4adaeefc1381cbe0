import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import search as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string, score string, item int", "item_id long, text string, doc_id int"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=50, once=True):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, bag in asked.items():
        rows = []
        for i, b in bags:
            if i is None or not b:
                continue
            m = 50 + (50 * sum(b.values()) * n_docs) // total
            w = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(w(t) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 20 * m)) * (1 if once else q) for t, q in bag.items() if t in b)
            if score > 0:
                rows.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(rows)[:k])]
    return sorted(out)


def made(seed):
    r = random.Random(seed)
    words = ["Alpha", "beta", "gamma's", "Ünicode", "x1", "日本", "the", "of", "a-b", "É"]
    text = lambda n: " ".join(r.choice(words) for _ in range(r.randrange(n)))
    docs = [(r.choice([i, i, None]), r.choice([text(30), text(30), "", None, "...!"])) for i in range(120)]
    items = [(i, text(8)) for i in range(12)] + [(3, "the the beta"), (None, "the"), (50, None), (51, "nothing-known"), (0, "Alpha alpha")]
    return docs + docs[:15], items


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS).repartition(5), spark.createDataFrame([(*i, 7) for i in items], ITEMS)


def rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()))


@pytest.mark.parametrize(("seed", "once", "pairs"), [(1, True, 500_000), (2, False, 9)])
def test_ranks_are_those_of_brute_force(spark, seed, once, pairs):
    """Also with items in several blocks, and with an item's repeated terms counted."""
    docs, items = made(seed)
    assert rows(S.search(*frames(spark, docs, items), k=7, once=once, most_pairs=pairs)) == brute(docs, items, 7, once)


def test_ties_and_blocks_of_documents(spark):
    """Very many copies score the same: the smaller ids are kept whatever task they come from."""
    docs = [(i, "same words here") for i in range(5000, 0, -1)] + [(9000, "same same"), (9001, "other")]
    items = [(1, "Same"), (2, "words here other")]
    got = rows(S.search(*frames(spark, docs, items), k=5))
    assert got == brute(docs, items, 5)


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b")], [(1, "a")])
    assert rows(S.search(docs.limit(0), items)) == [] and rows(S.search(docs, items.limit(0))) == []
    assert rows(S.search(docs.select("doc_id", "text").limit(0), items.limit(0))) == []


@pytest.mark.parametrize("text", ["word, " * 3000, "x" * 9000 + " y", "é" * 4000, "-" * 5000 + "a b"], ids=["words", "one word", "letters of two bytes", "no terms"])
def test_long_texts_are_cut_between_terms(text):
    """In pieces, a text has the same terms as whole."""
    buf = np.frombuffer(text.encode(), np.uint8)
    parts = [bytes(p) for _, p, _ in S.cut(buf, np.array([0, len(buf)]), 500)]
    assert b"".join(parts) == text.encode()
    assert [t for p in parts for t in terms(p.decode())] == terms(text)
    whole = [h for _, x in S.terms(pa.array([text])) for h in x.tolist()]
    assert len(whole) == len(terms(text))


def test_scores_are_whole_numbers_of_any_size():
    value = S.impacts(np.array([0]), np.array([10**6]), np.array([10**7]), np.array([30_000]), 10**9, 10**12)
    assert value.dtype == np.int64 and value[0] == 30_000 * ((10**9 * 10**6) // (1000 * 10**6 + 20 * (50 + 50 * 10**7 * 10**9 // 10**12)))
