import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import quality as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, where = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            where |= {i + k for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(where), n < 50 or 100 * len(where) > 50 * n)


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
TEXTS = ["", " ", None, "a", "a b c a b c a b c", "x\nx\n\n \nx", "the of and " * 40, "é😀 # | \x0b\x0c\r\t z", "a b   c", "w" * 200_000, " ".join(f"w{i % 5000}" for i in range(20_000)), "a b c d\n" * 3000]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1.0) for i, t in enumerate(texts)], "doc_id long, text string, words string, kept double")


def test_edge_texts(spark):
    texts = [*TEXTS, TEXTS[4], TEXTS[4]]
    got = {r.doc_id: tuple(r[c] for c in BASE) for r in Q.measure(frame(spark, texts)).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert Q.measure(frame(spark, [])).count() == 0


@given(st.lists(st.text(alphabet="ab \n\t#|", max_size=60), min_size=1, max_size=30))
@settings(max_examples=15, deadline=None)
def test_random_texts(spark, texts):
    got = {r.doc_id: tuple(r[c] for c in BASE) for r in Q.measure(frame(spark, texts)).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_filters_stay_above_the_array_expressions(spark):
    plan = Q.measure(frame(spark, TEXTS)).where("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("sort_array") and plan.count("aggregate(") == 1


def test_keep_good_returns_rows_unchanged(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    want = {r.doc_id for r in Q.measure(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want and 0 < len(want) < docs.count()
    assert Q.keep_good(frame(spark, TEXTS)).columns == ["doc_id", "text", "words", "kept"]


def test_no_python_in_the_plan(spark, sf):
    plan = Q.op1_quality_rules(spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_rules_agree_with_labels(spark):
    """Good documents are kept, bad ones are not."""
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in Q.op1_quality_rules(spark, sf).collect()}
    labels = duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall()
    good = [got[d].kept for d, q in labels if q == 1 and not got[d].base_failed]
    bad = [got[d].kept for d, q in labels if q == 0]
    assert sum(good) >= 0.98 * len(good) and not any(bad)


def test_query_equals_sql(spark, sf):
    got = Q.op1_quality_rules(spark, sf)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    cols = ", ".join(got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(f"select {cols} from ({Q.oracle()})").fetchall())
