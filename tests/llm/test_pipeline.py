import hashlib

import numpy as np
from test_jaccard import brute as near
from test_quality import brute as measured

import corpus_pipeline as C
from tidemark.llm import decontaminate, quality, tokens, toxicity


def test_stages_and_run(spark):
    """Each stage against a brute-force version of its decisions over all that the stage before kept."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["quality_rules", "toxicity", "near_duplicates", "decontamination", "encoding"]
    held = docs
    for name, stage in C.STAGES:
        rows = {r.doc_id: r.text for r in held.collect()}
        out = stage(spark, held, sf)
        if name == "encoding":
            final = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.round_trips) for r in out.collect()}
            for d, t in rows.items():
                ids = tokens.encoding().encode_ordinary(t)
                assert final[d] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), True)
            continue
        assert out.columns == docs.columns
        kept = {r.doc_id for r in out.collect()}
        if name == "quality_rules":
            assert not any(measured(rows[d])[5] for d in kept) and kept == {r.doc_id for r in quality.measure(held).where("kept").collect()}
        elif name == "toxicity":
            model = toxicity.fit(held.select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"))
            assert kept == {r.doc_id for r in toxicity.score(held, model).where("score < 0.5").collect()}
        elif name == "near_duplicates":
            assert kept == {d for d, _, c in near(list(rows.items())) if d == c}
        else:
            assert kept == rows.keys() - {r.doc_id for r in decontaminate.contaminated(held, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
        held = spark.createDataFrame(out.collect(), docs.schema)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.round_trips) for r in C.run(spark, sf).collect()} == final


def test_stages_take_empty_and_odd_tables(spark, sf):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in ([], [(1, None, None, None, None), (None, "a b", "x", "y", 1), (2, "", "x", "y", 0)]):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in C.STAGES:
            assert stage(spark, docs, sf).count() <= len(rows)
