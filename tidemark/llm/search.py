"""Ranked lexical search: many queries against all documents as a blocked product of sparse integer matrices.

The queries' terms are the inner dimension. Of every block of documents a task makes
the term-document matrix (for each query term the documents that hold it and how often;
other terms only count in lengths) and writes it, so that texts are read once. The
sums of these blocks give the number of documents, their lengths and how many hold each
term. A second pass turns occurrences into 64-bit integer impacts and multiplies each
block by the item-term matrix as Gustavson does: the rows of an item's terms are merged
into one row of scores. Each task keeps the best ``k`` of an item over its blocks, and
two windows, the first over salted groups of tasks, reduce these to the best of all.

Nothing grows with the corpus but its blocks: tasks hold one block and ``k`` results of
an item; the driver holds the terms of one block of items with their document counts,
at most about ``most_pairs`` (item, term) pairs. More items are searched in more such
blocks, each a pass over the documents.

Terms are compared by 64-bit hashes. Defined results: null and empty texts have no
terms; a document of any length is worked on in pieces cut between terms. Rows of one
item id are one item with the terms of all of them; items without an id are left out,
those without a term have no results. Documents without an id count in the statistics
and are not returned; repeated rows are documents of their own. Ties go to the smaller
id. Empty tables give no rows. Extra columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bytes as B
from .shared import drop, table, written

#: ASCII letters and digits and all other characters from U+0080 on make terms.
TERM = B.LETTER | B.DIGIT
K, MOST_PAIRS, ROWS, PIECE = 50, 500_000, 4096, 1 << 20
MATRIX = "doc_id array<bigint>, n array<bigint>, term array<int>, df array<bigint>, doc array<int>, tf array<bigint>, n_docs bigint, n_terms bigint"


def cut(buf: np.ndarray, offsets: np.ndarray, piece: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of a run of texts; a longer text of its own comes in pieces that end between terms."""
    if len(buf) <= 2 * piece or len(offsets) > 2:
        yield 0, buf, offsets
        return
    start = 0
    while start < len(buf):
        end = min(start + piece, len(buf))
        while end < len(buf) and TERM[buf[end]]:
            ahead = np.flatnonzero(~TERM[buf[end : end + piece]])
            end = end + int(ahead[0]) if len(ahead) else min(end + piece, len(buf))
        part = buf[start:end]
        yield 0, part, np.array([0, len(part)])
        start = end


def terms(column: pa.Array, size: int = B.CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of the terms of a column of texts, some rows at a time."""
    for first, _, buf, offsets in B.chunks(column, size):
        for row, part, at in cut(B.LOWER[buf], offsets):
            starts, ends, index = B.spans(part, at, TERM)
            yield first + row + np.repeat(np.arange(len(at) - 1), np.diff(index)), B.hashes(part, starts, ends)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, term, times) of the items: hashes of their terms and how often each has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, h in terms(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(h.view(np.int64))], ["item", "term"])

    rows = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), text_col)
    return rows.mapInArrow(run, "item bigint, term bigint").groupBy("item", "term").agg(F.count("*").alias("times"))


def matrices(docs: DataFrame, vocabulary, id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS) -> DataFrame:
    """Blocks of the term-document matrix: ids and lengths of the documents, and (term, doc, tf) in order, with ``df`` documents for each term.

    vocabulary: a broadcast of sorted hashes; a term is its place there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                b = batch.slice(at, rows)
                n = np.zeros(b.num_rows, np.int64)
                keys, counts = [], []
                for row, h in terms(b.column(1)):
                    n += np.bincount(row, minlength=len(n))
                    if len(known):
                        place = np.minimum(np.searchsorted(known, h), len(known) - 1)
                        use = known[place] == h
                        key, count = np.unique(place[use] * len(n) + row[use], return_counts=True)
                        keys.append(key)
                        counts.append(count)
                # A long document's pieces give a key more than once.
                key, inverse = np.unique(np.concatenate([*keys, np.zeros(0, np.int64)]), return_inverse=True)
                tf = np.bincount(inverse, np.concatenate([*counts, np.zeros(0, np.int64)]), len(key)).astype(np.int64)
                term, df = np.unique(key // len(n), return_counts=True)
                one = lambda x, kind: pa.array([x], pa.list_(kind))
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), b.column(0)), one(n, pa.int64()), one(term.astype(np.int32), pa.int32()), one(df, pa.int64()),
                    one((key % len(n)).astype(np.int32), pa.int32()), one(tf, pa.int64()), pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64()),
                ], ["doc_id", "n", "term", "df", "doc", "tf", "n_docs", "n_terms"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, MATRIX)


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def impacts(term: np.ndarray, tf: np.ndarray, length: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What each occurrence row of a term adds to a score; length: that of its document. All in 64-bit integers."""
    m = 50 + (50 * length * n_docs) // n_terms
    return weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties by the smaller id."""
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def product(blocks: Iterator[pa.RecordBatch], queries: dict, k: int) -> Iterator[pa.RecordBatch]:
    """The best k (item, doc_id, score) of each item over the blocks of one task.

    queries: items, their rows of terms (first, term, times), and weight, n_docs and n_terms of the corpus.
    """
    items, first, q_term, q_times = (queries[x] for x in ("items", "first", "term", "times"))
    none = np.zeros(0, np.int64)
    kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in blocks:
        for b in range(batch.num_rows):
            at = lambda name: batch.column(name)[b].values
            length, doc, tf, present, df = (at(x).to_numpy(zero_copy_only=False) for x in ("n", "doc", "tf", "term", "df"))
            named, ids = at("doc_id").is_valid().to_numpy(zero_copy_only=False), at("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            if not len(doc):
                continue
            value = impacts(np.repeat(present, df), tf, length[doc], queries["weight"], queries["n_docs"], queries["n_terms"])
            bounds = np.concatenate(([0], np.cumsum(df)))
            place = np.full(len(queries["weight"]), -1)
            place[present] = np.arange(len(present))
            for i in range(len(items)):
                rows = place[q_term[first[i] : first[i + 1]]]
                scores = np.zeros(len(ids), np.int64)
                for r, times in zip(rows[rows >= 0].tolist(), q_times[first[i] : first[i + 1]][rows >= 0].tolist(), strict=True):
                    span = slice(bounds[r], bounds[r + 1])
                    scores[doc[span]] += value[span] * times  # a document comes once in a term's row
                held = kept.get(i, (none, none))
                least = held[0][-1] if len(held[0]) == k else 1
                new = np.flatnonzero((scores >= least) & named)
                if len(new):
                    kept[i] = best(np.concatenate((held[0], scores[new])), np.concatenate((held[1], ids[new])), k)
    for i, (scores, ids) in kept.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), items[i])), pa.array(ids), pa.array(scores)], ["item", "doc_id", "score"])


def reduced(found: DataFrame, k: int, groups: int = 64) -> DataFrame:
    """(item_id, rank, doc_id, score) of the best k of each item, in two steps."""
    order = [F.col("score").desc(), F.col("doc_id")]
    part = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(groups)))
    some = part.withColumn("r", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("r") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, once: bool = True, most_pairs: int = MOST_PAIRS, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item. once: a term counts once however often an item has it, else as often."""
    spark = docs.sparkSession
    pairs = written(item_terms(items, item_col, text_col), "item_terms")
    blocks = max(1, math.ceil(pairs.count() / most_pairs))
    found = None
    for block in range(blocks):
        mine = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow()  # about most_pairs rows
        item, term, times = (mine.column(c).to_numpy() for c in ("item", "term", "times"))
        known, place = np.unique(term.view(np.uint64), return_inverse=True)
        order = np.lexsort((place, item))
        ids, first = np.unique(item[order], return_index=True)
        held = spark.sparkContext.broadcast(known)
        matrix = written(matrices(docs, held, id_col, text_col), "matrix")
        n_docs, n_terms = matrix.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        counts = matrix.select(F.explode(F.arrays_zip("term", "df")).alias("x")).groupBy("x.term").agg(F.sum("x.df").alias("df")).toArrow()
        df = np.zeros(len(known), np.int64)
        df[counts.column("term").to_numpy()] = counts.column("df").to_numpy()
        queries = spark.sparkContext.broadcast({
            "items": ids, "first": np.append(first, len(item)), "term": place[order], "times": np.ones_like(times) if once else times[order],
            "weight": weights(df, n_docs), "n_docs": n_docs, "n_terms": n_terms,
        })
        best_here = written(reduced(matrix.mapInArrow(lambda it, q=queries: product(it, q.value, k), "item bigint, doc_id bigint, score bigint"), k), "ranked")
        drop(matrix)
        found = best_here if found is None else found.unionByName(best_here)
    drop(pairs)
    return found


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
with terms as (select id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select row_number() over () as id, text from documents)),
d as (select row_number() over () as id, doc_id from documents),
tf as (select id, term, count(*) as tf from terms group by all),
l as (select id, cast(sum(tf) as bigint) as n from tf group by id),
s as (select count(*) as nd, cast(sum(n) as bigint) as nt from l),
q as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark where item_id is not null),
w as (select term, cast(floor(1000 * ln((2 * nd + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w from tf, s where term in (select term from q) group by term, nd),
r as (select item_id, id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // nt)))) as bigint) as score from q join w using (term) join tf using (term) join l using (id), s group by all),
k as (select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) as rank from r join d using (id) where score > 0 and doc_id is not null)
select item_id, cast(rank as int) as rank, doc_id, score from k where rank <= 50
"""

QUERIES = {"op11_ranked_search": op11_ranked_search}
ORACLES = {"op11_ranked_search": ORACLE}
