import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import urls as U


def brute(url):
    """Host, path and rule as the contract words them."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(r), v == "block", v, r) for v, r in U.RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best and best[2]


URLS = ["http://a.NET/x", "http://net", "http://net/", "https://anet/", "http://example.net/en/1?x#y", "http://example.net/en", "http://b.example.com/de/", "http://x.org/fr/a", "http://x.org/FR/a", "HTTP://É.Example.Org/fr/é",
        "nothing", "", None, "://", "http://?q", "http://h#f", "a://b://c/d", "http://a.net/x\ny", "http://casino-win.example.com/en/1", "http://" + "a" * 100_000 + ".org/", "http://therein.example.com/en/2"]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate([*URLS, URLS[0]])], "page_id long, url string, host string, verdict string")
    weights = U.train(spark, rounds=3)
    got = {r.page_id: r for r in U.judge(df, weights).collect()}
    for i, u in enumerate([*URLS, URLS[0]]):
        host, path, rule, verdict = brute(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert verdict in (None, got[i].verdict) and got[i].verdict in ("allow", "block")
    assert U.judge(df.limit(0), weights).count() == 0


def test_scores_are_the_models(spark):
    weights = U.train(spark)
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    buckets = {r.page_id: r.b for r in df.select("page_id", U.features(U.host(F.col("url")), U.path(F.col("url"))).alias("b")).collect()}
    for r in U.judge(df, weights).collect():
        z = weights[-1] + sum(weights[b] for b in buckets[r.page_id]) / max(1, len(buckets[r.page_id])) ** 0.5
        assert r.rule or (r.verdict == "block") == (z >= 0)
        assert 0 <= r.spam <= 1


def blocked(spark, weights, names):
    df = spark.createDataFrame([(i, f"https://{n}.example.info/en/{i}") for i, n in enumerate(names)], "page_id long, url string")
    got = {r.page_id: r.verdict == "block" for r in U.judge(df, weights, rules=()).collect()}
    return [got[i] for i in range(len(names))]


def test_unseen_names_of_known_words(spark):
    """Joined names that aren't in the table, with other hosts around them."""
    weights = U.train(spark)
    spam = ["best-casino", "viagra4you", "poker-lottery", "cheapcrypto", "warez-torrents", "nude-webcam", "freecoupons", "bitcoin-profits"]
    clean = ["cityhospital", "forest-river", "kitchenrecipes", "museum-of-history", "mountainrailway", "chemistry-lectures", "localnewspaper", "football-club"]
    known = {n for n, _ in U.labelled_names()}
    assert not known & {*spam, *clean}
    assert sum(blocked(spark, weights, spam)) >= 7 and sum(blocked(spark, weights, clean)) <= 1


def test_names_of_which_nothing_is_known(spark):
    """Names that share no word with the table are allowed, as most sites are; and that is what the bias says."""
    weights = U.train(spark)
    r = np.random.default_rng(3)
    made = ["".join(r.choice(list("bcdfghjklmnprstvwz")) + r.choice(list("aeiou")) for _ in range(r.integers(3, 6))) for _ in range(200)]
    assert np.mean(blocked(spark, weights, made)) < 0.05
    assert blocked(spark, weights, [""]) == [False]


def test_words_that_training_has_not_seen(spark):
    """A tenth of the words is held out of both kinds, and names of held-out words alone are judged: no part of them is known.

    Most of such names are allowed, whatever they are; a known word beside them tells more.
    """
    out = {w for i, w in enumerate([*U.SPAM_WORDS, *U.CLEAN_WORDS]) if i % 10 == 0}
    within = lambda name: any(w in name for w in out)
    weights = U.train(spark, U.labelled_urls(spark, [x for x in U.labelled_names() if not within(x[0])]))
    spam, clean = ([w for w in words if w in out] for words in (U.SPAM_WORDS, U.CLEAN_WORDS))
    hit, miss = np.mean(blocked(spark, weights, spam)), np.mean(blocked(spark, weights, clean))
    print(f"blocked of held-out words: {hit:.2f} of {len(spam)} spam, {miss:.2f} of {len(clean)} others")
    assert miss <= 0.05 and hit >= miss
    beside = lambda words, more: np.mean(blocked(spark, weights, [f"{w}-{k}" for w, k in zip(words, more * 9, strict=False)]))
    assert beside(spam, ["casino", "torrent", "lottery"]) > 0.3 and beside(clean, ["museum", "forest", "football"]) == 0


def test_training_is_that_of_brute_force(spark):
    """Gradient descent on dense rows gives the same weights, and takes one job."""
    rows = U.labelled_table()[::9]
    df = spark.createDataFrame(rows, "url string, label int")
    weights = U.train(spark, df, rounds=20)
    x = np.zeros((len(rows), (1 << U.BITS) + 1))
    for i, r in enumerate(df.select(U.features(U.host(F.col("url")), U.path(F.col("url"))).alias("b")).collect()):
        x[i, r.b] = 1 / len(r.b) ** 0.5
    x[:, -1] = 1
    y = np.array([b for _, b in rows], float)
    w, q = np.zeros((1 << U.BITS) + 1), np.full((1 << U.BITS) + 1, 1e-12)
    for _ in range(20):
        g = x.T @ ((1 / (1 + np.exp(-x @ w)) - y) / len(y)) + U.DECAY * w
        q += g * g
        w -= U.RATE * g / np.sqrt(q)
    w[-1] += np.log(U.PRIOR / (1 - U.PRIOR)) - np.log(np.mean(y) / (1 - np.mean(y)))
    assert np.allclose(weights, w, atol=1e-9)


def test_training_tables(spark):
    assert set(U.train(spark, spark.createDataFrame([], "url string, label int"))) == {0.0}
    one = spark.createDataFrame([(None, 1), ("http://a.b/", None)], "url string, label int")
    assert U.train(spark, one, rounds=1)[-1] > 0
    with pytest.raises(ValueError):
        U.train(spark, spark.range(U.MOST_LABELS + 1).select(F.lit("http://a/").alias("url"), F.lit(1).alias("label")))


def test_pages_whole_without_python(spark, sf):
    df = U.op10_url_filters(spark, sf)
    assert not re.search("Python|Pandas|Arrow|Exchange|ExistingRDD", df._jdf.queryExecution().executedPlan().toString())
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: (r.host, r.path, r.rule) for r in df.collect()}
    assert got == {k: brute(u)[:3] for k, u in pages.items()}
