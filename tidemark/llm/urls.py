"""URL filters: rules first, then logistic regression on hashed character n-grams of host and path.

Everything on the main path is a built-in column expression. Training reads a
small labelled URL table (its number of rows is bounded by ``MOST_LABELS``), takes its
features by the same expressions in one job, and leaves ``2**bits`` weights, which
scoring holds as one constant array. The table is made by a rule from lists of general
words by subject. As it has as many names to be blocked as it has words for them, and
not as many as there are in the world, the bias is moved to a stated share.

Defined results: a null url or one without ``://`` has an empty host and path,
fits no rule and is judged on empty n-grams, that is nearly by the bias alone. Rules
fit whole labels of the host (``net`` fits ``a.net``, not ``anet``); of the
fitting rules the longest wins, ties in favour of ``block``. Equal urls get
equal verdicts; a very long one costs time in proportion to its length; an empty table gives an empty result; extra columns are not
returned.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import table

#: (verdict, rule): host, then path from the first slash on.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: General words by subject, in alphabetical order: what names of sites to be blocked are about, and what others are about.
SPAM_WORDS = (
    "baccarat bet bingo blackjack bookmaker casino craps gamble gambling jackpot lottery poker roulette slots sportsbook stakes wager "
    "antidepressant cialis dosage ephedra meds opioid painkiller pharma pharmacy pill prescription sildenafil steroid supplement tablet viagra weightloss xanax "
    "adult cam dating erotic escort hookup lingerie nude playmate porn sex singles strip webcam xxx "
    "ad advertising affiliate analytics banner beacon click doubleclick impression popunder popup retarget sponsor telemetry tracker tracking "
    "crack cracked download hack keygen malware nulled phishing pirate serial torrent trojan virus warez "
    "bitcoin cash credit crypto debt earnings forex giveaway income investment loan millionaire money mortgage payday profit refinance tokens trading "
    "bargain bulk cheap clearance counterfeit coupon deals discount fake free knockoff offer outlet promo rebate replica sale sweepstakes voucher wholesale winner "
    "backlink botnet clickbait farm leads linkbuilding mailer proxy ranking seo spam traffic unlock"
).split()
CLEAN_WORDS = (
    "academy archive atlas biology botany chemistry classroom college dictionary economics education encyclopedia faculty geography geology grammar history institute kindergarten laboratory lecture library linguistics "
    "literature mathematics museum observatory philosophy physics professor reference research scholar school science seminar student teacher thesis university "
    "airport bakery bridge cathedral chapel church citizen city council district embassy fire hospital mayor ministry neighbourhood parish parliament police post railway region station street theatre town township village "
    "animal bird butterfly canyon cliff coast desert flower forest garden glacier harbour island lake meadow mountain ocean orchard planet river sea sky tree valley volcano waterfall wildlife wood "
    "actor album artist ballet band choir cinema composer concert critic dancer drama exhibition festival film gallery guitar musician novel opera orchestra painter painting piano poem poetry sculpture singer studio violin writer "
    "bulletin chronicle column correspondent courier daily editor gazette headline herald interview journal letter magazine newspaper observer press reporter tribune weather "
    "apartment bicycle bread breakfast butcher camping carpenter child cook cooking cottage dinner family farmhouse furniture grandmother hiking house kitchen knitting neighbour parent pottery recipe sewing soup tailor vegetable wedding "
    "athlete basketball cycling football gymnastics hockey marathon rowing rugby running sailing skiing soccer stadium swimming tennis volleyball "
    "architecture astronomy compiler database documentation engine engineering guide hardware kernel keyboard language machine manual network notebook operating programming project protocol robotics server software telescope tutorial"
).split()
MOST_LABELS = 10_000
BITS, SIZES, ROUNDS, RATE, DECAY = 13, (3, 4, 5), 1000, 0.5, 1e-5
#: The share of sites to be blocked that the bias assumes; a name that says nothing is then allowed.
PRIOR = 0.1


def labelled_names() -> list[tuple[str, int]]:
    """(name, label; 1 is to be blocked): each word alone, joined with another of its kind, and after it."""
    out = []
    for words, label in ((SPAM_WORDS, 1), (CLEAN_WORDS, 0)):
        n = len(words)
        for i, w in enumerate(words):
            out += [(w, label), (f"{w}-{words[(i * 19 + 8) % n]}", label), (f"{words[(i * 11 + 5) % n]}{w}", label), (f"{words[(i * 17 + 6) % n]}-{w}", label)]
    return out


def labelled_table(names: list[tuple[str, int]] | None = None) -> list[tuple[str, int]]:
    """(url, label): each name under two of several forms of hosts; paths are alike for both labels."""
    forms = ("http://{}.example.com", "https://www.{}.example.org", "https://m.{}.sample.io", "http://blog.{}.example.net", "https://{}.test")
    paths = ("/", "/en/1", "/de/22.html", "/fr/4/", "/about", "/p?id=3", "/2024/05/some-title", "")
    return [(forms[(i + j * 2) % len(forms)].format(name) + paths[(i * 3 + j) % len(paths)], label) for i, (name, label) in enumerate(names or labelled_names()) for j in (0, 1)]


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end; A-Z in lower case."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1))
    return F.coalesce(rest, F.lit(""))


def fits(rule: str, host: Column, path: Column) -> Column:
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, else nulls."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block"))
    rule = verdict = F.lit(None).cast("string")
    for v, r in reversed(ordered):
        hit = fits(r, host, path)
        rule, verdict = F.when(hit, F.lit(r)).otherwise(rule), F.when(hit, F.lit(v)).otherwise(verdict)
    return rule, verdict


def grams(chars: Column, kind: str, n: int, bits: int) -> Column:
    """Buckets of the n-grams of an array of characters."""
    places = F.when(F.size(chars) >= n, F.sequence(F.lit(1), F.size(chars) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.pmod(F.xxhash64(F.lit(kind), F.slice(chars, i, n)), F.lit(1 << bits)).cast("int"))


def features(host: Column, path: Column, bits: int = BITS) -> Column:
    """Distinct buckets of the character n-grams of ^host$ and of the path, in time proportional to their length."""
    found = []
    for kind, text in (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", path)):
        chars = F.filter(F.split(text, ""), lambda c: c != "")
        # The array is bound once, as a variable, not evaluated for every place.
        found.append(F.flatten(F.transform(F.array(chars), all_grams(kind, bits))))
    return F.array_distinct(F.concat(*found))


def all_grams(kind: str, bits: int):
    return lambda c: F.concat(*[grams(c, kind, n, bits) for n in SIZES])


def labelled_urls(spark: SparkSession, names: list[tuple[str, int]] | None = None) -> DataFrame:
    return spark.createDataFrame(labelled_table(names), "url string, label int").coalesce(1)


def train(spark: SparkSession, labelled: DataFrame | None = None, bits: int = BITS, rounds: int = ROUNDS) -> list[float]:
    """``2**bits`` weights and at the end the bias, from a table (url, label) of at most MOST_LABELS rows.

    One job brings the buckets of these rows to the driver; the rounds of gradient descent run there. Rows without a label are left out; without any row all weights are 0.
    """
    labelled = labelled_urls(spark) if labelled is None else labelled
    rows = labelled.select("url", F.col("label").cast("double").alias("y")).where("y is not null").limit(MOST_LABELS + 1)
    found = rows.select("y", features(host(F.col("url")), path(F.col("url")), bits).alias("buckets")).collect()
    if (n := len(found)) > MOST_LABELS:
        raise ValueError(f"the labelled URL table has more than {MOST_LABELS} rows")
    size = (1 << bits) + 1
    if not n:
        return [0.0] * size
    y = np.array([r.y for r in found])
    count = np.array([len(r.buckets) for r in found])
    bucket = np.array([b for r in found for b in r.buckets], np.int64)
    row, norm = np.repeat(np.arange(n), count), np.sqrt(np.maximum(count, 1))
    weights, squares = np.zeros(size), np.full(size, 1e-12)  # AdaGrad: a bucket's steps shrink by what it has moved
    for _ in range(rounds):
        z = weights[-1] + np.bincount(row, weights[bucket], n) / norm
        e = (1 / (1 + np.exp(-z)) - y) / n
        step = np.append(np.bincount(bucket, (e / norm)[row], size - 1), e.sum()) + DECAY * weights
        squares += step * step
        weights -= RATE * step / np.sqrt(squares)
    share = y.mean()
    if 0 < share < 1:
        weights[-1] += np.log(PRIOR / (1 - PRIOR)) - np.log(share / (1 - share))
    return weights.tolist()


def linear(buckets: Column, weights: list[float]) -> Column:
    """Bias and the length-normalised sum of the buckets' weights; the weights are one constant array."""
    known = F.from_json(F.lit("[" + ",".join(map(repr, weights)) + "]"), T.ArrayType(T.DoubleType()))
    total = F.aggregate(buckets, F.lit(0.0), lambda acc, b: acc + F.get(known, b))
    return F.lit(weights[-1]) + total / F.sqrt(F.greatest(F.size(buckets), F.lit(1)))


def judge(df: DataFrame, weights: list[float], url_col: str = "url", id_col: str = "page_id", rules=RULES, bits: int = BITS) -> DataFrame:
    """(id_col, host, path, rule, verdict, spam): the rule's verdict, else block where the model's probability is at least 0.5."""
    parted = df.select(F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    scored = parted.select("*", features(F.col("host"), F.col("path"), bits).alias("buckets")).select(
        "id", "host", "path",
        linear(F.col("buckets"), weights).alias("z"),
    )
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    return scored.select(
        F.col("id").alias(id_col), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("z") >= 0, "block").otherwise("allow")).alias("verdict"),
        (1 / (1 + F.exp(-F.col("z")))).alias("spam"),
    )


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), train(spark))


QUERIES = {"op10_url_filters": op10_url_filters}
#: The verdicts of a trained model can't be expressed in SQL; tests/llm compares with a brute-force version.
ORACLES: dict[str, str] = {}
