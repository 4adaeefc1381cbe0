"""LM scoring by a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(leaf | class, history) * P(word | leaf).
The end, the most frequent words and hashed word endings are the classes. A class of
an ending has leaves: one for each of its own most frequent words, and hashed leaves
for all its other words. Both first factors are softmaxes over hashed features of the
history: the word before, the one before that alone (a skip), and both together; for
leaves each of them together with the class. The last factor is 1 for a word with a
leaf or class of its own, else it comes from the counts of all training tokens, with
half a count for every known word and for one unknown word a leaf. So all factors are
proper distributions.

*Counts*: tokens are 64-bit hashes; each task adds up its own before they are
shuffled. *Training*: rounds of distributed gradient updates, each over another
part of the training rows and together over all of them (dealt by id and text, so
that copies of one text are in all rounds); every core sends one block-wise sum of
expected and observed outcomes, blocks are added up by key, and only the model's own
size reaches the driver.
*Scoring*: numpy over runs of texts. Counts of frequent words (a bounded table) are
at hand in every task; all other words go through a join with the counts. A row is
known by its id and a hash of its text all the way, never by a number that a second
run of its plan could give to another row.

Defined results: a null or empty text has one token, the end; a very long text is
scored in one run of its own. Without training rows N and V are 0 and the classes are
equally likely. Repeated rows are scored each on their own; extra columns are not
returned. Equally frequent words are told apart by their hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytes import LOWER, U, chunks, hashes, mix, spans
from .shared import drop, table, written

END = U(0x656E642D6F662D74)
SINGLE, ENDINGS = 24, 40  # classes of one word (the end is the first), and of word endings
CLASSES = SINGLE + ENDINGS
OWN, HASHED = 48, 16  # leaves of a class of endings: for one word each, and hashed
LEAVES = OWN + HASHED
#: Rows of the weights for the features of the classes, and for those of the leaves, as powers of 2.
BITS, LEAF_BITS = (12, 12, 13), (13, 12, 13)
STARTS = np.cumsum([0] + [1 << b for b in BITS + LEAF_BITS])
BIAS = int(STARTS[-1])  # the classes' bias, and then one row for the leaves of each class
ROWS = BIAS + 1 + CLASSES
BLOCK = 64
RUN = 1 << 13  # histories or tokens whose probabilities are held at once
TOGETHER, MOST = 1 << 21, 1 << 19  # bytes of text, and tokens, whose equal histories are worked out once
COUNTED = 4_000_000  # tokens that a task adds up at once
NEVER = -40.0  # weight of a leaf that no word has


@dataclass(frozen=True)
class Settings:
    folds: int = 5
    fold: int = 1
    #: Most words whose counts every task holds.
    frequent: int = 400_000
    #: Rounds of gradient updates, and the shares that the training rows are dealt into: share i is in round i % rounds, so the rounds together take every row.
    rounds: int = 6
    shares: int = 32
    damping: float = 8.0
    step: float = 1.0


def tokens(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the tokens of each row with its end, their bins, and where each row's begin.

    A bin is a hashed leaf of a class of endings, (class - SINGLE) * HASHED + place; the end has none (-1).
    """
    low = LOWER[buf]
    starts, ends, first = spans(low, offsets)
    n_rows = len(offsets) - 1
    at = first + np.arange(n_rows + 1)
    h = np.full(len(starts) + n_rows, END)
    bins = np.full(len(h), -1, np.int64)
    word = np.ones(len(h), bool)
    word[at[1:] - 1] = False
    h[word] = hashes(low, starts, ends)
    tail = low[ends - 1].astype(np.uint64)
    tail += np.where(ends - starts > 1, low[np.maximum(ends - 2, 0)], 0).astype(np.uint64) * U(256)
    bins[word] = (mix(tail) % U(ENDINGS) * U(HASHED) + mix(h[word] ^ U(0x6C656166)) % U(HASHED)).astype(np.int64)
    return h, bins, at


def held_out(doc_id, s: Settings):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % s.folds == s.fold, F.lit(False))


def in_round(s: Settings):
    """The round that learns from a training row."""
    return F.pmod(F.pmod(F.xxhash64("doc_id", "text"), F.lit(s.shares)), F.lit(s.rounds)).cast("int")


def count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (text) as (token, c, bin), added up over many rows."""

    def done() -> pa.RecordBatch:
        h, first, c = np.unique(np.concatenate(held), return_index=True, return_counts=True)
        of = np.concatenate(bins)[first]
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64)), pa.array(of.astype(np.int32))], ["token", "c", "bin"])

    held: list[np.ndarray] = []
    bins: list[np.ndarray] = []
    size = 0
    for b in batches:
        for _, _, buf, offsets in chunks(b.column(0)):
            h, of, _ = tokens(buf, offsets)
            held.append(h)
            bins.append(of.astype(np.int16))
            size += len(h)
            if size >= COUNTED:
                yield done()
                held, bins, size = [], [], 0
    if size:
        yield done()


@dataclass
class Model:
    """What every task needs; its size is bounded by the settings."""

    n: int
    v: int
    ends: int  # training texts, that is ends
    frequent: np.ndarray  # sorted hashes and their counts
    counts: np.ndarray
    named: np.ndarray  # sorted hashes of the words with a class or leaf of their own, with their outcomes class * LEAVES + leaf
    outcome: np.ndarray
    bin_n: np.ndarray  # tokens and distinct words of each bin
    bin_v: np.ndarray
    weights: np.ndarray

    def outcomes(self, h: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class and leaf of each token, and whether it has them for its own."""
        at = np.minimum(np.searchsorted(self.named, h), len(self.named) - 1)
        own = self.named[at] == h
        of = np.where(own, self.outcome[at], (SINGLE + bins // HASHED) * LEAVES + OWN + bins % HASHED)
        return of // LEAVES, of % LEAVES, own

    def history(self, h: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """The hashed features of each token's history."""
        rank = np.arange(len(h)) - np.repeat(at[:-1], np.diff(at))
        one, two = np.roll(h, 1), np.roll(h, 2)
        one = np.where(rank >= 1, one, U(1))
        two = np.where(rank >= 2, two, U(2))
        return [mix(one), mix(two ^ U(0x51)), mix(one * U(3) + mix(two))]

    def class_rows(self, history: list[np.ndarray]) -> np.ndarray:
        """Rows of the weights for the class of each token: (token, feature), the bias last."""
        out = np.full((len(history[0]), len(BITS) + 1), BIAS, np.int32)
        for i, x in enumerate(history):
            out[:, i] = STARTS[i] + (x >> U(64 - BITS[i])).astype(np.int64)
        return out

    def leaf_rows(self, history: list[np.ndarray], k: np.ndarray) -> np.ndarray:
        """Rows of the weights for the leaf of tokens whose classes are k."""
        out = np.empty((len(k), len(BITS) + 1), np.int32)
        spread = mix(k.astype(U) + U(0x636C617373))
        for i, x in enumerate(history):
            out[:, i] = STARTS[len(BITS) + i] + (mix(x ^ spread) >> U(64 - LEAF_BITS[i])).astype(np.int64)
        out[:, -1] = BIAS + 1 + k
        return out

    def sums(self, rows: np.ndarray) -> np.ndarray:
        """The sum of the weights for each token and outcome. It is far from where exp overflows: a bias is at most 0, and a step at most 2."""
        z = self.weights.take(rows[:, 0], axis=0)
        for i in range(1, rows.shape[1]):
            z += self.weights.take(rows[:, i], axis=0)
        return z

    def probabilities(self, rows: np.ndarray, times: np.ndarray | float = 1) -> np.ndarray:
        """Softmax over the outcomes for each token, times how often it occurs."""
        z = self.sums(rows)
        np.exp(z, out=z)
        z *= (times / z.sum(axis=1))[:, None]
        return z


def histories(rows: np.ndarray) -> np.ndarray:
    """Four rows of the weights (16 bits hold each) as one number, ordered by the last and then the first of them."""
    key = rows[:, 3].astype(U)
    for i in range(3):
        key = key << U(16) | rows[:, i].astype(U)
    return key


def rows_of(keys: np.ndarray) -> np.ndarray:
    """The rows of ``histories``."""
    return np.stack([(keys >> U(shift) & U(0xFFFF)).astype(np.int32) for shift in (32, 16, 0, 48)], axis=1)


def grouped(sums: np.ndarray, rows: np.ndarray, p: np.ndarray, few: int = 6) -> None:
    """Add the rows of p to the rows of sums that are named; rows named up to ``few`` times are added turn by turn."""
    if not len(rows):
        return
    if (rows[1:] < rows[:-1]).any():
        order = np.argsort(rows)
        own, of = rows[order], lambda i: p.take(order[i], axis=0)
    else:
        own, of = rows, lambda i: p[i]
    new = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    size = np.diff(np.append(new, len(own)))
    for i in np.flatnonzero(size > few):
        sums[own[new[i]]] += of(slice(new[i], new[i] + size[i])).sum(axis=0)
    small = np.flatnonzero(size <= few)
    for j in range(few):
        turn = new[small[size[small] > j]]
        sums[own[turn]] += of(turn + j)


def slopes(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (text) as one sum of expected and observed outcomes a task, in blocks of BLOCK rows of the weights."""
    expected = np.zeros((ROWS, LEAVES))
    recent = np.zeros((ROWS, LEAVES), np.float32)  # the expected ones of a few runs, before they are added up exactly
    observed = np.zeros(ROWS * LEAVES, np.int64)
    since = 0

    def learn(rows: np.ndarray, target: np.ndarray) -> None:
        for i in range(rows.shape[1]):
            cell, n = np.unique(rows[:, i] * np.int32(LEAVES) + target.astype(np.int32), return_counts=True)
            observed[cell] += n
        # What is expected depends on the history alone, so equal ones are worked out once.
        keys, times = np.unique(histories(rows), return_counts=True)
        for i in range(0, len(keys), RUN):
            some = rows_of(keys[i : i + RUN])
            p = model.probabilities(some, times[i : i + RUN].astype(np.float32))
            for of in some.T:
                grouped(recent, of, p)

    for b in batches:
        for _, _, buf, offsets in chunks(b.column(0), TOGETHER):
            h, bins, at = tokens(buf, offsets)
            history = model.history(h, at)
            k, leaf, _ = model.outcomes(h, bins)
            for i in range(0, len(h), MOST):
                of = np.arange(i, min(i + MOST, len(h)))
                learn(model.class_rows([x[of] for x in history]), k[of])
                many = of[k[of] >= SINGLE]
                learn(model.leaf_rows([x[many] for x in history], k[many]), leaf[many])
            since += len(h)
            if since > 1 << 20:
                expected += recent
                recent[:], since = 0, 0
    both = np.concatenate((expected + recent, observed.reshape(ROWS, LEAVES)), axis=1)
    used = [i for i in range(0, ROWS, BLOCK) if both[i : i + BLOCK].any()]
    yield pa.RecordBatch.from_arrays([pa.array([i // BLOCK for i in used], pa.int32()), pa.array([packed(both[i : i + BLOCK]) for i in used], pa.binary())], ["block", "sums"])


def packed(block: np.ndarray) -> bytes:
    """Rows as 16-bit floats, each row after its scale."""
    scale = np.maximum(block.max(axis=1, keepdims=True), 1e-30).astype(np.float32) / np.float32(32768)
    return scale.tobytes() + (block / scale).astype(np.float16).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    n = len(raw) // (4 + 4 * LEAVES)
    return np.frombuffer(raw, np.float16, offset=4 * n).reshape(n, 2 * LEAVES).astype(np.float64) * np.frombuffer(raw, np.float32, n)[:, None]


def add_up(key, group):
    total = sum(unpacked(x.as_py()) for x in group.column("sums"))
    return pa.table({"block": group.column("block")[:1], "sums": pa.array([packed(total)], pa.binary())})


def start(known: dict[int, int], bins: dict[int, tuple[int, int]], n: int, v: int, frequent: np.ndarray, counts: np.ndarray) -> Model:
    """The model before training. known: the bins of frequent words; bins: tokens and distinct words of each bin."""
    order = np.lexsort((frequent, -counts))
    leading = [i for i in order[: SINGLE] if frequent[i] != END][: SINGLE - 1]
    outcome = {int(END): 0} | {int(frequent[i]): (j + 1) * LEAVES for j, i in enumerate(leading)}
    class_n, leaf_n = np.zeros(CLASSES), np.zeros((CLASSES, LEAVES))
    bin_n, bin_v = np.zeros(ENDINGS * HASHED), np.zeros(ENDINGS * HASHED)
    for b, (c, d) in bins.items():
        if b >= 0:
            bin_n[b], bin_v[b] = c, d
        else:
            class_n[0] = c
    own = np.zeros(ENDINGS, np.int64)
    for i in order:
        h, c = int(frequent[i]), counts[i]
        b = known[h]
        if h not in outcome and own[b // HASHED] < OWN:
            outcome[h] = (SINGLE + b // HASHED) * LEAVES + own[b // HASHED]
            own[b // HASHED] += 1
        if h in outcome and b >= 0:
            k, leaf = divmod(outcome[h], LEAVES)
            bin_n[b] -= c
            bin_v[b] -= 1
            class_n[k] += c
            leaf_n[k, leaf] = c
        if len(outcome) == SINGLE + ENDINGS * OWN:
            break
    leaf_n[SINGLE:, OWN:] = bin_n.reshape(ENDINGS, HASHED)
    class_n[SINGLE:] += bin_n.reshape(ENDINGS, HASHED).sum(axis=1)
    weights = np.zeros((ROWS, LEAVES), np.float32)
    weights[BIAS] = np.log((np.maximum(class_n, 0) + 1) / (class_n.sum() + CLASSES))
    exists = np.zeros((CLASSES, LEAVES), bool)
    exists[SINGLE:] = np.arange(LEAVES) >= OWN
    exists[SINGLE:, :OWN] = np.arange(OWN) < own[:, None]
    exists[:SINGLE, 0] = True
    whole = leaf_n.sum(axis=1, keepdims=True) + exists.sum(axis=1, keepdims=True)
    weights[BIAS + 1 :] = np.where(exists, np.log((leaf_n + 1) / whole), NEVER)
    named = np.array(sorted(outcome), U)
    return Model(n, v, bins.get(-1, (0, 0))[0], frequent, counts, named, np.array([outcome[int(h)] for h in named], np.int64), bin_n, bin_v, weights)


def fit(docs: DataFrame, s: Settings = Settings()) -> tuple[Model, DataFrame]:
    """The model and the written counts (token, c, bin) of the training tokens. docs: (doc_id, text)."""
    spark = docs.sparkSession
    training = docs.where(~held_out(F.col("doc_id"), s))
    counts = written(training.select("text").mapInArrow(count_tokens, "token bigint, c bigint, bin int").groupBy("token").agg(F.sum("c").alias("c"), F.min("bin").alias("bin")), "counts")
    limits = [1 << i for i in range(48)]
    row = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), *[F.count_if(F.col("c") >= x) for x in limits]).first()
    least = next((x for x, n in zip(limits, row[2:], strict=True) if n <= s.frequent), limits[-1])
    known = counts.where(F.col("c") >= least).toArrow()  # at most s.frequent rows
    h = known.column("token").to_numpy().view(U)
    order = np.argsort(h)
    h, c, of = h[order], known.column("c").to_numpy()[order], known.column("bin").to_numpy()[order]
    bins = {r.bin: (r.n, r.v) for r in counts.groupBy("bin").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}  # at most ENDINGS * HASHED + 1 rows
    model = start(dict(zip(map(int, h), map(int, of), strict=True)), bins, row[0], row[1], h, c)

    taught = written(training.select("text", in_round(s).alias("round")), "taught", "round")
    for r in range(s.rounds):
        shared = spark.sparkContext.broadcast(model)
        part = taught.where(F.col("round") == r).select("text").coalesce(spark.sparkContext.defaultParallelism)
        sums = part.mapInArrow(lambda it, m=shared: slopes(m.value, it), "block int, sums binary").groupBy("block").applyInArrow(add_up, "block int, sums binary").collect()
        both = np.zeros((-(-ROWS // BLOCK) * BLOCK, 2 * LEAVES), np.float32)
        for x in sums:
            piece = unpacked(x.sums)
            both[x.block * BLOCK : x.block * BLOCK + len(piece)] = piece
        model.weights = stepped(model.weights, both[:ROWS, :LEAVES], both[:ROWS, LEAVES:], s)
        shared.unpersist()
    drop(taught)
    return model, counts


def stepped(weights: np.ndarray, expected: np.ndarray, observed: np.ndarray, s: Settings) -> np.ndarray:
    """The weights after a step along the slope. The curvature is taken from the larger of expected and observed, so that no step is over twice ``step``, however wrong the model was."""
    larger = np.maximum(expected, observed)
    bend = larger * (1 - 0.5 * np.minimum(larger / np.maximum(expected.sum(axis=1, keepdims=True), 1e-9), 1))
    return weights - (s.step * (expected - observed) / (bend + s.damping)).astype(np.float32)


def log_factors(model: Model, h: np.ndarray, bins: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token the logarithm of all factors but a count of its own, and whether it has a class or leaf for itself."""
    history = model.history(h, at)
    k, leaf, own = model.outcomes(h, bins)
    logs = np.zeros(len(h))

    def add(of: np.ndarray, rows: np.ndarray, target: np.ndarray) -> None:
        z = model.sums(rows)
        own = z[np.arange(len(of)), target] * math.log10(math.e)
        logs[of] += own - np.log10(np.exp(z, out=z).sum(axis=1))

    for i in range(0, len(h), RUN):
        of = np.arange(i, min(i + RUN, len(h)))
        add(of, model.class_rows([x[of] for x in history]), k[of])
        many = of[k[of] >= SINGLE]
        add(many, model.leaf_rows([x[many] for x in history], k[many]), leaf[many])
    logs -= np.where(own, 0.0, np.log10(model.bin_n + 0.5 * (model.bin_v + 1))[bins])
    return logs, own


def score_rows(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (id, hash, text) as rows (id, hash, token, texts, n_tokens, n_known, base, model): one for each text, and one for each of its words whose count isn't at hand."""
    half = lambda c: np.log10(c + 0.5)
    whole = float(np.log10(model.n + 0.5 * (model.v + 1)))
    for b in batches:
        for first, last, buf, offsets in chunks(b.column(2), 1 << 19):
            key = np.asarray(b.column(1).slice(first, last - first))
            h, bins, at = tokens(buf, offsets)
            owner = np.repeat(np.arange(len(key)), np.diff(at))
            logs, own = log_factors(model, h, bins, at)
            place = np.minimum(np.searchsorted(model.frequent, h), max(len(model.frequent) - 1, 0))
            end = h == END
            near = (model.frequent[place] == h) & ~end if len(model.frequent) else np.zeros(len(h), bool)
            c = np.where(near, model.counts[place], 0) if len(model.frequent) else np.zeros(len(h))
            seen = np.where(near, half(c), np.where(end, half(model.ends), 0.0))
            n = np.diff(at)
            add = lambda x: np.bincount(owner, x, len(key))
            far = ~near & ~end
            base = add(seen) - n * whole
            score = add(np.where(own, 0.0, seen) + logs)
            m = int(far.sum())
            none = lambda x, kind: pa.array(np.concatenate((x, np.zeros(m))).astype(kind))
            rows = pa.array(np.concatenate((np.arange(len(key)), owner[far])))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).slice(first, last - first).take(rows),
                    b.column(1).slice(first, last - first).take(rows),
                    pa.array(np.concatenate((mix(key.view(U) + U(77)), h[far])).view(np.int64)),
                    none(np.ones(len(key)), np.int64), none(n, np.int64), none(add(near | (end & (model.ends > 0))), np.int64), none(base, float), none(score, float),
                ],
                ["id", "hash", "token", "texts", "n_tokens", "n_known", "base", "model"],
            )


def score(df: DataFrame, model: Model, counts: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_tokens, n_known, base_score, score) of every row, logarithms to base 10."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(lambda it: score_rows(shared.value, it), f"id {kind}, hash bigint, token bigint, texts bigint, n_tokens bigint, n_known bigint, base double, model double")
    least = int(model.counts.min()) if len(model.counts) else 1 << 62
    joined = found.join(counts.where(F.col("c") < least).select("token", "c"), "token", "left")
    word = F.col("texts") == 0
    more = F.when(word, F.log10(F.coalesce("c", F.lit(0)) + 0.5)).otherwise(0.0)
    # Rows of one id and text are equal; they are added up together and parted again.
    total = joined.groupBy("id", "hash").agg(
        F.sum("texts").alias("texts"), F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("n_known") + F.when(word & F.col("c").isNotNull(), 1).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + more).alias("base_score"), F.sum(F.col("model") + more).alias("score"),
    )
    each = lambda c: (F.col(c) / F.col("texts")).alias(c)
    whole = lambda c: F.expr(f"{c} div texts").alias(c)
    parted = total.select(F.col("id").alias(id_col), whole("n_tokens"), whole("n_known"), each("base_score"), each("score"), F.explode(F.sequence(F.lit(1), F.col("texts"))).alias("copy"))
    return parted.drop("copy")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Settings()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, counts = fit(docs, s)
    return score(docs, model, counts).select("doc_id", held_out(F.col("doc_id"), s).alias("held_out"), "n_tokens", "n_known", F.lit(int(model.n)).cast("long").alias("train_tokens"), "base_score", "score")


QUERIES = {"op8_lm_scoring": op8_lm_scoring}
#: A trained model can't be expressed in SQL; tests/llm holds the counts and the base score against brute force and the model against the base on held-out texts.
ORACLES: dict[str, str] = {}
