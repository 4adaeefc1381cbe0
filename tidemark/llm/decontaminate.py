"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers (digits or number words), names (capitalised
words inside a sentence, runs of them as one) and units are replaced with typed
placeholders, all else is lower-cased and stripped of punctuation. Windows of
``width`` template tokens are hash-joined with those of the benchmark items.
Within one alignment of a document and an item, the values in the placeholders
must map one to one (the same name always becomes the same other name), which
tells a re-parameterised question from text that only has its form: each value
goes with the one that it most often meets, windows with other pairs are
inconsistent, and an alignment counts when at least ``least_consistent`` of its
matched windows are not. A document is contaminated by an item when consistent
windows make up ``least_share`` of the item's.

The document side is one numpy pass that keeps only windows in a bitmap of the
benchmark's hashes (its size is fixed, whatever the benchmark's); the join with
the item windows then decides. Nothing of all documents is collected.

Defined results: null and empty texts match nothing. Items with fewer tokens
than ``width`` are one window of their length. Windows with fewer than
``least_literal`` tokens that are no placeholders (``least_short`` for items of at
most six tokens) have the form of too many texts: they match only with equal
values, and an item counts by the better of its share of the others and its share
of all. A single word is no passage. A very long text has all its windows; it is a run of
its own. Of values that meet equally often the smaller hash goes first. Rows without an id take no part. Repeated rows and items give one row for
each pair of ids; extra columns are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bytes import DIGIT, LETTER, U, chunks, hashes, lowered, mix, spans, word_bytes
from .shared import table, written

NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters "
    "g kg mg gram grams kilogram kilograms pound pounds lb lbs ounce ounces oz ton tons tonne tonnes l ml liter liters litre litres gallon gallons "
    "second seconds sec minute minutes min hour hours day days week weeks month months year years mph kmh percent dollar dollars usd euro euros eur cent cents degrees celsius fahrenheit"
).split()
BITS = 23

STOP = np.zeros(256, bool)
STOP[[ord(c) for c in ".!?:\n\"()"]] = True


@dataclass(frozen=True)
class Settings:
    width: int = 8
    least_literal: int = 4
    least_short: int = 3
    least_share: float = 0.25
    least_consistent: float = 0.67
    most_broadcast: int = 500_000


def fixed(words: list[str]) -> np.ndarray:
    raw = "".join(words).encode()
    ends = np.cumsum([len(w.encode()) for w in words])
    return np.sort(hashes(np.frombuffer(raw, np.uint8), np.concatenate(([0], ends[:-1])), ends))


_NUMBERS, _UNITS = fixed(NUMBER_WORDS), fixed(UNITS)
NUMBER, NAME, UNIT = U(1), U(2), U(3)


def among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def templates(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template tokens of the rows (placeholders are 1 to 3), the hashes of their values, and where each row's begin."""
    low, upper = lowered(buf)
    inside = word_bytes(buf)
    marked = np.where(inside, np.uint8(0x61), np.uint8(0x20))
    starts, ends, first = spans(marked, offsets)
    if not len(starts):
        return np.zeros(0, U), np.zeros(0, U), np.zeros(len(offsets), np.int64)
    value = hashes(low, starts, ends)
    token = value.copy()
    counts = lambda mask: (c := np.concatenate(([0], np.cumsum(mask))))[ends] - c[starts]
    size = ends - starts
    digits = counts(DIGIT[buf])
    number = ((digits > 0) & (counts(LETTER[buf]) == 0)) | among(value, _NUMBERS)
    unit = among(value, _UNITS)
    stops = np.concatenate(([0], np.cumsum(STOP[buf] & ~inside)))
    opens = np.zeros(len(starts), bool)  # first word of a sentence
    opens[first[:-1][first[:-1] < len(starts)]] = True
    opens[1:] |= stops[starts[1:]] > stops[ends[:-1]]
    wide = np.where(buf[starts] >= 0xC0, 2, 1)
    head = upper[starts] | upper[np.minimum(starts + 1, len(buf) - 1)] & (wide == 2)
    rest = counts(upper) - 1
    name = head & ~opens & (size > wide) & (rest == 0) & (digits == 0)
    token[number], token[unit], token[name] = NUMBER, UNIT, NAME
    # A run of names is one, with the value of its first word.
    again = np.concatenate(([False], name[1:] & name[:-1])) & ~opens
    keep = ~again
    return token[keep], value[keep], np.searchsorted(np.flatnonzero(keep), first)


def windows(token: np.ndarray, value: np.ndarray, first: np.ndarray, width: int, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and hashes of the windows of ``width`` tokens within a row, and whether they have enough literal tokens; the hashes of those without are of their values too."""
    n = len(token)
    if n < max(width, 2) or width < 2:
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, bool)
    h = np.full(n - width + 1, U(width))
    for k in range(width):
        h = mix(h * U(0xD1342543DE82EF95) + token[k : n - width + 1 + k])
    literal = np.concatenate(([0], np.cumsum(token > UNIT)))
    least = settings.least_literal if width > 6 else min(settings.least_short, settings.least_literal)
    strong = literal[width:] - literal[: n - width + 1] >= least
    row_end = np.repeat(first[1:], np.diff(first))[: n - width + 1]
    at = np.flatnonzero(np.arange(n - width + 1) + width <= row_end)
    weak = at[~strong[at]]
    exact = h[weak] ^ U(0x7665726261746D)
    for k in range(width):
        exact = mix(exact * U(0xD1342543DE82EF95) + value[weak + k])
    h[weak] = exact
    return at, h[at], strong[at]


SCHEMA = "id bigint, place int, n_windows int, n_strong int, strong boolean, hash bigint, slots array<bigint>"


def template_windows(df: DataFrame, settings: Settings, widths: list[int] | None = None, bitmap=None) -> DataFrame:
    """Windows of (id, text) as rows of SCHEMA. Without ``widths`` (items) a text has windows of the settings' width, or one of its length.

    slots: of each placeholder in the window its kind and value, in order; none for windows that match only with equal values. bitmap: a broadcast filter of hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value if bitmap is not None else None
        for b in batches:
            for first_row, last_row, buf, offsets in chunks(b.column(1)):
                ids = np.asarray(b.column(0).slice(first_row, last_row - first_row))
                token, value, first = templates(buf, offsets)
                length = np.diff(first)
                owner = np.repeat(np.arange(len(ids)), length)
                for width in widths or range(1, settings.width + 1):
                    at, h, strong = windows(token, value, first, width, settings)
                    if not widths:
                        use = (length[owner[at]] == width) if width < settings.width else np.ones(len(at), bool)
                        at, h, strong = at[use], h[use], strong[use]
                    if bits is not None and len(h):
                        slot = h >> U(64 - BITS)
                        use = (bits[slot >> U(3)] >> (slot & U(7)).astype(np.uint8)) & 1 == 1
                        at, h, strong = at[use], h[use], strong[use]
                    if not len(at):
                        continue
                    n = np.bincount(owner[at], minlength=len(ids))
                    n_strong = np.bincount(owner[at[strong]], minlength=len(ids))
                    none = np.zeros(0, np.int64)
                    slots = [(mix(value[i : i + width] * U(4) + token[i : i + width])[token[i : i + width] <= UNIT]).view(np.int64) if s else none for i, s in zip(at, strong, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[owner[at]]), pa.array((at - first[owner[at]]).astype(np.int32)), pa.array(n[owner[at]].astype(np.int32)), pa.array(n_strong[owner[at]].astype(np.int32)), pa.array(strong), pa.array(h.view(np.int64)), pa.array(slots, pa.list_(pa.int64()))],
                        ["id", "place", "n_windows", "n_strong", "strong", "hash", "slots"],
                    )

    return df.mapInArrow(run, SCHEMA)


def filter_bits(items: DataFrame) -> np.ndarray:
    """A bitmap of 2**BITS bits with the leading bits of the items' hashes."""
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    lead = items.select(F.expr(f"cast(shiftrightunsigned(hash, {64 - BITS}) as int)").alias("lead")).distinct().toArrow().column("lead").to_numpy()
    np.bitwise_or.at(bits, lead >> 3, (1 << (lead & 7)).astype(np.uint8))
    return bits


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id") -> DataFrame:
    """(doc_id, item_id, n_windows, n_item_windows, share, verbatim): the pairs of a document and an item that it holds."""
    spark = docs.sparkSession
    named = lambda df, c: df.select(F.col(c).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    items = written(template_windows(named(benchmark, item_col), settings), "item-windows")
    lengths = [r.width for r in items.select(F.when(F.col("n_windows") == 1, 1).otherwise(0).alias("width")).distinct().collect()]
    widths = list(range(1, settings.width + 1)) if 1 in lengths else [settings.width]
    bitmap = spark.sparkContext.broadcast(filter_bits(items))
    found = template_windows(named(docs, id_col), settings, widths, bitmap)
    item = items.select(F.col("id").alias("item_id"), F.col("place").alias("item_place"), "n_windows", "n_strong", "strong", "hash", F.col("slots").alias("item_slots"))
    pairs = found.drop("n_windows", "n_strong", "strong").join(item, "hash").withColumn("shift", F.col("place") - F.col("item_place"))
    # All groups below are of one document and one item: they are dealt once, and an alignment has at most the item's windows.
    zipped = F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"))
    key = ["id", "item_id", "shift", "n_windows", "n_strong"]
    matched = pairs.select(*key, F.col("item_place").alias("at"), "strong", zipped.alias("z"), F.xxhash64(zipped).alias("zid")).repartition("id", "item_id").dropDuplicates([*key, "at", "strong", "zid"])
    slots = matched.select(*key, "at", "strong", "zid", F.explode_outer("z").alias("p")).select(*key, "at", "strong", "zid", "p.i", "p.d")
    over = lambda *more: Window.partitionBy(*key, *more)
    rank = slots.withColumn("met", F.struct((-F.count("*").over(over("i", "d"))).alias("c"), "i", "d"))
    good = F.col("i").isNull() | ((F.min("met").over(over("i")) == F.col("met")) & (F.min("met").over(over("d")) == F.col("met")))
    judged = rank.withColumn("good", good).groupBy(*key, "at", "strong", "zid").agg(F.every("good").alias("ok"), F.every(F.coalesce(F.col("i") == F.col("d"), F.lit(True))).alias("same"))
    held = judged.groupBy(*key).agg(
        F.count("*").alias("n_matched"), F.count_if("ok").alias("n_ok"), F.every(~F.col("ok") | F.col("same")).alias("verbatim"),
        F.collect_set(F.when(F.col("ok"), F.struct("at", "strong"))).alias("places"),
    )
    counted = held.where(F.col("n_ok") >= settings.least_consistent * F.col("n_matched"))
    best = counted.groupBy("id", "item_id", "n_windows", "n_strong").agg(F.array_distinct(F.flatten(F.collect_set("places"))).alias("places"), F.max("verbatim").alias("verbatim"))
    best = best.withColumn("n", F.size("places")).withColumn("m", F.expr("size(filter(places, x -> x.strong))"))
    # The others alone if their share is the better one; then they are what is counted.
    alone = F.col("m") * F.col("n_windows") >= F.col("n") * F.col("n_strong")
    alone = alone & (F.col("n_strong") > 0)
    best = best.select("id", "item_id", F.when(alone, F.col("m")).otherwise(F.col("n")).alias("n"), F.when(alone, F.col("n_strong")).otherwise(F.col("n_windows")).alias("n_windows"), "verbatim")
    # repeated items may differ in text: the best of them counts
    return (
        best.withColumn("share", F.col("n") / F.col("n_windows"))
        .where(F.col("share") >= settings.least_share)
        .groupBy(F.col("id").alias("doc_id"), "item_id")
        .agg(F.max("n").cast("long").alias("n_windows"), F.max("n_windows").cast("long").alias("n_item_windows"), F.max("share").alias("share"), F.max("verbatim").alias("verbatim"))
    )


def decontaminate(df: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that hold no benchmark item, all columns unchanged."""
    bad = written(contaminated(df, benchmark, settings, text_col, id_col).select(F.col("doc_id").alias("__bad")).distinct(), "contaminated")
    small = bad.count() <= settings.most_broadcast
    return df.join(F.broadcast(bad) if small else bad, df[id_col] == bad["__bad"], "left_anti")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op7_decontamination": op7_decontamination}
#: Templates can't be expressed in SQL; tests/llm compares with a brute-force version.
ORACLES: dict[str, str] = {}
