"""Quality rules: a threshold table compiled into one Spark projection.

Everything is a built-in column expression; no Python runs on the executors.
A document is one row and stays one row: nothing is shuffled, so hot sources
or groups of copies cost no more than their share of the scan.

Defined results: a null or empty text has no words, fails the base rule and is
not kept; every ratio whose divisor is zero counts as 0. Rows are judged one by
one, so repeated rows give repeated equal results and an empty table an empty
result. Extra input columns, whatever their names, are not returned by
``measure``; ``keep_good`` returns the input's columns unchanged. A very long text is
judged whole, in arrays of its words and lines. A value at a threshold is within it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import fresh, table

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is that it for on with as was be by at from this are he a an or not have "
    "le la les de des du et un une en que qui est dans pour par sur pas avec au il elle "
    "der die das und ist von zu den mit nicht ein eine auf für als auch sich im dem "
    "el los las y del por con para su al lo es se no una como"
).split()


@dataclass(frozen=True)
class Rule:
    """Reject when ``measure`` (a SQL expression over the measured columns) is under ``least`` or over ``most``."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None

    def broken(self) -> Column:
        value = F.expr(self.measure)
        out = F.lit(False)
        if self.least is not None:
            out = out | (value < F.lit(self.least))
        if self.most is not None:
            out = out | (value > F.lit(self.most))
        return F.coalesce(out, F.lit(False))


#: The threshold table.
RULES = (
    Rule("length", "n_words", least=50, most=10_000_000),
    Rule("word_length", "coalesce(word_chars / nullif(n_words, 0), 0)", least=2.0, most=14.0),
    Rule("symbols", "coalesce(n_symbols / nullif(n_words, 0), 0)", most=0.3),
    Rule("stop_words", "coalesce(n_stop_words / nullif(n_words, 0), 0)", least=0.04),
    Rule("duplicate_lines", "coalesce(n_dup_lines / nullif(n_lines, 0), 0)", most=0.4),
    Rule("capitals", "coalesce(n_upper / nullif(word_chars, 0), 0)", most=0.5),
)


def measures(text: Column) -> list[tuple[str, Column]]:
    """The measured columns that need no array of words."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    squeezed = F.translate(text, SPACE_CHARS, "")
    return [
        ("words", F.filter(F.split(text, SPACE), lambda w: w != "")),
        ("lines", lines),
        ("word_chars", F.length(squeezed).cast("long")),
        ("n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")),
        ("n_upper", (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZÉÈÊÀÇÄÖÜÍÓÑ", ""))).cast("long")),
    ]


#: Words in 3-word windows that occur twice or more. Windows are 64-bit hashes of
#: three words, sorted with their positions; equal neighbours are repeats, and
#: each repeated position p adds the words p..p+2 that the one before didn't add.
REPEATED = """
aggregate(
  sort_array(transform(
    filter(windows, (x, k) -> coalesce(get(windows, k - 1).h = x.h, false) or coalesce(get(windows, k + 1).h = x.h, false)),
    x -> x.i)),
  named_struct('n', 0L, 'last', -3),
  (acc, p) -> named_struct('n', acc.n + least(3, p - acc.last), 'last', p),
  acc -> acc.n)
"""
WINDOWS = """
if(size(words) < 3, cast(array() as array<struct<h:bigint,i:int>>), sort_array(transform(
  sequence(0, size(words) - 3),
  i -> named_struct('h', xxhash64(words[i], words[i + 1], words[i + 2]), 'i', i))))
"""


def measure(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``keep`` columns, the measured columns, ``base_failed``, ``failed_rules`` and ``kept``."""
    ids = {c: fresh(df.select(), f"__id{i}") for i, c in enumerate(keep)}
    base = df.select(*[F.col(c).alias(n) for c, n in ids.items()], *[c.alias(n) for n, c in measures(F.col(text_col))])
    counted = base.withColumn("windows", F.expr(WINDOWS)).select(
        *ids.values(), "word_chars", "n_symbols", "n_upper",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        # The row number makes this projection one that filters on the result aren't pushed below;
        # pushed, they would repeat the array expressions for every element.
        F.when(F.monotonically_increasing_id() >= 0, F.expr(REPEATED)).cast("long").alias("n_repeat_words"),
    )
    broken = F.concat_ws(",", *[F.when(r.broken(), F.lit(r.name)) for r in rules])
    judged = counted.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")).withColumn("failed_rules", broken)
    return judged.select(
        *[F.col(n).alias(c) for c, n in ids.items()],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_upper", "base_failed",
        (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"),
        "failed_rules",
    )


def keep_good(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` whose text is kept, all columns unchanged."""
    row = fresh(df, "__row")
    packed = df.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]).alias(row), F.col(text_col).alias("text"))
    judged = measure(packed, "text", (row,), rules).where("kept")
    return judged.select(*[F.col(row)[f"c{i}"].alias(c) for i, c in enumerate(df.columns)])


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """The same in DuckDB SQL, from rows instead of arrays."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    checks = ", ".join(
        "case when " + " or ".join([f"({m}) < {r.least}"] * (r.least is not None) + [f"({m}) > {r.most}"] * (r.most is not None)) + f" then '{r.name}' end"
        for r in RULES
        for m in [r.measure]
    )
    return f"""
with d as (select doc_id, coalesce(text, '') as text from documents),
w as (select doc_id, unnest(list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) as word,
             generate_subscripts(list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''), 1) as i from d),
g as (select doc_id, i, word as a, lead(word) over p as b, lead(word, 2) over p as c from w window p as (partition by doc_id order by i)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, a, b, c) as n from g where c is not null) where n > 1),
rw as (select doc_id, count(distinct j) as n from (select doc_id, unnest([i, i + 1, i + 2]) as j from r) group by 1),
ws as (select doc_id, count(*) as n_words, sum(length(word)) as word_chars, sum(case when lower(word) in ({stops}) then 1 else 0 end) as n_stop_words from w group by 1),
l as (select doc_id, unnest(string_split(text, chr(10))) as line from d),
ls as (select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from l where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by 1),
m as (select d.doc_id, cast(coalesce(n_words, 0) as bigint) as n_words, cast(coalesce(word_chars, 0) as bigint) as word_chars,
             cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
             cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines, cast(coalesce(rw.n, 0) as bigint) as n_repeat_words,
             cast(coalesce(n_lines, 0) as bigint) as n_lines, cast(coalesce(n_stop_words, 0) as bigint) as n_stop_words,
             cast(length(text) - length(regexp_replace(text, '[A-ZÉÈÊÀÇÄÖÜÍÓÑ]', '', 'g')) as bigint) as n_upper
      from d left join ws using (doc_id) left join ls using (doc_id) left join rw using (doc_id)),
j as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, concat_ws(',', {checks}) as failed_rules from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words, n_upper, base_failed,
       not base_failed and failed_rules = '' as kept, failed_rules from j
"""


QUERIES = {"op1_quality_rules": op1_quality_rules}
ORACLES = {"op1_quality_rules": oracle()}
