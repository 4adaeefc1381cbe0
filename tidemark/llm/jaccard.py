"""N-gram Jaccard join by universe partition and the pigeonhole principle.

A document's set is its distinct word shingles, as 64-bit hashes. Sets of equal
content are first merged into classes; the rest works on one set per class.

*Size bands.* Bands of sizes are so wide that a set only links with sets of its
own or a neighbouring band. *Universe partition.* Each band hashes all shingles
into ``m`` segments. A linked pair (x the smaller) differs in at most H
shingles, so if the segments of x carry a total weight of H + 1 or more, one of
them survives: a non-empty segment has weight 1 (its subset is equal in both),
and a segment with at least two shingles for which one-deletion neighbourhoods
are indexed too has weight 2 (the subsets differ in at most one shingle).
*Allocation.* A set whose total weight exceeds H + 1 leaves out its most
expensive lists, by the counted lengths of the lists, and looks only into the
rest. A set whose weight is too small under one partition takes part under the
next hash salt; no set is left out.
*Verification*: a pair whose parity maps already differ in too many bits can't
link; what remains compares whole sets.

Only connectivity is wanted, so lists aren't expanded into all pairs: each set
is first verified against the smallest members of its lists; pairs are then
formed only between members of a list that are not yet in one component, and
never within the largest component of a list. A list in which many members are in no
component together (a template that texts share without linking) would give all their
pairs; its members are matched by their rarest shingles instead. No link between
different components is lost.

Defined results: a null text, one without words or an empty one has an empty
set and links with nothing. Rows with a null id take part in nothing and have a
null component. Repeated ids are one node that has the links of all its rows. A very long
text is one set of all its shingles.
Extra columns are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bytes import LOWER, U, chunks, hashes, mix, shingles, spans
from .components import components
from .shared import drop, fresh, table, written

SALTS = 24
#: Bits of a set's parity map, in longs. Two sets differ in at least as many shingles as their maps differ in bits.
MAP = [f"f{i}" for i in range(8)]
OWN, DELETION = 1, 2  # bits of ``info``; the set size is above them


@dataclass(frozen=True)
class Plan:
    """n words a shingle; two sets link when q * intersection >= p * union."""

    n: int = 5
    p: int = 4
    q: int = 5
    #: Segments of a band with largest size u: share * u + more; and every how many of them index one-deletion neighbourhoods.
    share: float = 0.3
    more: int = 4
    each: int = 24
    #: Members of a list outside its main component beyond which its pairs come from prefixes instead.
    hot: int = 200
    most_broadcast: int = 500_000

    def bands(self, largest: int) -> np.ndarray:
        """The smallest size of each band, and one size beyond ``largest``."""
        out = [1]
        while out[-1] <= largest:
            out.append(out[-1] * self.q // self.p + 1)
        return np.array(out, np.int64)

    def errors(self, size: np.ndarray) -> np.ndarray:
        """Most shingles by which a set differs from a linked one of its size or larger."""
        return (size + size * self.q // self.p) * (self.q - self.p) // (self.q + self.p)

    def segments(self, bands: np.ndarray, band: np.ndarray, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Number of segments of bands, and how many of them have one-deletion neighbourhoods. Under the last salt nearly every shingle has one for itself, which is enough for any set."""
        upper = bands[band + 1] - 1
        m = np.ceil(self.share * upper).astype(np.int64) + self.more
        return m << 12 if salt == SALTS - 1 else m, 1 + m // self.each


def sets_of(buf: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of the rows of a run, and where each row's begin (and the end)."""
    low = LOWER[buf]
    starts, ends, first = spans(low, offsets)
    row, h = shingles(hashes(low, starts, ends), first, n)
    at = np.searchsorted(row, np.arange(len(offsets)))
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        s = np.sort(h[a:b])
        out.append(s[np.concatenate(([True], s[1:] != s[:-1]))] if b > a else s)
    count = np.array([len(s) for s in out], np.int64)
    return np.concatenate(out) if out else np.zeros(0, U), np.concatenate(([0], np.cumsum(count)))


def cut(s: np.ndarray, at: np.ndarray, m: np.ndarray, salt: int, band: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segments of sets under one partition.

    Returns for each non-empty segment its set, number, first and end shingle (of the sorted order that is
    returned last), and the sum of its shingles' values; with those values.
    """
    count = np.diff(at)
    owner = np.repeat(np.arange(len(count)), count)
    spread = s if not salt else mix(s + U(salt) * U(0x9E3779B97F4A7C15))
    segment = ((spread >> U(32)) * np.repeat(m, count).astype(U) >> U(32)).astype(np.int64)
    if salt:
        order = np.lexsort((segment, owner))
        segment, s = segment[order], s[order]
    value = mix(s ^ U(0xA5A5A5A5A5A5A5A5))
    new = np.flatnonzero(np.concatenate(([True], (segment[1:] != segment[:-1]) | (owner[1:] != owner[:-1])))) if len(s) else np.zeros(0, np.int64)
    sums = np.add.reduceat(value, new) if len(new) else np.zeros(0, U)
    end = np.append(new[1:], len(s)) if len(new) else new
    return owner[new], segment[new], new, end, sums, value


def weights(owner: np.ndarray, segment: np.ndarray, size: np.ndarray, deep: np.ndarray, rows: int) -> np.ndarray:
    """Total weight of each set's segments."""
    w = 1 + ((segment < deep[owner]) & (size >= 2))
    return np.bincount(owner, w, rows).astype(np.int64)


def place(label: int, band: np.ndarray, segment: np.ndarray) -> np.ndarray:
    return mix((U(label) << U(56)) + (band.astype(U) << U(40)) + segment.astype(U))


def parity(s: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Columns MAP of the sets: bit b tells whether an odd number of shingles falls on b."""
    rows, bits = len(at) - 1, 64 * len(MAP)
    fall = (mix(s ^ U(0x3C6EF372FE94F82B)) >> U(64 - bits.bit_length() + 1)).astype(np.int64)
    odd = np.bincount(np.repeat(np.arange(rows), np.diff(at)) * bits + fall, minlength=rows * bits) & 1
    packed = np.packbits(odd.astype(np.uint8).reshape(rows, bits), axis=1).view(">i8").astype(np.int64)
    return [packed[:, i] for i in range(len(MAP))]


def measure_sets(df: DataFrame, plan: Plan) -> DataFrame:
    """(doc_id, n, h1, h2, salt, slack, band, parity map): size, 128-bit digest, and the first salt under which the weights suffice, with the weight to spare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last, buf, offsets in chunks(b.column(1)):
                s, at = sets_of(buf, offsets, plan.n)
                n = np.diff(at)
                whole = n > 0
                total = lambda v: np.where(whole, np.add.reduceat(np.append(v, U(0)), np.minimum(at[:-1], len(v))), U(0))
                h1, h2 = total(mix(s + U(11))), total(mix(s ^ U(0x5DEECE66D)))
                bands = plan.bands(int(n.max(initial=1)))
                band = np.searchsorted(bands, np.maximum(n, 1), "right") - 1
                salt, slack = np.full(len(n), -1), np.zeros(len(n), np.int64)
                for k in range(SALTS):
                    todo = np.flatnonzero(whole & (salt < 0))
                    if not len(todo):
                        break
                    if len(todo) < len(n):
                        part = np.concatenate([s[at[i] : at[i + 1]] for i in todo])
                        ends = np.concatenate(([0], np.cumsum(n[todo])))
                    else:
                        part, ends = s, at
                    m, deep = plan.segments(bands, band, k)
                    owner, segment, a, z, _, _ = cut(part, ends, m[todo], k, band[todo])
                    spare = weights(owner, segment, z - a, deep[todo], len(todo)) - plan.errors(n[todo]) - 1
                    done = spare >= 0
                    salt[todo[done]], slack[todo[done]] = k, spare[done]
                if (whole & (salt < 0)).any():
                    raise RuntimeError("no partition gives a set enough segments")
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, last - first), *(pa.array(x.astype(np.int64)) for x in (n, h1.view(np.int64), h2.view(np.int64), salt, slack, band, *parity(s, at)))],
                    ["doc_id", "n", "h1", "h2", "salt", "slack", "band", *MAP],
                )

    return df.mapInArrow(run, "doc_id bigint, n bigint, h1 bigint, h2 bigint, salt bigint, slack bigint, band bigint, " + ", ".join(f"{f} bigint" for f in MAP))


def emit(batches: Iterator[pa.RecordBatch], plan: Plan, more: dict[int, set[int]]) -> Iterator[pa.RecordBatch]:
    """Batches (doc_id, text) as index rows (key, node, info, segment, salt): each set under the partition of its own band and of the band below.

    more: the bands that have to be indexed under each further salt.
    """
    for b in batches:
        for first, last, buf, offsets in chunks(b.column(1)):
            s, at = sets_of(buf, offsets, plan.n)
            node = np.asarray(b.column(0).slice(first, last - first))
            n = np.diff(at)
            bands = plan.bands(int(n.max(initial=1)))
            own = np.searchsorted(bands, np.maximum(n, 1), "right") - 1
            for salt in (0, *sorted(more)):
                for role in (OWN, 0):
                    band = own - (role == 0)
                    use = np.flatnonzero((n > 0) & (band >= 0) & (True if not salt else np.isin(band, list(more.get(salt, ())))))
                    if not len(use):
                        continue
                    if len(use) < len(n):
                        part = np.concatenate([s[at[i] : at[i + 1]] for i in use])
                        ends = np.concatenate(([0], np.cumsum(n[use])))
                    else:
                        part, ends = s, at
                    of = band[use]
                    m, deep = plan.segments(bands, of, salt)
                    owner, segment, a, z, sums, value = cut(part, ends, m, salt, of)
                    where = place(salt, of[owner], segment)
                    info = (n[use][owner] << 2) | role
                    keys, nodes, infos, segs = [mix(sums + where)], [node[use][owner]], [info], [segment]
                    dels = np.flatnonzero((segment < deep[owner]) & (z - a >= 2))
                    if len(dels):
                        size = (z - a)[dels]
                        which = np.repeat(dels, size)
                        token = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a[dels], size)
                        keys.append(mix(sums[which] - value[token] + where[which]))
                        nodes.append(node[use][owner[which]])
                        infos.append(info[which] | DELETION)
                        segs.append(segment[which])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes)), pa.array((np.concatenate(infos) << 5 | salt).astype(np.int64)), pa.array(np.concatenate(segs).astype(np.int32))],
                        ["key", "node", "info", "segment"],
                    )


def shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of their key, those whose key another row has."""
    held, matched = None, False
    for b in batches:
        if not b.num_rows:
            continue
        if held is not None:
            b = pa.concat_batches([held, b])
        key = np.asarray(b.column(0))
        same = key[1:] == key[:-1]
        keep = np.concatenate(([matched and held is not None], same)) | np.concatenate((same, [False]))
        matched = bool(keep[-1])
        held = b.slice(b.num_rows - 1)
        out = b.slice(0, b.num_rows - 1).filter(pa.array(keep[:-1]))
        if out.num_rows:
            yield out
    if held is not None and matched:
        yield held


def whole_sets(docs: DataFrame, plan: Plan) -> DataFrame:
    """(node, shingles array<bigint>) of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last, buf, offsets in chunks(b.column(1)):
                s, at = sets_of(buf, offsets, plan.n)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, last - first), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(s.view(np.int64)))], ["node", "shingles"])

    return docs.mapInArrow(run, "node bigint, shingles array<bigint>")


def only(docs: DataFrame, ids: DataFrame, plan: Plan, how: str) -> DataFrame:
    """docs semi- or anti-joined with a written table of ids: broadcast up to a number of ids, else by a shuffle."""
    small = ids.count() <= plan.most_broadcast
    return docs.join(F.broadcast(ids) if small else ids, "doc_id", how)


def verify(pairs: DataFrame, docs: DataFrame, plan: Plan, label: str) -> DataFrame:
    """Written links (a, b): the pairs (a, b) whose whole sets link."""
    pairs = written(pairs, f"{label}-pairs")
    ids = written(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), f"{label}-ids")
    sets = whole_sets(only(docs, ids, plan, "left_semi"), plan)
    sets = written(sets, f"{label}-sets")
    left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    common = F.size(F.array_intersect("sa", "sb"))
    linked = pairs.join(left, "a").join(right, "b").where(common * (plan.p + plan.q) >= plan.p * (F.size("sa") + F.size("sb")))
    out = written(linked.select("a", "b").distinct(), label)
    drop(pairs, ids, sets)
    return out


def by_prefix(docs: DataFrame, comps: DataFrame, plan: Plan) -> DataFrame:
    """Candidates (a, b) among the members of hot lists: two linked sets have a first common shingle in the order of their rarity.

    A list is hot where many texts share a passage and don't link. With n shingles in a set, the r-th rarest is the
    first common one only if the n - r + 1 from there on are enough for the intersection, which bounds the size of the
    partner from above (``most``). What the texts share is frequent among them and comes after what they don't share,
    so it brings together those whose own shingles are few enough to link. The lists of frequent shingles are
    parted by bands of the smaller set's size, and pairs within a list's largest component are never formed.
    """
    sets = whole_sets(docs, plan).withColumn("of", F.xxhash64("shingles")).withColumn("n", F.size("shingles"))
    each = sets.select("node", "of", "n", F.explode("shingles").alias("s"))
    common = each.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")  # what one set has finds nothing, but is the rarest
    ranked = each.join(common, "s", "left").withColumn("r", F.row_number().over(Window.partitionBy("node", "of").orderBy(F.coalesce("df", F.lit(1)), "s")))
    most = F.expr(f"least(n * {plan.q} div {plan.p}, ((n - r + 1) * {plan.p + plan.q} - n * {plan.p}) div {plan.p})")
    prefix = ranked.where("df is not null").withColumn("least", F.expr(f"(n * {plan.p} + {plan.q - 1}) div {plan.q}")).withColumn("most", most).where("least <= most")
    placed = prefix.join(comps, "node", "left").select("s", "df", "node", "n", "least", "most", F.coalesce("component", "node").alias("component"))
    # Bands of the smaller size, some 3 % wide. Lists of few sets have one.
    band = lambda size: F.floor(F.log(size.cast("double")) * 32).cast("int")
    few = F.col("df") <= plan.hot
    as_small = F.when(few, F.lit(0)).otherwise(band(F.col("n")))
    as_large = F.when(few, F.array(F.lit(0))).otherwise(F.sequence(band(F.col("least")), band(F.least("n", "most"))))
    small = placed.where("most >= n").select("s", as_small.alias("band"), "node", "n", "least", "most", "component", F.lit(True).alias("small"))
    large = placed.select("s", F.explode(as_large).alias("band"), "node", "n", "least", "most", "component", F.lit(False).alias("small"))
    rows = written(small.union(large), "prefixes")
    parts = rows.groupBy("s", "band", "component").agg(F.count("*").alias("c"))
    mains = written(parts.groupBy("s", "band").agg(F.count("*").alias("parts"), F.max_by("component", F.struct("c", "component")).alias("main")).where("parts > 1").drop("parts"), "prefix-mains")
    met = written(rows.join(mains, ["s", "band"]), "prefix-members")
    drop(rows, mains)
    x, y = met.where("component <> main").alias("x"), met.alias("y")
    order = F.expr("x.small <> y.small and x.small = (x.n < y.n or (x.n = y.n and x.node < y.node))")
    fits = F.expr("x.s = y.s and x.band = y.band and x.component <> y.component and x.n between y.least and y.most and y.n between x.least and x.most")
    pairs = written(x.join(y, fits & order).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), "prefix-pairs")
    drop(met)
    return pairs


def link_classes(docs: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """(node, component) over one document of each class (rows without a link may be missing). docs: (doc_id, text); sets: of ``measure_sets`` for these documents."""
    more: dict[int, set[int]] = {}
    for salt, band in sets.where("salt > 0").select("salt", "band").distinct().collect():  # at most SALTS times the number of bands
        more.setdefault(salt, set()).add(band)
    rows = docs.mapInArrow(lambda it: emit(it, plan, more), "key bigint, node bigint, info bigint, segment int")
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    dealt = rows.repartition(parts, "key").sortWithinPartitions("key")
    kept = dealt.mapInArrow(shared_keys, "key bigint, node bigint, info bigint, segment int")
    found = written(
        kept.select("key", "node", "segment", (F.col("info").bitwiseAND(31)).cast("int").alias("salt"), F.expr("shiftright(info, 7)").alias("n"), F.expr("(info & 32) <> 0").alias("own"), F.expr("(info & 64) <> 0").alias("deletion")),
        "index",
    )
    lists = found.groupBy("key").agg(
        F.count_if(~F.col("deletion")).alias("n_full"), F.count_if("deletion").alias("n_deleted"), F.min("node").alias("least"), F.max("node").alias("most"), F.max("own").alias("owned"),
    ).where("least <> most and owned and n_full > 0")
    found2 = written(found.join(lists.drop("most", "owned"), "key"), "lists")
    drop(found)

    # Star round: each set against the smallest members of the lists that it shares most with.
    sizes_fit = F.col("n") * plan.p <= F.col("n_least") * plan.q
    least = found2.where("node = least").select("key", F.col("n").alias("n_least"), F.col("deletion").alias("d_least")).groupBy("key").agg(F.max("n_least").alias("n_least"), F.min("d_least").alias("d_least"))
    star = found2.where("node <> least").join(least, "key").where(sizes_fit & (F.col("n_least") * plan.p <= F.col("n") * plan.q) & ~(F.col("deletion") & F.col("d_least")))
    best = star.groupBy("node", "least").agg(F.count("*").alias("c")).withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("c"), "least"))).where("r <= 2")
    links = verify(best.select(F.col("least").alias("a"), F.col("node").alias("b")), docs, plan, "star")
    comps = written(components(links, "star-components"), "components")

    # Allocation: units of weight 1 by cost; a set leaves out its most expensive ones as far as its weight allows.
    one = F.min("h1") == F.max("h1")  # an id with several sets of a size has no map
    spare = sets.groupBy("doc_id", "n").agg(F.min("slack").alias("slack"), F.max("salt").alias("salt"), *[F.when(one, F.max(f)).alias(f) for f in MAP]).withColumnRenamed("doc_id", "node")
    maps = spare.select("node", "n", *MAP)
    spare = spare.drop(*MAP)
    mine = found2.where("own").join(spare, ["node", "n", "salt"])
    costs = mine.groupBy("node", "n", "segment", "slack").agg(
        F.coalesce(F.max(F.when(~F.col("deletion"), F.col("n_full") - 1)), F.lit(0)).alias("c0"),
        F.sum(F.when(F.col("deletion"), F.col("n_full")).otherwise(F.col("n_deleted"))).alias("c1"),
    )
    units = costs.select("node", "n", "segment", "slack", F.explode(F.array(F.struct(F.lit(0).alias("level"), F.col("c0").alias("cost")), F.struct(F.lit(1).alias("level"), F.greatest("c0", "c1").alias("cost")))).alias("u")).select("*", "u.*")
    ranked = units.withColumn("r", F.row_number().over(Window.partitionBy("node", "n").orderBy(F.desc("cost"), F.desc("level"), "segment")))
    chosen = ranked.groupBy("node", "n", "segment").agg(F.max((F.col("level") == 0) & (F.col("r") > F.col("slack"))).alias("v0"), F.max((F.col("level") == 1) & (F.col("r") > F.col("slack"))).alias("v1"))

    # Pairs of different components, without those within the largest component of a list.
    placed = found2.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    by_part = placed.groupBy("key", "component").agg(F.count("*").alias("c"))
    largest = by_part.groupBy("key").agg(F.count("*").alias("parts"), F.max_by("component", F.struct("c", "component")).alias("main"), (F.sum("c") - F.max("c")).alias("others")).where("parts > 1").drop("parts")
    largest = written(largest, "largest")
    hot = written(placed.join(largest.where(F.col("others") > plan.hot).select("key"), "key").select(F.col("node").alias("doc_id")).distinct(), "hot")
    flagged = (
        placed.join(largest.where(F.col("others") <= plan.hot).drop("others"), "key")
        .join(spare.select("node", "n", "salt", F.lit(True).alias("resolves")), ["node", "n", "salt"], "left")
        .join(chosen, ["node", "n", "segment"], "left")
        .join(maps, ["node", "n"], "left")
        .select("key", "node", "n", "deletion", "component", "main", *MAP, *[(F.col("own") & F.coalesce("resolves", F.lit(False)) & F.coalesce(c, F.lit(False))).alias(c) for c in ("v0", "v1")])
    )
    flagged = written(flagged, "members")
    drop(found2)
    x = flagged.where("component <> main").alias("x")
    y = flagged.alias("y")
    smaller = F.expr("x.n < y.n or (x.n = y.n and x.node < y.node)")
    finds = lambda s, t: F.expr(f"(not {s}.deletion and not {t}.deletion and {s}.v0) or (({s}.deletion <> {t}.deletion) and {s}.v1)")
    differ = " + ".join(f"bit_count(x.{f} ^ y.{f})" for f in MAP)
    near = F.expr(f"coalesce(({differ}) * {plan.p + plan.q} <= (x.n + y.n) * {plan.q - plan.p}, true)")
    pairs = x.join(y, F.expr(f"x.key = y.key and x.component <> y.component and x.n * {plan.p} <= y.n * {plan.q} and y.n * {plan.p} <= x.n * {plan.q}") & near & ((smaller & finds("x", "y")) | (~smaller & finds("y", "x"))))
    pairs = pairs.select(F.expr("least(x.node, y.node)").alias("a"), F.expr("greatest(x.node, y.node)").alias("b")).distinct()
    if not hot.isEmpty():
        pairs = pairs.union(by_prefix(only(docs, hot, plan, "left_semi"), comps, plan)).distinct()
    more_links = verify(pairs, docs, plan, "rest")
    drop(flagged, largest, hot)
    out = components(links.union(more_links), "components")
    drop(links, more_links, comps)
    return out


def near_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", plan: Plan = Plan()) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id): of every row its set's size, the smallest id that it reaches by links, and the smallest id of an equal set."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = written(measure_sets(docs, plan), "sets")
    named = sets.where("n > 0 and doc_id is not null")
    classes = named.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("class_id"))
    member = written(sets.join(classes, ["n", "h1", "h2"], "left").withColumn("class_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))), "classes")
    drop(sets)
    leaders = member.where("n > 0 and doc_id = class_id")
    followers = written(member.where("doc_id <> class_id").select("doc_id").distinct().join(leaders.select("doc_id"), "doc_id", "left_anti"), "followers")
    rest = only(docs.where("doc_id is not null and text is not null"), followers, plan, "left_anti")
    found = link_classes(rest, leaders.drop("class_id", "h2"), plan)
    repeated = member.where("n > 0 and doc_id <> class_id").join(leaders.select("doc_id").distinct(), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
    drop(followers)
    if not repeated.isEmpty():  # an id with several texts that leads one class and follows in another ties them
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(repeated), "components")
    found = found.select(F.col("node").alias("class_id"), "component")
    return member.join(found, "class_id", "left").select(F.col("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "class_id").alias("component_id"), "class_id")


def one_of_each(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", plan: Plan = Plan()) -> DataFrame:
    """The rows of ``df`` that are alone or lead their component, one of each id and text; all columns unchanged. Rows without an id or words stay."""
    found = near_duplicates(df, text_col, id_col, plan)
    dropped = written(found.where("n_shingles > 0 and doc_id <> component_id").select("doc_id").distinct(), "dropped")
    twice = written(found.where("n_shingles > 0 and doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    few = lambda ids: F.broadcast(ids) if ids.count() <= plan.most_broadcast else ids
    name = fresh(df, "key")
    key = lambda ids: few(ids.withColumnRenamed("doc_id", name))
    mine = lambda rows: F.col(f"`{id_col}`") == F.col(name)
    kept = df.join(key(dropped), mine(df), "left_anti")
    if twice.isEmpty():
        return kept
    # Ids with several rows are few; only theirs are compared.
    plain = kept.join(key(twice), mine(kept), "left_anti")
    again = kept.join(key(twice), mine(kept), "left_semi")
    return plain.unionByName(again.dropDuplicates([id_col, text_col]))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """Candidates by shared shingles, exact verification, and a recursive closure, in DuckDB SQL."""
    return r"""
with recursive w as materialized (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
s as materialized (
  select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
         else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(list_slice(ws, i, i + 4), ' ')) end) as sh from w),
t as materialized (select doc_id, len(sh) as n, hash(x) as x from (select doc_id, sh, unnest(sh) as x from s)),
p as materialized (select a.doc_id as a, b.doc_id as b from t a join t b on a.x = b.x and a.doc_id < b.doc_id
      group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e as materialized (select a as u, b as v from p union all select b, a from p),
r(node, root) as (select doc_id, doc_id from s union select e.v, r.root from r join e on e.u = r.node),
c as (select node, min(root) as component_id from r group by node),
k as (select doc_id, min(doc_id) over (partition by case when len(sh) = 0 then cast(doc_id as varchar) else cast(list_sort(sh) as varchar) end) as class_id from s)
select s.doc_id, cast(len(sh) as bigint) as n_shingles, component_id, class_id from s join c on s.doc_id = c.node join k on k.doc_id = s.doc_id
"""


QUERIES = {"op2_ngram_jaccard_join": op2_ngram_jaccard_join}
ORACLES = {"op2_ngram_jaccard_join": oracle()}
