"""The prefix trie of conversations: which turns many conversations begin with, and what sharing them saves.

Each conversation is a path of turns. The smallest conversation that begins with a
prefix owns its node, and with a node all deeper ones of its path: every conversation
owns a suffix of its path. Windows over prefixes mark the owned nodes (first within
salted parts of a prefix, then among the parts' smallest, so that a prefix that all
conversations share isn't one task). From then on a conversation is told by where its
suffix begins, and one group-by over prefixes adds up tokens of occurrences minus owned
ones, leaves and children.

A prefix is known by two 64-bit hashes: exclusive-ors of the hashes of (place, role,
text) of its turns, so it is a running aggregate. A conversation of any length is
numbered and added up in the parts that a range partitioning cuts it into; no key, be
it a conversation or a prefix, has to fit in one task. What one task alone reads is the
list of the conversations that end at one node, as its SHA-256 needs them in order: it
comes as joined blocks of ids and is streamed, a block at a time.

Defined results: rows without a conversation id are left out; null roles and texts are
empty. Turns are ordered by number, nulls first, and equal numbers by role and text;
repeated rows are turns of their own. An empty table has no nodes. Extra columns are
never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import drop, table, written

#: Parts of a prefix in the first window at least (else as many as a shuffle has partitions); ids in a block that is hashed; turns that a conversation can take over.
SALTS, BLOCK, MOST_HEAD = 32, 512, 8
CHUNK = ["conv_id", "chunk"]
NODE = ["p1", "p2"]


def _before(value: Column, by: str, *key: str) -> Column:
    """The sum of a column over the rows before this one."""
    return F.coalesce(F.sum(value).over(Window.partitionBy(*key).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def turns(df: DataFrame) -> DataFrame:
    """(conv_id, chunk, place, x, y, bytes) of every turn: its place, from 1, within its part of the conversation, two hashes of role and text, and the text's bytes."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = df.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    dealt = rows.repartitionByRange(F.col("conv_id"), *order).withColumn("chunk", F.spark_partition_id())
    place = F.row_number().over(Window.partitionBy(*CHUNK).orderBy(*order)).cast("long")
    return dealt.select(*CHUNK, place.alias("place"), F.xxhash64("role", "text").alias("x"), F.xxhash64(F.lit(7), "text", "role").alias("y"), F.octet_length("text").cast("long").alias("bytes"))


def ranked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """turns with ``rank``, their place in the whole conversation, and (conv_id, chunk, before, n_turns)."""
    counts = rows.groupBy(*CHUNK).agg(F.count("*").alias("n"))
    chunks = counts.select(*CHUNK, _before(F.col("n"), "chunk", "conv_id").alias("before"), F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"))
    return rows.join(chunks.select(*CHUNK, "before"), CHUNK).withColumn("rank", F.col("before") + F.col("place")), chunks


def paths(df: DataFrame) -> DataFrame:
    """(conv_id, chunk, depth, n_turns, x, y, bytes): conversations as they are, with a row of depth 0 for each."""
    kept = written(turns(df), "turns")
    rows, chunks = ranked(kept)
    own = rows.join(chunks.select(*CHUNK, "n_turns"), CHUNK).select(*CHUNK, F.col("rank").alias("depth"), "n_turns", "x", "y", "bytes")
    done = written(own.unionByName(_roots(chunks.select("conv_id", "n_turns").distinct())), "paths")
    drop(kept)
    return done


def _roots(convs: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return convs.select("conv_id", F.lit(-2).alias("chunk"), zero.alias("depth"), "n_turns", zero.alias("x"), zero.alias("y"), zero.alias("bytes"))


def rebuilt_paths(df: DataFrame, group: int = 5, heads: int = MOST_HEAD + 1) -> DataFrame:
    """``paths`` of conversations that take over the first turns of another one.

    Conversation c begins with the first h turns of conversation c - c % group, as far as there are, and goes on with
    its own turns after its first h; h is the crc32 of c as text, modulo ``heads``.
    """
    kept = written(turns(df), "turns")
    rows, chunks = ranked(kept)
    whole = chunks.groupBy("conv_id").agg(F.max("n_turns").alias("n_turns"))
    base = F.col("conv_id") - F.col("conv_id") % group
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    sizes = whole.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("n_base"))
    convs = whole.select("conv_id", "n_turns", base.alias("base"), h.alias("h")).join(sizes, "base", "left")
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = convs.select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("n_turns"))
    head = rows.where((F.col("rank") < heads) & (base == F.col("conv_id"))).select(F.col("conv_id").alias("base"), F.col("rank").alias("depth"), "x", "y", "bytes")
    first = convs.where("taken > 0").join(head, "base").where("depth <= taken").select("conv_id", F.lit(-1).alias("chunk"), "depth", "n_turns", "x", "y", "bytes")
    # A long conversation's parts get what is known of it; the rows find it by their part.
    known = chunks.select(*CHUNK).join(convs.select("conv_id", "h", "taken", "n_turns"), "conv_id")
    own = rows.join(known, CHUNK).where("rank > h").select(*CHUNK, (F.col("taken") + F.col("rank") - F.col("h")).alias("depth"), "n_turns", "x", "y", "bytes")
    done = written(first.unionByName(own).unionByName(_roots(convs.select("conv_id", "n_turns"))), "paths")
    drop(kept)
    return done


def prefixes(path: DataFrame) -> DataFrame:
    """paths with ``p1`` and ``p2``, the prefix that ends here, ``q1`` and ``q2``, the one before, and ``upto``, the bytes of its turns."""
    some = F.col("depth") > 0
    e = [F.when(some, F.xxhash64(F.lit(k), "depth", "x", "y")).otherwise(F.lit(0).cast("long")) for k in (1, 2)]
    rows = path.select(*CHUNK, "depth", "n_turns", "bytes", e[0].alias("e1"), e[1].alias("e2"))
    so_far = Window.partitionBy(*CHUNK).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("*", F.bit_xor("e1").over(so_far).alias("l1"), F.bit_xor("e2").over(so_far).alias("l2"), F.sum("bytes").over(so_far).alias("l"))
    totals = rows.groupBy(*CHUNK).agg(F.bit_xor("e1").alias("t1"), F.bit_xor("e2").alias("t2"), F.sum("bytes").alias("t"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = totals.select(*CHUNK, F.coalesce(F.bit_xor("t1").over(earlier), zero).alias("s1"), F.coalesce(F.bit_xor("t2").over(earlier), zero).alias("s2"), F.coalesce(F.sum("t").over(earlier), zero).alias("s"))
    joined = local.join(starts, CHUNK)
    p1, p2 = F.col("l1").bitwiseXOR(F.col("s1")), F.col("l2").bitwiseXOR(F.col("s2"))
    return joined.select("conv_id", "depth", "n_turns", "bytes", (F.col("l") + F.col("s")).alias("upto"), p1.alias("p1"), p2.alias("p2"), p1.bitwiseXOR(F.col("e1")).alias("q1"), p2.bitwiseXOR(F.col("e2")).alias("q2"))


def owners(rows: DataFrame, salts: int | None = None) -> DataFrame:
    """(conv_id, owned, shared, leaf): the depth at which a conversation's own suffix begins, the bytes before it, and whether it owns a leaf.

    Conversations that own nothing, copies of smaller ones, are not in it.
    """
    salts = salts or max(SALTS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(salts)))
    part, node = Window.partitionBy(*NODE, "salt"), Window.partitionBy(*NODE)
    least = salted.select("*", F.min("conv_id").over(part).alias("least"), F.max("n_turns").over(part).alias("deepest")).where("conv_id = least")
    marked = least.select("*", F.min("conv_id").over(node).alias("owner"), F.max("deepest").over(node).alias("end")).where("conv_id = owner")
    first = F.min(F.struct("depth", (F.col("upto") - F.col("bytes")).alias("before")))
    found = marked.groupBy("conv_id").agg(first.alias("f"), F.max(F.when(F.col("end") == F.col("depth"), 1).otherwise(0)).cast("long").alias("leaf"))
    return found.select("conv_id", F.col("f.depth").alias("owned"), F.col("f.before").alias("shared"), "leaf")


def nodes(rows: DataFrame, salts: int | None = None) -> DataFrame:
    """(p1, p2, q1, q2, conv_id, depth, owned, n_convs, n_children, n_leaves, saved_tokens) of every node of ``prefixes``."""
    known = rows.join(owners(rows, salts), "conv_id", "left")
    # A copy owns nothing: all of its turns are shared.
    copy = F.col("owned").isNull()
    deeper = (F.col("depth") < F.col("n_turns")) & F.coalesce(F.col("depth") + 1 >= F.col("owned"), F.lit(False))
    sums = rows.where("depth = n_turns").select("conv_id", F.col("upto").alias("all_bytes"))
    known = known.join(sums, "conv_id")
    before = F.col("upto") - F.col("bytes")
    unowned = F.greatest(F.when(copy, F.col("all_bytes")).otherwise(F.col("shared")) - before, F.lit(0))
    out = known.groupBy(*NODE).agg(
        F.min(F.struct("conv_id", "owned")).alias("m"), F.max("depth").alias("depth"), F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.count("*").alias("n_convs"),
        F.count_if(deeper).alias("n_children"), F.sum(F.coalesce("leaf", F.lit(0))).cast("long").alias("n_leaves"), F.sum(unowned).cast("long").alias("saved_tokens"),
    )
    return out.select(*NODE, "q1", "q2", F.col("m.conv_id").alias("conv_id"), "depth", F.col("m.owned").alias("owned"), "n_convs", "n_children", "n_leaves", "saved_tokens")


def with_parents(found: DataFrame) -> DataFrame:
    """nodes with ``parent_conv_id``: the owner itself below the first node that it owns, else the parent's owner."""
    inner = found.where("depth > owned").withColumn("parent_conv_id", F.col("conv_id"))
    root = found.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    above = found.where("n_children > 0").select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    branch = found.where("depth > 0 and depth = owned").join(above, ["q1", "q2"])  # a parent of very many children is a skewed key that AQE splits
    return inner.unionByName(root).unionByName(branch.select(*inner.columns))


def digests(ends: DataFrame, block: int = BLOCK) -> DataFrame:
    """(p1, p2, ends_sha256) of the conversations (p1, p2, conv_id) that end at each node: their ids, ascending, joined by commas."""
    part = F.floor(F.col("conv_id") / F.lit(block)).alias("part")
    joined = ends.groupBy(*NODE, part).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    return joined.repartition(*NODE).sortWithinPartitions(*NODE, "part").select(*NODE, "ids").mapInArrow(_hashed, "p1 bigint, p2 bigint, ends_sha256 string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of a node come one after another; only its digest is kept."""
    out = lambda rows: pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)], [*NODE, "ends_sha256"])
    node, digest = None, None
    for b in batches:
        done = []
        for p1, p2, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            if node == (p1, p2):
                digest.update(b",")
            else:
                if node:
                    done.append((*node, digest.hexdigest()))
                node, digest = (p1, p2), hashlib.sha256()
            digest.update(ids.as_py().encode())
        if done:
            yield out(done)
    if node:
        yield out([(*node, digest.hexdigest())])


def trie(path: DataFrame, salts: int | None = None, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of ``paths``: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    rows = written(prefixes(path), "prefixes")
    found = written(nodes(rows, salts), "nodes")
    ends = digests(rows.where("depth = n_turns").select(*NODE, "conv_id"), block)
    none = F.lit(hashlib.sha256().hexdigest())
    out = with_parents(found).join(ends, NODE, "left")
    done = written(out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")), "trie")
    drop(rows, found)
    return done


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = rebuilt_paths(table(spark, sf_dir, "conversations"))
    found = trie(path)
    drop(path)
    return found


#: crc32 bit by bit: the start, then for each byte itself and eight shifts (-1).
CRC32 = """list_reduce(list_concat([4294967295::bigint], flatten([[ascii(ch)::bigint, -1, -1, -1, -1, -1, -1, -1, -1] for ch in string_split(cast(conv_id as varchar), '')])),
  lambda a, b: case when b >= 0 then xor(a, b) else xor(a >> 1, case when a & 1 = 1 then 3988292384::bigint else 0::bigint end) end)"""
ORACLE = f"""
with t as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as r, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
c as (select conv_id, n, xor({CRC32}, 4294967295) % 9 as h, conv_id - conv_id % 5 as base from (select conv_id, count(*) as n from t group by 1)),
k as (select c.*, least(c.h, coalesce(b.n, 0)) as k from c left join c b on b.conv_id = c.base),
p as (select k.conv_id, t.r as d, role, text from k join t on t.conv_id = k.base and t.r <= k.h
  union all select k.conv_id, k.k + t.r - k.h, role, text from k join t on t.conv_id = k.conv_id and t.r > k.h),
o as (select conv_id, d, strlen(text) as b, list(struct_pack(role, text)) over (partition by conv_id order by d) as prefix from p
  union all select conv_id, 0, 0, [] from c),
e as (select *, max(d) over (partition by conv_id) as len from o),
n as (select prefix, d, min(conv_id) as conv_id, count(*) as n_convs, any_value(b) as b,
  sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (d = len), '')) as ends_sha256 from e group by 1, 2),
u as (select n.*, prefix[1:d - 1] as above from n),
kids as (select above, count(*) as n_children from u where d > 0 group by 1),
own as (select u.*, coalesce(n_children, 0) as n_children from u left join kids on kids.above = u.prefix),
sub as (select a.prefix, a.d, count(*) filter (v.n_children = 0) as n_leaves, sum((v.n_convs - 1) * v.b) as saved from own v, lateral (select unnest(range(0, v.d + 1)) as d) i, lateral (select v.prefix[1:i.d] as prefix, i.d as d) a group by 1, 2)
select own.conv_id, own.d::bigint as depth, up.conv_id as parent_conv_id, own.n_convs, own.n_children, sub.n_leaves, sub.saved::bigint as saved_tokens, own.ends_sha256
from own join sub on sub.prefix = own.prefix left join own up on own.d > 0 and up.prefix = own.above
"""

QUERIES = {"op12_prefix_trie": op12_prefix_trie}
ORACLES = {"op12_prefix_trie": ORACLE}
