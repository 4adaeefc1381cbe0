import hashlib
import random
import zlib

import pytest

from tidemark.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(rows):
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    rows = []
    for p, own in members.items():
        below = [q for q in members if q[: len(p)] == p]
        leaf = [q for q in below if not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in members)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(p))
        rows.append((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), sum(len(q) == len(p) + 1 for q in below), len(leaf), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def made(seed, n=60):
    r = random.Random(seed)
    rows = [(r.choice([*range(-7, 30), None]), r.choice([None, 1, 2, 3, 3]), r.choice(["user", "assistant", None]), r.choice(["", None, "a", "é b", "the same", "x" * 50])) for _ in range(n)]
    return rows + rows[:5]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed", [1, 2])
def test_rebuilt_conversations_are_those_of_brute_force(spark, seed):
    rows = made(seed)
    df = spark.createDataFrame([(*r, "clash", 3) for r in rows], SCHEMA + ", depth string, p1 int")
    assert found(trie.trie(trie.rebuilt_paths(df), salts=2, block=3)) == brute(rebuilt(conversations(rows)))


def test_conversations_as_they_are(spark):
    rows = made(3)
    rows += [(100 + i, j, "user", f"t{j}") for i in range(40) for j in range(3)]  # copies: only the smallest owns anything
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(trie.trie(trie.paths(df), block=7)) == brute(conversations(rows))


def test_a_conversation_is_cut_into_parts(spark):
    """One conversation holds most of all rows; its turns are numbered over several partitions."""
    rows = [(5, i // 2, "user", f"t{i % 7}") for i in range(900)] + [(6, i, "user", f"t{i}") for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so little is one part
    try:
        assert trie.turns(df).where("conv_id = 5").select("chunk").distinct().count() > 1
        assert found(trie.trie(trie.paths(df))) == brute(conversations(rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_conversations(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert found(trie.trie(trie.rebuilt_paths(df))) == []
    assert found(trie.trie(trie.rebuilt_paths(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)))) == []


def test_a_very_long_turn_and_a_conversation_without_turns(spark):
    # Of conversation 1 nothing is left where h is over its own turns and there is no conversation 0.
    lone = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    rows = [(lone, 1, "user", "only"), (700, 1, "user", "ü" * 2_000_000), (700, 2, "user", "b")]
    assert found(trie.trie(trie.rebuilt_paths(spark.createDataFrame(rows, SCHEMA)))) == brute(rebuilt(conversations(rows)))
