"""Token ids of a corpus as compressed binary files, in the order of the documents' ids.

Documents are dealt by ranges of their ids, so every task writes one run of them, and the
files in order are the corpus in order. A task encodes its texts and writes files of
about ``most_ids`` ids:

    header   magic, part and number of the file, documents, ids, different ids, pairs, phrases, phrases in a block
    table    the different ids, how many pairs each round has, the pairs, and the phrases that
             occur, the most frequent first; deflated
    index    for each document its id (and whether it has one) and how many ids it has; deflated
    blocks   for each: how many phrases, how many bytes, crc32 of the ids, crc32 of the bytes, the bytes
    end      crc32 of all of the above, and an end mark

A phrase is an id or a pair of phrases: in a few rounds the neighbours that occur together
most often become one phrase, so the coder takes about half as many steps as there are
ids. Blocks hold ranks of phrases in the table, coded by ``mixing``; each is reset and
checked on its own. A reader gets a whole file and decodes its blocks side by side. Where
a document starts in the corpus follows from sums over the files, in two steps, so no
task lists all of them.

The text side runs the tokenizers library. A vocabulary that lowers case, splits at
white space, drops it and splits letters from marks (checked in its file) encodes
different words once: a worker keeps the ids of words of up to ``LONGEST`` bytes in two-way
slots by their 64-bit hashes, of a fixed number; other vocabularies get whole texts. A new
word of Latin letters alone, which normalisation and the split leave whole, goes to the
library's model at once; others go through all of it, some at a time with a special token
between them.

Defined results: a null or empty text has the end id alone. Documents come by id, those
without one first, then by their text's hash and length; repeated rows are documents of
their own. A text of any length is encoded whole; so is a single word. An empty table
gives no files and no rows. Extra columns are never read. A file that is cut short or
changed raises ValueError.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bytes as B
from . import mixing
from .shared import delete_path, drop, new_path, table, written
from .tokens import locate

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
#: Ids in a file, and phrases in a block.
MOST_IDS, BLOCK = 8_000_000, 1024
#: Pairs that each round makes phrases of, at most, and how often they must occur.
ROUNDS, LEAST = (32_000, 16_000, 8_000), 8
#: Neighbours that are looked up at once.
STRETCH = 1 << 16
#: New words that the library gets as one text; with many more each takes longer.
JOINED = 20
#: Letters that stand for themselves or for their lower case, whatever letters stand beside them, and words of them.
LATIN = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100))]
_latin = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
#: Slots for known words, their longest, and ids that are kept for them.
SLOTS, LONGEST, POOL = 1 << 21, 64, 1 << 24
#: An ASCII letter and one of these marks never share a match of the split pattern, nor a special token.
_LETTER = B.LETTER & (np.arange(256) < 0x80)
_MARK = np.isin(np.arange(256), np.frombuffer(b'.,;:!?()"-#$%&*+/=@[]\\^_`{}~', np.uint8))
#: 1 for such a letter, 2 for such a mark, and 4 for what is in words.
_KINDS = (_LETTER + 2 * _MARK + 4 * B.WORD).astype(np.uint8).tobytes()
_LOWER = B.LOWER.tobytes()
MAGIC, END = b"TDMKIDS3", b"TDMK.\n"
HEADER = struct.Struct("<8sqqqqqqqq")
OF_BLOCK = struct.Struct("<IIII")
U64 = np.uint64
_SPREAD = np.uint32(0x9E3779B1)


# --- encoding ---------------------------------------------------------------------


def expanded(starts: np.ndarray, sizes: np.ndarray, pool: np.ndarray) -> np.ndarray:
    """pool[start : start + size] of each, one after another."""
    ends = np.cumsum(sizes)
    return pool[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Words:
    """Encodes texts with one library vocabulary, remembering words."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(locate(vocabulary))
        tok.no_truncation()
        tok.no_padding()
        self.library = lambda texts: [x.ids for x in tok.encode_batch_fast(texts, add_special_tokens=False)]
        # White space parts words where the split pattern drops it, and no normalisation joins across it.
        steps = tok.pre_tokenizer.__getstate__().decode() if tok.pre_tokenizer else ""
        # So do letters and marks, and case is none of what is left then.
        self.parted = "Lowercase" in (tok.normalizer.__getstate__().decode() if tok.normalizer else "") and r"[^\\s\\p{L}\\p{N}]+" in steps and '"Removed"' in steps and '"invert":true' in steps and "Metaspace" not in steps
        added = tok.get_added_tokens_decoder()
        # A special token parts a text before anything else is done with it. One that no word without "<" can be a part of:
        between = [(i, t.content) for i, t in sorted(added.items()) if t.special and not (t.normalized or t.lstrip or t.rstrip or t.single_word)]
        self.between = between[0] if between and all(t.content.startswith("<") for t in added.values()) else None
        self.model = tok.model
        self.letters = self._letters(tok) if self.parted and r"[\\p{L}]+" in steps else None
        self.forget()

    def _letters(self, tok) -> dict[int, str] | None:
        """What the model gets for each of the ``LATIN`` letters, or None where that isn't what the library makes of them."""
        parts = [tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(x)) for x in LATIN]
        if any(len(x) != 1 for x in parts):
            return None
        letters = {ord(x): part[0][0] for x, part in zip(LATIN, parts, strict=True)}
        words = [*LATIN, "".join(LATIN), *map("".join, itertools.pairwise(LATIN))]
        return letters if all([t.id for t in self.model.tokenize(x.translate(letters))] == ids for x, ids in zip(words, self.library(words), strict=True)) else None

    def of_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``runs`` of words of ``LATIN`` letters."""
        found = [[t.id for t in self.model.tokenize(x.translate(self.letters))] for x in words]
        return np.fromiter(itertools.chain.from_iterable(found), np.int32), np.fromiter(map(len, found), np.int64, len(found))

    def forget(self) -> None:
        self.keys, self.known = np.zeros(SLOTS, U64), np.zeros(SLOTS, U64)  # where a word's ids start, and in 16 bits how many
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0

    def runs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one after another, and how many each has."""
        if self.between and len(words) > 1 and not any("<" in x for x in words):
            mark, text = self.between
            found = self.library([text.join((*words[i : i + JOINED], "")) for i in range(0, len(words), JOINED)])
            ids = np.fromiter(itertools.chain.from_iterable(found), np.int32)
            ends = np.flatnonzero(ids == mark)
            if len(ends) == len(words):
                return ids[ids != mark], np.diff(ends, prepend=-1) - 1
        found = self.library(words)
        return np.fromiter(itertools.chain.from_iterable(found), np.int32), np.array([len(x) for x in found], np.int64)

    def _put(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where new runs of ids are in the pool, and their sizes."""
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool[: self.used], np.zeros(max(len(ids), len(self.pool)), np.int32)))
        self.pool[self.used : self.used + len(ids)] = ids
        starts = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        return starts, sizes

    def encode(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, how many of each row) of a column of texts, some rows at a time."""
        if not self.parted:
            for at in range(0, len(column), 500):
                found = self.library([t or "" for t in column.slice(at, 500).to_pylist()])
                yield np.fromiter((i for x in found for i in x), np.int32), np.array([len(x) for x in found], np.int64)
            return
        for _, _, buf, offsets in B.chunks(column):
            data = buf.tobytes()
            if b"<|" not in data:  # the normaliser does the same; special tokens are matched before it
                data = data.translate(_LOWER)
            kinds = np.frombuffer(data.translate(_KINDS), np.uint8)
            new = np.zeros(len(buf) + 1, bool)
            new[1:-1] = (kinds[:-1] | kinds[1:]) & 3 == 3
            new[offsets] = True
            first, last, index = B.runs(kinds > 3, new, offsets)
            if self.used > POOL:
                self.forget()
            starts, sizes = self._words(data, first, last)
            upto = np.concatenate(([0], np.cumsum(sizes)))
            yield expanded(starts, sizes, self.pool), np.diff(upto[index])

    def _words(self, data: bytes, first, last) -> tuple[np.ndarray, np.ndarray]:
        h = B.hashes(np.frombuffer(data, np.uint8), first, last)
        h[h == 0] = 1  # 0 is an empty slot
        slot = (h >> U64(44)).astype(np.int64)
        other = (h & U64(SLOTS - 1)).astype(np.int64)
        away = np.flatnonzero(self.keys.take(slot) != h)
        place = slot.copy()
        place[away] = other.take(away)
        new = away[self.keys.take(place.take(away)) != h.take(away)]
        known = self.known.take(place)
        starts, sizes = (known >> U64(16)).astype(np.int64), (known & U64(0xFFFF)).astype(np.int64)
        if len(new):
            keys, at, back = np.unique(h[new], return_index=True, return_inverse=True)
            a, z = first[new[at]], last[new[at]]
            text = [data[i:j].decode() for i, j in zip(a.tolist(), z.tolist(), strict=True)]
            kind = np.array([0 if self.letters and _latin(x) else 1 if "<" not in x else 2 for x in text])
            where, count = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
            for k, encoded in enumerate((self.of_letters, self.runs, self.runs)):
                of = np.flatnonzero(kind == k)
                where[of], count[of] = self._put(*encoded([text[i] for i in of.tolist()]))
            starts[new], sizes[new] = where[back], count[back]
            keep = np.flatnonzero((z - a <= LONGEST) & (count < 1 << 16))
            to = np.where(self.keys[slot[new[at]]] == 0, slot[new[at]], other[new[at]])[keep]
            # Of words that want one slot the last gets it; both arrays must agree on which.
            to, last_one = np.unique(to[::-1], return_index=True)
            pick = keep[len(keep) - 1 - last_one]
            self.keys[to], self.known[to] = keys[pick], where[pick].astype(U64) << U64(16) | count[pick].astype(U64)
        return starts, sizes


_words: dict[str, Words] = {}


def words(vocabulary: str) -> Words:
    if vocabulary not in _words:
        _words[vocabulary] = Words(vocabulary)
    return _words[vocabulary]


# --- files ------------------------------------------------------------------------


def phrased(ids: np.ndarray, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ids below n (at most ``mixing.MOST_IDS``) as fewer phrases, and the pairs of phrases that each round adds; the first is phrase n."""
    found = ids.astype(np.uint16)
    rounds: list[np.ndarray] = []
    for most in ROUNDS:
        most = min(most, mixing.MOST_IDS - n)
        if most <= 0 or len(found) < 2:
            break
        key = found[:-1].astype(np.uint32)
        key <<= np.uint32(16)
        key |= found[1:]
        order = np.sort(key)
        at = np.flatnonzero(order[1:] != order[:-1])
        times = np.diff(at, prepend=-1, append=len(order) - 1)
        often = np.flatnonzero(times >= LEAST)
        if len(often) > most:
            often = often[np.argsort(-times[often], kind="stable")[:most]]
        # Of pairs that want one slot of this table the last gets it. No pair has all bits set.
        pairs = order[np.append(at, len(order) - 1)[often]]
        del order, at, times
        held = np.full(1 << 20, 2**32 - 1, np.uint32)
        held[pairs * _SPREAD >> np.uint32(12)] = pairs
        pairs = pairs[held[pairs * _SPREAD >> np.uint32(12)] == pairs]
        if not len(pairs):
            break
        phrase = np.zeros(1 << 20, np.uint16)
        phrase[pairs * _SPREAD >> np.uint32(12)] = np.arange(n, n + len(pairs))
        places, phrases = [], []
        for i in range(0, len(key), STRETCH):
            some = key[i : i + STRETCH]
            slot = (some * _SPREAD >> np.uint32(12)).astype(np.intp)
            hit = np.flatnonzero(held.take(slot) == some)
            places.append((hit + i).astype(np.int32 if len(key) < 2**31 else np.int64))
            phrases.append(phrase.take(slot.take(hit)))
        hit, new = np.concatenate(places), np.concatenate(phrases)
        del places, phrases, key
        # Of pairs that overlap every other one is taken, from the first of them on.
        first = np.flatnonzero(np.diff(hit, prepend=-2) > 1)
        odd = np.arange(len(hit), dtype=np.uint8)
        odd -= np.repeat(first.astype(np.uint8), np.diff(first, append=len(hit)))
        taken = odd & 1 == 0
        hit = hit[taken]
        found[hit] = new[taken]
        keep = np.ones(len(found), bool)
        keep[hit + 1] = False
        found = found[keep]
        rounds.append(pairs)
        n += len(pairs)
    return found, rounds


def spelt(different: np.ndarray, rounds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the ids of each phrase are in a pool, how many they are, and the pool."""
    starts, sizes, pool = np.arange(len(different)), np.ones(len(different), np.int64), different
    for pairs in rounds:
        parts = np.stack((pairs >> np.uint32(16), pairs & np.uint32(0xFFFF)), axis=1).ravel()
        need(int(parts.max()) < len(sizes), "its phrases don't fit")
        ids, each = expanded(starts[parts], sizes[parts], pool), sizes[parts].reshape(-1, 2).sum(axis=1)
        starts, sizes, pool = np.append(starts, len(pool) + np.cumsum(each) - each), np.append(sizes, each), np.append(pool, ids)
    return starts, sizes, pool


def packed(part: int, number: int, doc_ids: np.ndarray, named: np.ndarray, sizes: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A file of the ids of some documents."""
    different = np.flatnonzero(np.bincount(ids))
    if len(different) > mixing.MOST_IDS:
        raise ValueError(f"at most {mixing.MOST_IDS} different ids")
    place = np.zeros(int(different[-1]) + 1 if len(different) else 0, np.uint16)
    place[different] = np.arange(len(different))
    found, rounds = phrased(place.take(ids), len(different))
    counts = np.bincount(found)
    used = np.flatnonzero(counts)
    used = used[np.argsort(-counts[used], kind="stable")]
    rank = np.zeros(len(counts), np.uint32)
    rank[used] = np.arange(len(used), dtype=np.uint32)
    ranks = rank.take(found)
    cut = range(0, len(found), block)
    payloads = mixing.encode([ranks[i : i + block] for i in cut])
    pairs = np.concatenate([*rounds, np.zeros(0, np.uint32)])
    columns = [different.astype("<u4"), np.array([len(x) for x in rounds], "<u4"), (pairs >> np.uint32(16)).astype("<u2"), pairs.astype("<u2"), used.astype("<u2")]
    squeezed = [zlib.compress(x) for x in (b"".join(x.tobytes() for x in columns), doc_ids.astype("<i8").tobytes() + named.astype(np.uint8).tobytes() + sizes.astype("<i8").tobytes())]
    out = [HEADER.pack(MAGIC, part, number, len(doc_ids), len(ids), len(different), len(rounds), len(pairs), block)]
    for x in squeezed:
        out += [struct.pack("<I", len(x)), x]
    raw = memoryview(ids.astype("<u4").tobytes())
    ends = np.cumsum(spelt(different, rounds)[1].take(found))
    first = 0
    for i, p in zip(cut, payloads, strict=True):
        last = 4 * int(ends[min(i + block, len(found)) - 1])
        out += [OF_BLOCK.pack(len(ranks[i : i + block]), len(p), zlib.crc32(raw[first:last]), zlib.crc32(p)), p]
        first = last
    body = b"".join(out)
    return body + struct.pack("<I", zlib.crc32(body)) + END


def need(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(f"token file: {what}")


def unpacked(data: bytes) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What ``packed`` was given: (part, number, doc_ids, named, sizes, ids)."""
    need(len(data) >= HEADER.size + 4 + len(END) and data.endswith(END), "cut short")
    body = data[: -len(END) - 4]
    magic, part, number, n_docs, n_ids, n_different, n_rounds, n_pairs, block = HEADER.unpack_from(body)
    need(magic == MAGIC, "of another kind")
    need(struct.unpack("<I", data[-len(END) - 4 : -len(END)])[0] == zlib.crc32(body), "its checksum doesn't hold")
    at = HEADER.size
    raw = []
    for _ in range(2):
        size = struct.unpack_from("<I", body, at)[0]
        raw.append(zlib.decompress(body[at + 4 : at + 4 + size]))
        at += 4 + size
    of_table = 4 * (n_different + n_rounds + n_pairs)
    need(len(raw[0]) >= of_table and len(raw[1]) == 17 * n_docs, "its index doesn't fit")
    different, of_rounds = np.split(np.frombuffer(raw[0], "<u4", n_different + n_rounds), [n_different])
    left, right = np.frombuffer(raw[0], "<u2", 2 * n_pairs, 4 * (n_different + n_rounds)).reshape(2, -1).astype(np.uint32)
    need(int(of_rounds.sum()) == n_pairs, "its pairs don't fit")
    starts, spans, pool = spelt(different, np.split(left << np.uint32(16) | right, np.cumsum(of_rounds)[:-1]) if n_rounds else [])
    used = np.frombuffer(raw[0], "<u2", offset=of_table)
    need(not len(used) or int(used.max()) < len(spans), "its phrases don't fit")
    starts, spans = starts[used], spans[used]
    doc_ids, sizes = np.frombuffer(raw[1][: 8 * n_docs], "<i8"), np.frombuffer(raw[1][9 * n_docs :], "<i8")
    named = np.frombuffer(raw[1][8 * n_docs : 9 * n_docs], np.uint8).astype(bool)
    lengths, sums, payloads = [], [], []
    while at < len(body):
        n, size, of_ids, of_bytes = OF_BLOCK.unpack_from(body, at)
        payload = body[at + OF_BLOCK.size : at + OF_BLOCK.size + size]
        need(zlib.crc32(payload) == of_bytes, f"block {len(sums)} has changed")
        lengths.append(n)
        sums.append(of_ids)
        payloads.append(payload)
        at += OF_BLOCK.size + size
    need(n_ids == int(sizes.sum()), "its index doesn't fit")
    found = np.minimum(np.concatenate([*mixing.decode(payloads, lengths), np.zeros(0, np.uint32)]), max(len(used) - 1, 0))
    each = spans.take(found) if len(found) else np.zeros(0, np.int64)
    ids = expanded(starts.take(found), each, pool) if len(found) else np.zeros(0, "<u4")
    raw_ids, ends = memoryview(ids.tobytes()), np.concatenate(([0], np.cumsum(each)))[np.cumsum([0, *lengths])]
    for k, (i, j, crc) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), sums, strict=True)):
        need(zlib.crc32(raw_ids[4 * i : 4 * j]) == crc, f"block {k} doesn't decode")
    need(len(ids) == n_ids, "its blocks don't fit")
    return part, number, doc_ids, named, sizes, ids


# --- the corpus -------------------------------------------------------------------


def write(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", most_ids: int = MOST_IDS, block: int = BLOCK) -> None:
    """Encode every text, append ``end_id`` to each, and write all ids under ``path`` in ascending order of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def done() -> pa.RecordBatch:
            doc_ids, named, sizes, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            data = packed(part, number, doc_ids, named, sizes, ids, block)
            return pa.RecordBatch.from_arrays([pa.array([data[:-1]], pa.binary())], ["data"])  # the writer ends the line

        for b in batches:
            at = 0
            for ids, sizes in words(vocabulary).encode(b.column(1)):
                mine = b.column(0).slice(at, len(sizes))
                at += len(sizes)
                ends = np.cumsum(sizes)
                held.append((mine.fill_null(0).to_numpy(), mine.is_valid().to_numpy(zero_copy_only=False), sizes + 1, np.insert(ids, ends, end_id)))
                size += len(ids) + len(sizes)
                if size >= most_ids:
                    yield done()
                    held, size, number = [], 0, number + 1
        if held:
            yield done()

    text = F.col(text_col)
    keys = [F.col("id").asc_nulls_first(), F.col("h"), F.col("n")]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"), F.octet_length(text).alias("n"))
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("id", "text")
    dealt.mapInArrow(run, "data binary").select(F.col("data").cast("string")).write.option("lineSep", "\n").option("maxRecordsPerFile", 1).text(path)


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(part, number, place, doc_id, in_file, n_tokens, ids_crc32) of the documents in the files under ``path``, with their ids if asked for.

    in_file: ids of the file before the document.
    """
    schema = "part bigint, number bigint, place bigint, doc_id bigint, in_file bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                part, number, doc_ids, named, sizes, ids = unpacked(data.as_py())
                n, ends = len(sizes), np.cumsum(sizes)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - s) : 4 * e]) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                for at in range(0, n, 10_000):
                    some = slice(at, at + 10_000)
                    columns = [pa.array(np.full(len(sizes[some]), part)), pa.array(np.full(len(sizes[some]), number)), pa.array(np.arange(n)[some]), pa.array(doc_ids[some], pa.int64(), mask=~named[some]), pa.array((ends - sizes)[some]), pa.array(sizes[some]), pa.array(crc[some], pa.int64())]
                    if with_ids:
                        bounds = np.append((ends - sizes)[some], ends[some][-1])
                        columns.append(pa.ListArray.from_arrays(pa.array((bounds - bounds[0]).astype(np.int32)), pa.array(ids[bounds[0] : bounds[-1]].astype(np.int64))))
                    yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(path)
    return files.select("content").mapInArrow(run, schema)


def placed(found: DataFrame, group: int = 1000) -> DataFrame:
    """``read`` with ``start``, the ids of all documents before: files are added up within groups of parts, then the groups."""
    files = found.groupBy("part", "number").agg(F.sum("n_tokens").alias("n")).withColumn("g", F.floor(F.col("part") / group))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    inner = files.select("part", "number", "g", F.coalesce(F.sum("n").over(earlier(Window.partitionBy("g").orderBy("part", "number"))), zero).alias("inner"))
    groups = files.groupBy("g").agg(F.sum("n").alias("n")).select("g", F.coalesce(F.sum("n").over(earlier(Window.orderBy("g"))), zero).alias("outer"))
    base = inner.join(groups, "g").select("part", "number", (F.col("inner") + F.col("outer")).alias("base"))
    return found.join(base, ["part", "number"]).withColumn("start", F.col("base") + F.col("in_file")).drop("base")


def stored(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` to files of the shared folder and say what the files hold when they are read back; the files are deleted then."""
    spark = docs.sparkSession
    path = new_path(spark, "ids")
    write(docs, path, **options)
    found = written(read(spark, path), "ids_read")
    delete_path(spark, path)
    done = written(placed(found).select("doc_id", "start", "n_tokens", "ids_crc32"), "ids_placed")
    drop(found)
    return done


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(table(spark, sf_dir, "documents"))


QUERIES = {"op13_token_files": op13_token_files}
#: The ids of a trained vocabulary can't be expressed in SQL; tests/llm compares with the library.
ORACLES: dict[str, str] = {}
