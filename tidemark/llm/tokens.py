"""Byte-level BPE encoding and decoding, and token counts.

Both run the public libraries inside Arrow functions; nothing is shuffled.

``encode``: tiktoken with a local rank file. A long text is first parted by a
regex at places where the split pattern always ends a match, so that no call
gets a huge string; ids are those of the whole text. ``decode`` goes from ids
to raw bytes, so an id sequence that ends inside a character is no error.

``count``: lengths only. The texts of an Arrow batch are parted at the same
kind of place, the distinct parts not yet known are encoded in batches of
about equal bytes, and each text adds up the lengths of its parts.

Defined results: a null or empty text has no tokens. Repeated rows give equal
results, empty tables give none. Extra columns are not returned.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .shared import table

RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"

#: White space between two non-space characters always begins a match of the split
#: pattern: no match of it holds white space after a non-space character.
SAFE = re.compile(r"(?<=[^\s])(?=[ \t\n\r][^\s])")
#: So does a letter after a digit or one of these marks, and the other way round: they
#: never share a match. This parts texts that have no white space.
_MARKS = "0-9.,;:!?\u3001\u3002\uff0c\uff01\uff1f"
CHANGE = regex.compile(rf"(?<=\p{{L}})(?=[{_MARKS}])|(?<=[{_MARKS}])(?=\p{{L}})")
#: Texts over so many characters are parted before they are encoded.
LONG = 50_000


def locate(name: str) -> str:
    """A path as given, or the file of that name among the public tokenizers."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


_encodings: dict = {}


def encoding(ranks: str = RANKS):
    """The tiktoken encoding of a rank file, loaded once per worker."""
    if ranks not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(locate(ranks), "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[ranks] = tiktoken.Encoding(ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
    return _encodings[ranks]


def pieces(text: str, long: int = LONG) -> list[str]:
    """The text in pieces of about ``long`` characters that end at safe places; a piece without one (one single word) stays whole."""
    if len(text) <= long:
        return [text]
    out, start = [], 0
    while len(text) - start > long:
        # Look near first: a text without white space is otherwise searched to its end again and again.
        cut = SAFE.search(text, start + long, start + 2 * long) or CHANGE.search(text, start + long, start + 2 * long) or SAFE.search(text, start + long) or CHANGE.search(text, start + long)
        if not cut:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    out.append(text[start:])
    return out


def encode_text(text: str | None, ranks: str = RANKS, long: int = LONG) -> np.ndarray:
    """The ids of one text as little-endian unsigned 32-bit integers."""
    enc = encoding(ranks)
    parts = [np.asarray(enc.encode_to_numpy(x, allowed_special=set(), disallowed_special=()), "<u4") for x in pieces(text or "", long)]
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


def decode_ids(ids, ranks: str = RANKS) -> bytes:
    """The raw bytes of ids; they needn't be valid UTF-8."""
    return encoding(ranks).decode_bytes(np.asarray(ids).tolist())


def encode(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", ranks: str = RANKS, long: int = LONG) -> DataFrame:
    """(id_col, ids array<int>) of every row."""
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [encode_text(t, ranks, long).astype(np.int32) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_col, "ids"])

    return df.select(id_col, text_col).mapInArrow(run, schema)


def decode(df: DataFrame, ids_col: str = "ids", id_col: str = "doc_id", ranks: str = RANKS) -> DataFrame:
    """(id_col, decoded binary) of every row."""
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [decode_ids([] if x is None else x, ranks) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], [id_col, "decoded"])

    return df.select(id_col, ids_col).mapInArrow(run, schema)


def round_trip(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", ranks: str = RANKS, long: int = LONG) -> DataFrame:
    """Encode and decode in one pass: number of tokens, digests of the ids and of the decoded bytes, and whether those are the text's."""
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, round_trips boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, of_ids, of_bytes, same = [], [], [], []
            for text in b.column(1):
                text = text.as_py() or ""
                ids = encode_text(text, ranks, long)
                back = decode_ids(ids, ranks)
                n.append(len(ids))
                of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
                of_bytes.append(hashlib.sha256(back).hexdigest())
                same.append(back == text.encode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string()), pa.array(same, pa.bool_())], ["a", "b", "c", "d", "e"])

    return df.select(id_col, text_col).mapInArrow(run, schema)


# --- token counts -------------------------------------------------------------

#: Distinct parts that a worker remembers and their characters, those of one part, and bytes in a batch for the library.
REMEMBERED, REMEMBERED_SIZE, SHORT, BATCH_BYTES = 300_000, 8_000_000, 64, 1 << 20
_irregular = re.compile(r"\s | \s|^\s|\s$")


def parts(text: str, long: int = LONG) -> list[str]:
    """The text in parts that end at safe places; joined they are the text."""
    if not _irregular.search(text):  # no space beside white space or the edges: every space is a safe place
        words = text.split(" ")
        found = words[:1] + [f" {w}" for w in words[1:]]
    else:
        found = SAFE.split(text)
    return found if max(map(len, found)) <= long else [x for p in found for x in pieces(p, long)]


def balanced(texts: list[str], most: int = BATCH_BYTES) -> Iterator[list[str]]:
    """The texts, longest first, in batches of at most ``most`` bytes (a longer text alone)."""
    batch, size = [], 0
    for t in sorted(texts, key=len, reverse=True):
        n = len(t.encode())
        if batch and size + n > most:
            yield batch
            batch, size = [], 0
        batch.append(t)
        size += n
    if batch:
        yield batch


class Counter:
    """Counts tokens with one library, remembering the counts of parts."""

    def __init__(self, vocabulary: str):
        where = locate(vocabulary)
        if where.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(where)
            tok.no_truncation()
            tok.no_padding()
            self.sizes = lambda texts: [len(x.ids) for x in tok.encode_batch_fast(texts, add_special_tokens=False)]
            # Only the byte-level split is known to end at spaces.
            self.parted = '"ByteLevel"' in tok.pre_tokenizer.__getstate__().decode() and tok.normalizer is None
        else:
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=where)
            self.sizes = lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
            self.parted = False
        self.known: dict[str, int] = {"": 0}
        self.held = 0

    def count(self, texts: list[str]) -> list[int]:
        if not self.parted:
            at = {t: n for batch in balanced(list(set(texts))) for t, n in zip(batch, self.sizes(batch), strict=True)}
            return [at[t] for t in texts]
        out = []
        for first in range(0, len(texts), 500):
            cut = [parts(t) for t in texts[first : first + 500]]
            if len(self.known) > REMEMBERED or self.held > REMEMBERED_SIZE:
                self.known, self.held = {"": 0}, 0
            known = self.known
            new = {p for x in cut for p in x}.difference(known)
            for batch in balanced(list(new)):
                known.update(zip(batch, self.sizes(batch), strict=True))
            out += [sum(map(known.__getitem__, x)) for x in cut]
            for p in new:  # long parts hardly come again
                if len(p) > SHORT:
                    del known[p]
                else:
                    self.held += len(p)
        return out


_counters: dict[str, Counter] = {}


def counter(vocabulary: str) -> Counter:
    if vocabulary not in _counters:
        _counters[vocabulary] = Counter(vocabulary)
    return _counters[vocabulary]


def count(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", vocabulary: str = VOCABULARY, limit: int = 512) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit) of every row."""
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = np.array(counter(vocabulary).count(texts), np.int64)
            size = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n), pa.array(n > limit)], ["a", "b", "c", "d"])

    return df.select(id_col, text_col).mapInArrow(run, schema)


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count(table(spark, sf_dir, "documents"))


QUERIES = {"op4_bpe_round_trip": op4_bpe_round_trip, "op9_token_counts": op9_token_counts}
#: The ids of a trained vocabulary can't be expressed in SQL; tests/llm compares with the libraries.
ORACLES: dict[str, str] = {}
