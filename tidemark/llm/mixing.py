"""An adaptive context-mixing coder for token ids, many blocks at a time.

Every block starts from the same fresh model, so it can be read without any other. The
model predicts the next id three ways: the last id that followed the same two ids
(order 2), the last that followed the same one (order 1), and how often ids occur at all
(order 0). Whether the order-2 id is the one is a yes or no whose probability mixes
three adaptive estimates in the logistic domain: by the confidence of the order-2
prediction, by that of the order-1 prediction, and by how the last ids were found; the
mixing weights learn with each answer. Then the order-1 id is asked for. Nothing is asked
where neither context has been seen before (each prediction bears a check of its context),
and where one has, the other order's prediction is the same. An id that neither predicts
is coded by order 0: ids are numbered by their frequency in the file,
the number's size in bits has adaptive frequencies in each block, and its lower bits,
among which frequencies differ little, are even. All of this drives an asymmetric-numeral
coder (rANS) with a state of 64 bits and words of 32: its encoder first runs the model
over a whole block, then codes from the last step to the first; its decoder goes forward
and divides nothing.

A block is a lane: numpy works on the same place of all blocks at once. All arithmetic
is on integers, and tables come from decimal arithmetic, so every machine decodes what
another has encoded. ``encode`` and ``decode`` share the model; they differ in the coder
alone.
"""

from __future__ import annotations

import functools
from decimal import Decimal

import numpy as np

U32, U64 = np.uint32, np.uint64
_32, _16 = U64(32), U64(16)
_LOW32 = U64(2**32 - 1)
#: Bits of the order-0 table's total, its least frequency and its rate; bits of the prediction tables of orders 1 and 2.
TOTAL, LEAST, RATE = 14, 2, 5
SLOTS1, SLOTS2 = 9, 10
MOST_IDS = (1 << 16) - 1


@functools.cache
def logistic() -> tuple[np.ndarray, np.ndarray]:
    """(stretch of a 12-bit probability, 16-bit probability of a stretched value from -2048 on): the logistic function, a unit being 256."""
    squash = np.array([min(max(int(Decimal(65536) / (1 + (Decimal(-x) / 256).exp())), 32), 65504) for x in range(-2048, 2048)], np.int32)
    stretch = (np.searchsorted(squash >> 4, np.arange(4096)) - 2048).clip(-2047, 2047).astype(np.int32)
    return stretch, squash


@functools.cache
def order0() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the starts that a table moves towards for each symbol, the size in bits of each number less one, a fresh table)."""
    j, s = np.arange(16), np.arange(16)[:, None]
    aims = np.where(j <= s, j * LEAST, (1 << TOTAL) - (16 - j) * LEAST).astype(np.int16)
    sizes = np.array([max(x.bit_length() - 1, 0) for x in range(1 << 16)], np.uint8)
    return aims, sizes, (np.arange(16) << (TOTAL - 4)).astype(np.int16)


def parts(first: np.ndarray, second: np.ndarray, past: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and frequencies out of 2**16 of the answers 0, 1 (past) and 2 (past and last)."""
    both = first + second
    return np.where(past, np.where(last, both, first), U32(0)), np.where(past, np.where(last, U32(65536) - both, second), first)


class Encoder:
    """Lanes of an asymmetric-numeral coder that put out 32-bit words. What a step codes is held, as the last step has to be coded first."""

    def __init__(self, steps: int, lanes: int):
        self.x = np.full(lanes, 1 << 32, U64)
        self.rows = np.arange(lanes, dtype=np.int64) * 16
        self.asked: list[tuple[np.ndarray, ...]] = []  # in each step the lanes, and their answers' starts and frequencies
        self.held = np.zeros((3, steps, lanes), np.uint16)  # of the number the start and frequency of its size, and its lower bits
        self.sizes = np.zeros((steps, lanes), np.uint8)
        self.counts: list[int] = []
        self.out: list[tuple[np.ndarray, np.ndarray]] = []

    def choose(self, n, asked, first, second, answer):
        """0, 1 or 2 for some of the first n lanes; first, second: frequencies of 0 and 1 out of 2**16."""
        self.counts.append(n)
        self.asked.append((asked.astype(np.uint16), *(x.astype(np.uint16) for x in parts(first, second, answer > 0, answer > 1))))
        return answer

    def number(self, n, table, others, rank):
        """Ranks for all lanes but some others, by the size of rank + 1 from a table of starts and then its lower bits."""
        t, more = len(self.counts) - 1, rank + U32(1)
        size = order0()[1].take(more)
        start, end = self.of_size(n, table, size)
        end -= start
        bits = more.astype(np.uint16)
        bits -= np.left_shift(1, size, dtype=np.uint16)
        at = self.held[:, t, :n]
        at[0], at[1], at[2], self.sizes[t, :n] = start, end, bits, size
        at[:, others] = [[0], [1 << TOTAL], [0]]  # the whole: nothing is coded
        self.sizes[t, others] = 0
        return rank, size

    def of_size(self, n, table, size):
        """Where a size starts and ends in its lane's table."""
        flat, k = table.reshape(-1), self.rows[:n] + size
        end = flat.take(k + 1, mode="clip")
        end[size == 15] = 1 << TOTAL
        return flat.take(k), end

    def _spill(self, x, lanes):
        full = x.take(lanes)
        self.out.append((lanes.astype(np.uint16), full.astype(U32)))
        x[lanes] = full >> _32

    def finish(self) -> list[np.ndarray]:
        """The words of each lane, in the order of the steps."""
        for n, (asked, start, freq), held, sizes in zip(reversed(self.counts), reversed(self.asked), self.held.swapaxes(0, 1)[::-1], self.sizes[::-1], strict=True):
            x, size = self.x[:n], sizes[:n].astype(U64)
            part = held[1, :n].astype(U64)
            # A lane whose state would not fit 64 bits puts out a word before.
            self._spill(x, np.flatnonzero(x >> U64(64 - TOTAL) - size >= part))
            x <<= size
            x |= held[2, :n]
            x += x // part * (U64(1 << TOTAL) - part) + held[0, :n]
            part = freq.astype(U64)
            self._spill(x, asked[x.take(asked) >> U64(48) >= part])
            some = x.take(asked)
            x[asked] = some + some // part * (U64(1 << 16) - part) + start
        lanes = np.arange(len(self.x), dtype=np.uint16)
        self.out += [(lanes, self.x.astype(U32)), (lanes, (self.x >> _32).astype(U32))]
        lane = np.concatenate([x[0] for x in reversed(self.out)])
        words = np.concatenate([x[1] for x in reversed(self.out)])[np.argsort(lane, kind="stable")]
        return np.split(words, np.cumsum(np.bincount(lane, minlength=len(lanes)))[:-1])


class Decoder(Encoder):
    """The same lanes, fed with the words."""

    def __init__(self, words: list[np.ndarray]):
        super().__init__(0, len(words))
        # A damaged block may ask for words beyond its end; it gets zeros and its checksum tells.
        self.words = np.concatenate([x for w in words for x in (w.astype(U64), np.zeros(2, U64))])
        sizes = np.array([len(w) + 2 for w in words])
        self.next, self.last = np.cumsum(sizes) - sizes, np.cumsum(sizes) - 1
        self.x = self.words.take(self.next) << _32 | self.words.take(self.next + 1)
        self.next = np.minimum(self.next + 2, self.last)

    def _fill(self, x, lanes):
        """Those of the lanes with under 32 bits take a word."""
        lanes = lanes[x.take(lanes) <= _LOW32]
        at = self.next.take(lanes)
        x[lanes] = x.take(lanes) << _32 | self.words.take(at)
        self.next[lanes] = np.minimum(at + 1, self.last.take(lanes))

    def choose(self, n, asked, first, second, answer):
        x = self.x.take(asked)
        value = x.astype(U32) & U32(0xFFFF)
        past, last = value >= first, value >= first + second
        start, freq = parts(first, second, past, last)
        x >>= _16
        x *= freq
        x += value - start
        self.x[asked] = x
        self._fill(self.x, asked)
        return past.astype(np.int32) + last

    def number(self, n, table, others, rank):
        x = self.x[:n]
        as_were = x.take(others)
        value = x.astype(np.int16) & np.int16((1 << TOTAL) - 1)
        # The starts at or below the value are a run from the front: ones, then zeros.
        size = np.bitwise_count(np.packbits(table <= value[:, None]).view(">u2")) - np.uint8(1)
        start, end = self.of_size(n, table, size)
        x >>= U64(TOTAL)
        x *= (end - start).astype(U64)
        x += (value - start).astype(U64)
        one = U32(1) << size
        found = (x.astype(U32) & (one - U32(1)) | one) - U32(1)
        x >>= size
        x[others] = as_were
        self._fill(x, np.flatnonzero(x <= _LOW32))
        return found, size


class Model:
    """The predictions of all lanes."""

    #: Contexts of each of the three estimates, and of the order-1 question.
    CONTEXTS = 64

    def __init__(self, lanes: int):
        self.slots = np.zeros(lanes * ((1 << SLOTS1) + (1 << SLOTS2)), U32)  # a predicted rank, its confidence in 4 bits above, and a check of its context
        lane = np.arange(lanes, dtype=np.int64)
        self.slot_base = np.stack((lane << SLOTS1, (lanes << SLOTS1) + (lane << SLOTS2)))
        self.p = np.full(lanes * self.CONTEXTS * 4, 1 << 14, np.int32)
        self.p_base = lane * (self.CONTEXTS * 4) + np.arange(4)[:, None] * self.CONTEXTS
        self.w = np.full(3 * lanes, 26_000, np.int32)
        self.w_base = np.arange(3 * lanes).reshape(3, lanes)
        self.table = np.tile(order0()[2], (lanes, 1))
        self.history = np.zeros(lanes, np.int32)
        self.before = np.zeros((2, lanes), U32)

    def step(self, coder, n: int, ids: np.ndarray | None) -> np.ndarray:
        """Code the next rank of the first n lanes; without ranks, they come from the coder."""
        stretch, squash = logistic()
        a, b = self.before[0, :n], self.before[1, :n]
        h = np.empty((2, n), U32)
        np.multiply(a, U32(0x9E3779B1), out=h[0])
        h[1] = (h[0] ^ b * U32(0x85EBCA6B)) * U32(0xC2B2AE35)
        place = self.slot_base[:, :n].copy()
        place[0] += h[0] >> U32(32 - SLOTS1)
        place[1] += h[1] >> U32(32 - SLOTS2)
        h <<= U32(SLOTS2)
        h |= U32(1 << 31)  # an empty slot is of no context
        h &= U32(0xFFF << 20)
        was = self.slots.take(place)
        guess, held = was & U32(0xFFFF), was >> U32(16) & U32(15)
        known = (was ^ h) < U32(1 << 20)

        # The lanes with a prediction; where there is one of one order only, the other order's is the same.
        asked = np.flatnonzero(known[0] | known[1])
        base = self.p_base.take(asked, axis=1)
        sure = (held * known).take(asked, axis=1).astype(np.int32)
        one, two = guess.take(asked, axis=1)
        one, two = np.where(sure[0] > 0, one, two), np.where(sure[1] > 0, two, one)
        agree = one == two
        history = self.history.take(asked)
        at = base
        at[:2] += sure[::-1] * 2 + agree
        at[2] += history
        at[3] += sure[0]
        p, of_w = self.p.take(at), self.w_base.take(asked, axis=1)
        s, w = stretch.take(p[:3] >> 4), self.w.take(of_w)
        weighed = w * s
        dot = (weighed[0] + weighed[1] + weighed[2]) >> 16
        mixed = squash.take(np.minimum(np.maximum(dot, -2047), 2047) + 2048)
        first = mixed.astype(U32)
        second = np.maximum((U32(65536) - first) * p[3].astype(U32) >> U32(16), U32(1))  # at least 1, and less than what is left
        second[agree] = 0

        true = None if ids is None else ids.take(asked)
        answer = coder.choose(n, asked, first, second, None if ids is None else np.where(true == two, 0, np.where(true == one, 1, 2)))
        right = np.flatnonzero(answer != 2)
        others = asked.take(right)
        got, size = coder.number(n, self.table[:n], others, ids)
        if ids is None:
            got[others] = np.where(answer == 0, two, one).take(right)

        aims = order0()[0].take(size, axis=0)
        aims -= self.table[:n]
        aims >>= RATE
        aims[others] = 0
        self.table[:n] += aims
        hit = answer == 0
        self.w[of_w] = np.minimum(np.maximum(w + (s * (hit * np.int32(4095) - (mixed >> 4)) >> 12), -(1 << 17)), 1 << 17)
        p[:3] += (hit * np.int32(65535) - p[:3]) >> 4
        p[3] += np.where(hit | agree, 0, ((answer == 1) * np.int32(65535) - p[3]) >> 4)
        self.p[at] = p
        self.history[asked] = (history << 2 | answer) & 63
        more = was + (held < 15).astype(U32) * U32(1 << 16)
        less = np.where(held >= 2, was - (held - (held >> U32(1)) << U32(16)), h | got | U32(1 << 16))
        self.slots[place] = np.where(known & (guess == got), more, less)
        self.before[1, :n], self.before[0, :n] = a, got
        return got


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of ranks (under ``MOST_IDS``) as bytes. Blocks may differ in length."""
    if not blocks:
        return []
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    sizes = np.array([len(blocks[i]) for i in order])
    ids = np.zeros((int(sizes[0]), len(blocks)), U32)
    for lane, i in enumerate(order):
        ids[: sizes[lane], lane] = blocks[i]
    if ids.size and int(ids.max()) >= MOST_IDS:
        raise ValueError(f"ranks must be under {MOST_IDS}")
    coder, model = Encoder(len(ids), len(blocks)), Model(len(blocks))
    for t in range(len(ids)):
        n = int(np.searchsorted(-sizes, -t, "left"))  # the lanes that have a t-th rank
        model.step(coder, n, ids[t, :n])
    out: list[bytes] = [b""] * len(blocks)
    for lane, words in enumerate(coder.finish()):
        out[order[lane]] = words.astype("<u4").tobytes()
    return out


def decode(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ranks of blocks of ``sizes`` ranks."""
    if not payloads:
        return []
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    held = np.array([sizes[i] for i in order])
    coder, model = Decoder([np.frombuffer(payloads[i], "<u4") for i in order]), Model(len(sizes))
    ids = np.zeros((int(held[0]), len(sizes)), U32)
    for t in range(len(ids)):
        n = int(np.searchsorted(-held, -t, "left"))
        ids[t, :n] = model.step(coder, n, None)
    out: list[np.ndarray] = [ids[:0, 0]] * len(sizes)
    for lane, i in enumerate(order):
        out[i] = ids[: held[lane], lane].copy()
    return out
