"""Adaptive context-mixing range coder for token ids, many blocks side by side.

A block is coded on its own: its model starts empty and learns as it goes.  At each position the
order-2 context (the two ids before) and the order-1 context (the id before) each predict an id,
the one that last followed them, with a confidence; the order-0 model predicts by the frequencies
of the block so far.  The three are mixed into one distribution: the prediction of order 2 and
that of order 1 get the share that predictions of their confidence have earned in this block, the
order-0 frequencies get the rest, and one step of arithmetic coding takes the id's part of it.
An id that the order-0 model has not seen takes its escape, followed by the id's 16 bits.  The
order-0 frequencies are brought up to date at fixed positions, the other two after every id.

All blocks of a segment take each step together, as NumPy arrays with one entry per block.  The
model is in whole numbers, and the divisions in floating point are exact for their operands, so
every machine decodes what any machine has encoded.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK, LEAST_BLOCK, LANES = 4096, 512, 2048

# The coder works on 48-bit numbers: 16 bits leave at a time, and 2^32 is the least range before a step.
_WORD, _TOP, _MASK = 16, 1 << 32, (1 << 48) - 1
_TOTAL = 20  # bits of a distribution
_SLOTS = 13  # bits of the order-0 distribution
_CONTEXT1, _CONTEXT2 = 11, 12  # bits of a context's place
_RAW = 16  # bits of an id


def _refreshes(length: int) -> list[int]:
    """Positions before which the order-0 frequencies are brought up to date."""
    early = [16, 32, 64, 128, 256]
    return [p for p in early + list(range(512, length, 512)) if p < length]


class _Model:
    """Orders 1 and 2 of all blocks: an entry holds the predicted id and, in 4 bits, the confidence."""

    def __init__(self, lanes: int):
        self.one = np.zeros((lanes, 1 << _CONTEXT1), np.int32)
        self.two = np.zeros((lanes, 1 << _CONTEXT2), np.int32)
        # shares (of 65536) that predictions of each confidence have earned
        self.earned1 = np.full((lanes, 16), 1 << 13, np.int32)
        self.earned2 = np.full((lanes, 16), 1 << 14, np.int32)
        self.tables = [
            (self.one.reshape(-1), self.earned1.reshape(-1)), (self.two.reshape(-1), self.earned2.reshape(-1)),
        ]
        lane = np.arange(lanes)
        self.base = [lane << _CONTEXT1, lane << _CONTEXT2]
        self.earned_base = lane << 4
        self.last = np.zeros(lanes, np.int64)
        self.turn = np.zeros(lanes, np.int64)

    def predict(self, n: int):
        """Predicted ids of order 1 and 2 and the starts of order 1's and order 0's parts of the distribution."""
        last, self.n = self.last[:n], n
        self.at = [
            self.base[0][:n] + ((last * 40503 >> 4) & ((1 << _CONTEXT1) - 1)),
            self.base[1][:n] + ((last * 40503 + self.turn[:n] * 25717 >> 4) & ((1 << _CONTEXT2) - 1)),
        ]
        self.entry = [table[at] for (table, _), at in zip(self.tables, self.at)]
        self.rated = [self.earned_base[:n] + (e & 15) for e in self.entry]
        one, two = (e >> 4 for e in self.entry)
        # at most 7/8 of what is left, so that every order-0 slot keeps a place
        self.rate = [earned[at] for (_, earned), at in zip(self.tables, self.rated)]
        split2 = self.rate[1].astype(np.int64) * 14 + 1
        split1 = split2 + np.where(one == two, 0, (((1 << _TOTAL) - split2) * (self.rate[0] * 7 >> 3) >> 16) + 1)
        self.guess = (one, two)
        return one, two, split2, split1

    def learn(self, ids: np.ndarray) -> None:
        n = self.n
        for i, (table, earned) in enumerate(self.tables):
            entry, guess, rate = self.entry[i], self.guess[i], self.rate[i]
            right = guess == ids
            earned[self.rated[i]] = rate + ((right * 65535 - rate) >> 5)
            sure = entry & 15
            # a confident prediction survives a miss with half its confidence
            kept = np.where(right, entry + (sure < 15), entry - sure + (sure >> 1))
            table[self.at[i]] = np.where(right | (sure > 3), kept, ids << 4)
        self.turn[:n] = self.last[:n]
        self.last[:n] = ids


def _slots(counts: np.ndarray, used: np.ndarray, seen: int) -> np.ndarray:
    """Order-0 slots of symbols with ``counts`` (0: none), where a block has ``used`` symbols in ``seen`` positions."""
    free = (1 << _SLOTS) - used - 64 - (used >> 3)
    return np.where(counts > 0, 1 + counts * free // seen, 0)


class _Writer:
    def __init__(self, lanes: int, length: int):
        self.low, self.range = np.zeros(lanes, np.int64), np.full(lanes, _MASK, np.int64)
        # an id takes less than 6 bytes of distribution and 16 bits of its own
        self.out, self.used = np.zeros((lanes, 4 * length + 8), np.uint16), np.zeros(lanes, np.int64)

    def put(self, at: np.ndarray | slice, start: np.ndarray, size: np.ndarray, bits: int) -> None:
        share = self.range[at] >> bits
        low, width = self.low[at] + share * start, share * size
        lanes = np.arange(len(self.low))[at]
        while True:
            settled = (low ^ (low + width)) < _TOP
            shift = np.flatnonzero(settled | (width < _TOP))
            if not len(shift):
                break
            lane, l, w = lanes[shift], low[shift], width[shift]
            w = np.where(settled[shift], w, -l & (_TOP - 1))
            used = self.used[lane]
            self.out[lane, used] = l >> 32
            self.used[lane] = used + 1
            low[shift], width[shift] = (l << _WORD) & _MASK, w << _WORD
        self.low[at], self.range[at] = low, width

    def finish(self) -> list[bytes]:
        lane = np.arange(len(self.low))
        for _ in range(3):
            self.out[lane, self.used] = self.low >> 32
            self.used += 1
            self.low = (self.low << _WORD) & _MASK
        return [row[:n].astype("<u2").tobytes() for row, n in zip(self.out, self.used)]


class _Reader:
    def __init__(self, streams: list[bytes]):
        longest = max(len(s) for s in streams) // 2 + 8
        self.data = np.zeros((len(streams), longest), np.uint16)
        for row, s in zip(self.data, streams):
            row[: len(s) // 2] = np.frombuffer(s, "<u2")
        self.low, self.range = np.zeros(len(streams), np.int64), np.full(len(streams), _MASK, np.int64)
        first = self.data[:, :3].astype(np.int64)
        self.code = (first[:, 0] << 32) | (first[:, 1] << 16) | first[:, 2]
        self.used = np.full(len(streams), 3)

    def look(self, at: np.ndarray | slice, bits: int) -> np.ndarray:
        """Where in ``2^bits`` the next value lies."""
        self.share = self.range[at] >> bits
        # quotients below 2^20 of numbers below 2^48: the rounding of a double cannot reach the next whole number
        value = ((self.code[at] - self.low[at]) / self.share).astype(np.int64)
        return np.minimum(value, (1 << bits) - 1)

    def take(self, at: np.ndarray | slice, start: np.ndarray, size: np.ndarray) -> None:
        low, width, code = self.low[at] + self.share * start, self.share * size, self.code[at]
        lanes = np.arange(len(self.low))[at]
        last = self.data.shape[1] - 1
        while True:
            settled = (low ^ (low + width)) < _TOP
            shift = np.flatnonzero(settled | (width < _TOP))
            if not len(shift):
                break
            lane, l, w = lanes[shift], low[shift], width[shift]
            w = np.where(settled[shift], w, -l & (_TOP - 1))
            used = self.used[lane]
            code[shift] = ((code[shift] << _WORD) & _MASK) | self.data[lane, np.minimum(used, last)]
            self.used[lane] = used + 1
            low[shift], width[shift] = (l << _WORD) & _MASK, w << _WORD
        self.low[at], self.range[at], self.code[at] = low, width, code


def block_length(n_ids: int) -> int:
    """Ids of a block: shorter in a small segment, so that its blocks still fill the arrays."""
    return min(BLOCK, max(LEAST_BLOCK, n_ids // 512))


def encode(ids: np.ndarray) -> tuple[int, list[bytes], np.ndarray]:
    """Block length, coded blocks and their checksums (crc32 of the ids as little-endian 32-bit numbers)."""
    if len(ids) and ids.max() >> _RAW:
        raise ValueError(f"ids take more than {_RAW} bits")
    length = block_length(len(ids))
    plain = ids.astype("<u4")
    starts = range(0, len(ids), length)
    sums = np.array([zlib.crc32(plain[i : i + length].tobytes()) for i in starts], np.int64)
    streams: list[bytes] = []
    for first in range(0, len(ids), LANES * length):
        streams += _encode_lanes(ids[first : first + LANES * length], length)
    return length, streams, sums


def _encode_lanes(ids: np.ndarray, length: int) -> list[bytes]:
    lanes = -(-len(ids) // length)
    short = len(ids) - (lanes - 1) * length
    value, rank = np.zeros((lanes, length), np.int64), np.zeros((lanes, length), np.int64)
    for i in range(lanes):
        part = ids[i * length : (i + 1) * length]
        value[i, : len(part)] = part
        rank[i, : len(part)] = np.unique(part, return_inverse=True)[1]
    symbols = int(rank.max()) + 1
    counts = np.zeros((lanes, symbols), np.int64)
    starts, sizes = np.zeros((lanes, symbols), np.int64), np.zeros((lanes, symbols), np.int64)
    escape = np.zeros(lanes, np.int64)
    refreshes, done = set(_refreshes(length)), 0
    rank_at = np.ascontiguousarray((rank + np.arange(lanes)[:, None] * symbols).T)
    value = np.ascontiguousarray(value.T)
    model, out = _Model(lanes), _Writer(lanes, length)
    for t in range(length if lanes > 1 else short):
        n = lanes if t < short else lanes - 1
        if t in refreshes:
            counts += np.bincount(rank_at[done:t, :n].ravel(), minlength=counts.size)[: counts.size].reshape(counts.shape)
            done = t
            sizes = _slots(counts, (counts > 0).sum(axis=1, keepdims=True), t)
            ends = np.cumsum(sizes, axis=1)
            starts, escape = ends - sizes, ends[:, -1]
        now, at = value[t, :n], rank_at[t, :n]
        one, two, split2, split1 = model.predict(n)
        start0, size0 = starts.reshape(-1)[at], sizes.reshape(-1)[at]
        unseen = size0 == 0
        start0 = np.where(unseen, escape[:n], start0)
        end0 = np.where(unseen, 1 << _SLOTS, start0 + size0)
        rest = (1 << _TOTAL) - split1
        is2, is1 = two == now, one == now
        start = np.where(is2, 0, np.where(is1, split2, split1 + (start0 * rest >> _SLOTS)))
        end = np.where(is2, split2, np.where(is1, split1, split1 + (end0 * rest >> _SLOTS)))
        out.put(slice(0, n), start, end - start, _TOTAL)
        raw = np.flatnonzero(unseen & ~is1 & ~is2)
        if len(raw):
            out.put(raw, now[raw], np.ones(len(raw), np.int64), _RAW)
        model.learn(now)
    return out.finish()


def decode(n_ids: int, length: int, streams: list[bytes], sums: np.ndarray) -> np.ndarray:
    """The ids of a segment; a block that does not match its checksum is an error."""
    out = np.empty(n_ids, np.int64)
    for first in range(0, len(streams), LANES):
        a, b = first * length, min(n_ids, (first + LANES) * length)
        out[a:b] = _decode_lanes(b - a, length, streams[first : first + LANES])
    plain = out.astype("<u4")
    for i, expected in enumerate(sums):
        if zlib.crc32(plain[i * length : (i + 1) * length].tobytes()) != expected:
            raise ValueError(f"block {i} does not match its checksum")
    return out


def _order0(seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From the ids of each block so far: what every slot stands for (symbol, start, end in one number), and the escape's start."""
    lanes, t = seen.shape
    ordered = np.sort(seen, axis=1, kind="stable")
    first = np.ones((lanes, t), bool)
    first[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    begins = np.flatnonzero(first.ravel())
    counts = np.diff(np.append(begins, lanes * t))
    lane, symbol = begins // t, ordered.ravel()[begins]
    used = np.bincount(lane, minlength=lanes)
    size = _slots(counts, used[lane], t)
    run = np.cumsum(size)
    total = np.bincount(lane, weights=size, minlength=lanes).astype(np.int64)
    start = run - size - np.repeat(np.cumsum(total) - total, used)
    # the escape is one more symbol at the end of each block
    meaning = np.insert((symbol.astype(np.int64) << 32) | (start << 16) | (start + size), np.cumsum(used), total << 16 | 1 << _SLOTS)
    all_sizes = np.insert(size, np.cumsum(used), (1 << _SLOTS) - total)
    return np.repeat(meaning, all_sizes).reshape(lanes, -1), total


def _decode_lanes(n_ids: int, length: int, streams: list[bytes]) -> np.ndarray:
    lanes, short = len(streams), n_ids - (len(streams) - 1) * length
    model, source = _Model(lanes), _Reader(streams)
    value = np.zeros((length, lanes), np.uint16)
    meaning = np.full((lanes, 1 << _SLOTS), 1 << _SLOTS, np.int64)
    escape, base = np.zeros(lanes, np.int64), np.arange(lanes) << _SLOTS
    refreshes = set(_refreshes(length))
    for t in range(length if lanes > 1 else short):
        n = lanes if t < short else lanes - 1
        if t in refreshes:
            meaning[:n], escape[:n] = _order0(np.ascontiguousarray(value[:t, :n].T))
        one, two, split2, split1 = model.predict(n)
        rest = (1 << _TOTAL) - split1
        at = source.look(slice(0, n), _TOTAL)
        is2, is1 = at < split2, at < split1
        # the slot whose part of the rest holds ``at``; any slot where order 1 or 2 was right
        slot = ((((np.maximum(at - split1, 0) + 1) << _SLOTS) - 1) / rest).astype(np.int64)
        found = meaning.reshape(-1)[base[:n] + slot]
        start0, end0 = (found >> 16) & 0xFFFF, found & 0xFFFF
        start = np.where(is2, 0, np.where(is1, split2, split1 + (start0 * rest >> _SLOTS)))
        end = np.where(is2, split2, np.where(is1, split1, split1 + (end0 * rest >> _SLOTS)))
        source.take(slice(0, n), start, end - start)
        now = np.where(is2, two, np.where(is1, one, found >> 32))
        raw = np.flatnonzero((slot >= escape[:n]) & ~is1)
        if len(raw):
            now[raw] = source.look(raw, _RAW)
            source.take(raw, now[raw], np.ones(len(raw), np.int64))
        value[t, :n] = now
        model.learn(now)
    return value.T.ravel()[:n_ids].astype(np.int64)
