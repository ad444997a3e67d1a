"""Adaptive context-mixing range coder for blocks of token ids.

A block is cut into lanes of equal length that are coded side by side, one id of each lane a step, so that numpy works on
all lanes at once; all lanes share one model, which starts anew with each block and learns after every step. The model
predicts an id from three contexts: order 2, the id that last proved right after the two before it; order 1, the same
after the one before it; order 0, the frequencies of the ids the other two missed. How far orders 2 and 1 are trusted is
mixed anew at each step: their confidences choose a row of counts that says how often order 2, order 1 or neither was
right there. The mix gives the first interval of the range coder, order 0 the second where the others miss.

The range coder keeps 64 bits of low end and range and sends 16 bits whenever the range falls under 2^32; where a range
still straddles the bits to be sent, it is cut short, so nothing carries over into what is sent.
"""

from __future__ import annotations

import numpy as np

#: Lanes of a block at most, and ids a lane should have at least.
LANES, LEAST_STEPS = 8192, 96
#: Slots of the order-2 table (as a power of two), greatest trust (all of two bits), weight of an id seen at order 0.
SLOTS_BITS, SURE, SEEN = 18, 3, 32
#: Ids between renewals of the order-0 frequencies, at most.
RENEWAL = 65_536

_MIX_BITS = np.uint64(16)
_LEAST = np.uint64(1 << 32)
_UNIT, _TOP = np.uint64(16), np.uint64(48)
_MASK = np.uint64((1 << 32) - 1)


def lanes_of(n: int) -> tuple[int, int]:
    """(lanes, steps) for a block of ``n`` ids; the last lanes may be short or empty."""
    lanes = max(1, min(LANES, n // LEAST_STEPS))
    return lanes, -(-n // lanes)


def _length_type(steps: int) -> str:
    """How the length of a lane is written: an id sends two units at most."""
    return "<u2" if 2 * steps + 8 < 1 << 16 else "<u4"


class Model:
    """Predictions shared by all lanes of a block; the same calls in coder and decoder keep both alike."""

    def __init__(self, vocabulary: int, lanes: int) -> None:
        self.vocabulary = vocabulary
        # guesses of order 1 and 2, each with its trust in the two lowest bits
        self.guesses = [np.zeros(vocabulary, np.int32), np.zeros(1 << SLOTS_BITS, np.int32)]
        self.last = np.zeros(lanes, np.int64)
        self.second = np.zeros(lanes, np.int64)
        self.mixed = np.tile(np.array([1, 1, 2], np.int64), (2 * (SURE + 1) ** 2, 1))
        self.seen = np.ones(vocabulary, np.int64)
        self.new: list[np.ndarray] = []
        self.since, self.coded = 0, 0
        self._renew()

    def _renew(self) -> None:
        if self.new:
            self.seen += SEEN * np.bincount(np.concatenate(self.new), minlength=self.vocabulary)
        self.new, self.since = [], 0
        self.below = np.zeros(self.vocabulary + 1, np.uint64)
        np.cumsum(self.seen, out=self.below[1:].view(np.int64))
        self.total = self.below[-1]
        self.cells = None

    def find(self, target: np.ndarray) -> np.ndarray:
        """The ids whose stretches of the order-0 frequencies hold ``target``: by a table of cells, then by halving."""
        shift = np.uint64(max(0, int(self.total).bit_length() - 16))
        if self.cells is None:
            cell = (self.below >> shift).astype(np.int64)
            self.cells = np.append(0, np.cumsum(np.bincount(cell))) - 1  # the last id that begins before a cell
        cell = (target >> shift).astype(np.int64)
        low, high = np.maximum(self.cells[cell], 0), self.cells[cell + 1]
        left = np.flatnonzero(low < high)
        while len(left):
            middle = (low[left] + high[left] + 1) >> 1
            fits = self.below[middle] <= target[left]
            low[left[fits]] = middle[fits]
            high[left[~fits]] = middle[~fits] - 1
            left = left[low[left] < high[left]]
        return low

    def predict(self, active: int) -> None:
        """Guesses and the row of the mix for the first ``active`` lanes, and the cuts of each row's interval."""
        one = self.last[:active]
        two = self.second[:active] * 0x9E3779B1
        two += one * 0x85EBCA77
        two >>= 7
        two &= (1 << SLOTS_BITS) - 1
        self.slots = (one, two)
        self.entries = (self.guesses[0].take(one), self.guesses[1].take(two))
        self.trusts = (self.entries[0] & SURE, self.entries[1] & SURE)
        self.first, self.other = self.entries[1] >> 2, self.entries[0] >> 2
        row = self.trusts[1] * (SURE + 1)
        row += self.trusts[0]
        row <<= 1
        row += self.first == self.other
        row *= 3
        self.row = row
        # of 2^16, the order-2 guess has what lies below the first cut, the order-1 guess what lies below the second
        two_right, one_right, neither = self.mixed.T
        both = two_right + one_right
        total = both + neither
        low = np.minimum(np.maximum((two_right << 16) // total, 1), (1 << 16) - 3)
        high = np.minimum(np.maximum((both << 16) // total, low + 1), (1 << 16) - 1)
        begin, width = np.zeros((2, *self.mixed.shape), np.uint64)
        begin[:, 1], begin[:, 2] = low, high
        width[:, 0], width[:, 1], width[:, 2] = low, high - low, (1 << 16) - high
        self.begin, self.width = begin.ravel(), width.ravel()

    def learn(self, ids: np.ndarray, wrong: np.ndarray, place: np.ndarray, missed: np.ndarray) -> None:
        """``place``: the row of the mix, plus 1 where order 1 was right, 2 where neither; ``wrong``: not order 2; ``missed``: neither."""
        active = len(ids)
        self.mixed += np.bincount(place, minlength=self.mixed.size).reshape(self.mixed.shape)
        if self.mixed[:, 2].max() > 1 << 20:
            self.mixed = (self.mixed >> 1) + 1
        new = (ids << 2) + 1
        for order, bad in ((0, self.other != ids), (1, wrong)):
            moved, trust = self.entries[order], self.trusts[order]
            lost = bad & (trust <= 1)
            moved += (trust < SURE) & ~bad
            moved -= bad
            np.copyto(moved, new, where=lost)
            self.guesses[order][self.slots[order]] = moved
        self.second[:active] = self.last[:active]
        self.last[:active] = ids
        self.new.append(missed)
        self.since += active
        self.coded += active
        if self.since >= min(RENEWAL, max(256, self.coded >> 2)):
            self._renew()


def _shift(low: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sends 16 bits of the lanes ``at``, whose range is too small; returns the bits."""
    here, left = low[at], size[at]
    straddles = ((here ^ (here + left - np.uint64(1))) >> _TOP) != 0
    if straddles.any():
        left = np.where(straddles, (~here + np.uint64(1)) & _MASK, left)
    low[at], size[at] = here << _UNIT, left << _UNIT
    return (here >> _TOP).astype(np.uint16)


def encode(ids: np.ndarray, vocabulary: int) -> bytes:
    """The block's code: the lengths of the lanes in 16-bit units, then the lanes' units."""
    n = len(ids)
    if not n:
        return b""
    lanes, steps = lanes_of(n)
    model = Model(vocabulary, lanes)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    out = np.zeros((lanes, 2 * steps + 8), np.uint16)
    sent = np.zeros(lanes, np.int64)
    padded = np.zeros(lanes * steps, np.int32)
    padded[:n] = ids
    by_step = np.ascontiguousarray(padded.reshape(lanes, steps).T)

    def settle(active: int) -> None:
        at = np.flatnonzero(size[:active] < _LEAST)
        while len(at):
            out[at, sent[at]] = _shift(low, size, at)
            sent[at] += 1
            at = at[size[at] < _LEAST]

    for step in range(steps):
        active = -(-(n - step) // steps)
        now = by_step[step, :active]
        model.predict(active)
        wrong = now != model.first
        kind = wrong + (wrong & (now != model.other)).view(np.int8)
        unit, place = size[:active] >> _MIX_BITS, model.row + kind
        low[:active] += unit * model.begin.take(place)
        np.multiply(unit, model.width.take(place), out=size[:active])
        settle(active)
        miss = np.flatnonzero(kind == 2)
        missed = now[miss]
        if len(miss):
            unit = size[miss] // model.total
            begin = model.below[missed]
            low[miss] += unit * begin
            size[miss] = unit * (model.below[missed + 1] - begin)
            settle(active)
        model.learn(now, wrong, place, missed)
    final = (low + _MASK) & ~_MASK  # inside the range, whose lower 32 bits can be left out
    for shift in (48, 32):
        out[np.arange(lanes), sent] = (final >> np.uint64(shift)).astype(np.uint16)
        sent += 1
    units = out[np.arange(out.shape[1]) < sent[:, None]]
    return sent.astype(_length_type(steps)).tobytes() + units.astype("<u2").tobytes()


def decode(code: bytes, n: int, vocabulary: int) -> np.ndarray:
    """The ``n`` ids of a block's code."""
    if not n:
        return np.empty(0, np.int32)
    lanes, steps = lanes_of(n)
    written = np.dtype(_length_type(steps))
    lengths = np.frombuffer(code, written, lanes).astype(np.int64)
    units = np.frombuffer(code, "<u2", int(lengths.sum()), written.itemsize * lanes).astype(np.uint64)
    units = np.append(units, np.zeros(4, np.uint64))
    at_end = np.cumsum(lengths)
    read = at_end - lengths
    model = Model(vocabulary, lanes)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    value = np.zeros(lanes, np.uint64)
    for _ in range(4):
        value = value << _UNIT | np.where(read < at_end, units[np.minimum(read, len(units) - 1)], np.uint64(0))
        read += 1
    by_step = np.zeros((steps, lanes), np.int32)

    def settle(active: int) -> None:
        at = np.flatnonzero(size[:active] < _LEAST)
        while len(at):
            _shift(low, size, at)
            place = read[at]
            value[at] = value[at] << _UNIT | np.where(place < at_end[at], units[np.minimum(place, len(units) - 1)], np.uint64(0))
            read[at] = place + 1
            at = at[size[at] < _LEAST]

    for step in range(steps):
        active = -(-(n - step) // steps)
        model.predict(active)
        unit = size[:active] >> _MIX_BITS
        offset = value[:active] - low[:active]
        wrong = offset >= unit * model.begin[model.row + 1]
        kind = wrong + (offset >= unit * model.begin[model.row + 2]).view(np.int8)
        place = model.row + kind
        low[:active] += unit * model.begin.take(place)
        np.multiply(unit, model.width.take(place), out=size[:active])
        settle(active)
        now = np.where(wrong, model.other, model.first)
        miss = np.flatnonzero(kind == 2)
        missed = now[:0]
        if len(miss):
            unit = size[miss] // model.total
            target = np.minimum((value[miss] - low[miss]) // unit, model.total - np.uint64(1))
            missed = model.find(target)
            begin = model.below[missed]
            low[miss] += unit * begin
            size[miss] = unit * (model.below[missed + 1] - begin)
            settle(active)
            now[miss] = missed
        model.learn(now, wrong, place, missed)
        by_step[step, :active] = now
    return by_step.T.reshape(-1)[:n]
