"""Adaptive context-mixing range coder for token ids, in lanes (op12).

Ids are dealt to lanes of equal length that are coded in step: one numpy call moves position t
of all lanes.  Every lane has a payload of its own; the model is one for all lanes and starts
from the same state in every frame, so that a step learns from as many ids as there are lanes.

The probability of an id is a mixture of three predictions: order 2 (the id that last followed
the two ids before), order 1 (the one that last followed the id before) and order 0 (a
distribution over all ids).  The weights of the mixture adapt for each pair of confirmation
counts that the two predicted ids have, apart for those that agree; weights of predictions that
name the same id add up.  A 60-bit range coder codes which prediction is taken and, after order
0, the id.  Order 0 counts the ids that it coded; its distribution follows the counts whenever
they have grown by a share (GROWN), and starts from 1 / (id + RANK_SHIFT), since public
vocabularies number tokens by falling frequency.  Weights follow their counts likewise, and every
WEIGH ids at least; the successors change at every step.

Where lanes meet in one step, all see the state before it; of those that write the successor of
one context the last lane's stands.  All is whole-number arithmetic,
so coder and decoder agree on every machine.
"""

from __future__ import annotations

import numpy as np

MAX_ID = 0xFFFF
RANK_SHIFT = 400
PRIOR = 1 << 12             # ids that the first distribution stands for
ID_BITS = 20                # of the distribution over all ids
ID_TOTAL = 1 << ID_BITS
GROWN = 4                   # a share of 1 / GROWN more ids: the distribution follows
BITS = 14                   # of the weights
TOTAL = 1 << BITS
WEIGH = 1 << 14             # new ids after which weights follow, if not a share of 1 / GROWN before
WEIGHED = 1 << 16           # ids that weights remember; then they count half
CONTEXTS = 1 << 18          # remembered successors of two ids
SURE = 7                    # highest count of confirmations
WORD = 20                   # bits of a payload word; three are in the coder's sight

_TOP = 3 * WORD
_BOTTOM = np.uint64(1 << (_TOP - WORD))
_REST = np.uint64((1 << (_TOP - WORD)) - 1)
_SWORD, _SREST = np.uint64(WORD), np.uint64(_TOP - WORD)


class _Ids:
    """Order 0: how many ids were met, and the distribution in which each has 1 at least."""

    def __init__(self, vocabulary: int):
        prior = np.floor(1e9 / (np.arange(vocabulary) + RANK_SHIFT)).astype(np.int64)
        self.every = np.arange(vocabulary)
        self.count = prior * (PRIOR << 10) // prior.sum()      # in shares of 1 / 1024
        self.new: list[np.ndarray] = []
        self.n_new, self.n = 0, 0
        self.stop = np.zeros(vocabulary + 1, np.int64)
        self.slots: np.ndarray | None = None
        self._follow()

    def _follow(self) -> None:
        share = np.cumsum(self.count)
        self.stop[1:] = share * (ID_TOTAL - len(share)) // share[-1] + self.every + 1
        self.stop[-1] = ID_TOTAL
        self.start = self.stop[:-1].astype(np.uint64)
        self.size = np.diff(self.stop).astype(np.uint64)
        self.slots = None

    def learn(self, ids: np.ndarray) -> None:
        self.new.append(ids)
        self.n_new += len(ids)
        if self.n_new * GROWN >= self.n:
            self.count += np.bincount(np.concatenate(self.new), minlength=len(self.count)) << 10
            self.n += self.n_new
            self.new, self.n_new = [], 0
            self._follow()

    def found(self, at: np.ndarray) -> np.ndarray:
        """The ids at places of the distribution."""
        if self.slots is None:
            self.slots = np.repeat(self.every.astype(np.uint16), self.size.astype(np.int64))
        return self.slots.take(at).astype(np.int32)


class _Model:
    """The state that all lanes share, reset, and every lane's last two ids."""

    def __init__(self, lanes: int, vocabulary: int):
        self.order0 = _Ids(vocabulary)
        # Successors of one id, then of two: id << 3 | confirmations.
        self.follow = np.zeros(MAX_ID + 1 + CONTEXTS, np.int32)
        self.at = np.empty(2 * lanes, np.int64)
        # How often each prediction was taken: order 2, order 1, order 0.
        self.taken = np.tile(np.array([1, 1, 2], np.int64), (2 * (SURE + 1) ** 2, 1))
        self.new: list[np.ndarray] = []
        self.n_new, self.n = 0, 0
        self._weigh()
        self.last = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.int64)

    def _weigh(self) -> None:
        """Bounds of each state's weights (order 2 below the first, order 1 below the second) and of
        what is coded: where both foretell the same id, order 2 has both weights."""
        share = np.cumsum(self.taken, 1)
        self.mix = np.clip(share[:, :2] * TOTAL // share[:, 2:], (1, 2), (TOTAL - 2, TOTAL - 1))
        np.maximum(self.mix[:, 1], self.mix[:, 0] + 1, out=self.mix[:, 1])
        self.coded = np.zeros((len(share), 4), np.int64)
        self.coded[:, 1:3], self.coded[:, 3] = self.mix, TOTAL
        self.coded[len(share) // 2:, 1] = self.mix[len(share) // 2:, 1]
        self.start = self.coded[:, :3].astype(np.uint64).ravel()
        self.size = np.diff(self.coded).astype(np.uint64).ravel()
        self.one, self.none = (np.ascontiguousarray(self.coded[:, k]).astype(np.uint64) for k in (1, 2))

    @property
    def bounds(self) -> np.ndarray:
        """The bounds of every lane's weights."""
        return self.mix.take(self.state, 0)

    @property
    def edges(self) -> np.ndarray:
        """The bounds of what every lane codes."""
        return self.coded.take(self.state, 0)

    def predict(self) -> np.ndarray:
        """Ids of order 1 and 2 and the state of their weights, for all lanes."""
        lanes = len(self.last)
        self.at[:lanes] = self.last
        two = self.at[lanes:]
        np.multiply(self.last, 0x9E3779B1, out=two)
        two += self.before
        two *= 0x85EBCA6B
        two >>= 24
        two &= CONTEXTS - 1
        two += MAX_ID + 1
        self.found = self.follow.take(self.at).reshape(2, lanes)
        self.sure = self.found & SURE
        self.ids = self.found >> 3
        self.agree = self.ids[0] == self.ids[1]
        state = self.agree.astype(np.int64)
        state <<= 3
        state += self.sure[1]
        state <<= 3
        state += self.sure[0]
        self.state = state
        return self.ids

    def order(self, at: np.ndarray) -> np.ndarray:
        """Which predictions the places ``at`` among the weights mean."""
        order = (at >= self.one.take(self.state)).astype(np.int64)
        order += at >= self.none.take(self.state)
        return order

    def span(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the prediction taken (0 for order 2, 1, 2 for order 0)."""
        at = self.state * 3
        at += order
        return self.start.take(at), self.size.take(at)

    def learn(self, order: np.ndarray, ids: np.ndarray) -> None:
        """After a step: which prediction was taken and the true ids."""
        self.new.append(self.state * 3 + order)
        self.n_new += len(ids)
        if self.n_new >= min(self.n // GROWN, WEIGH):
            self.n += self.n_new
            self.taken += np.bincount(np.concatenate(self.new), minlength=self.taken.size).reshape(-1, 3)
            many = self.taken.sum(1) > WEIGHED
            self.taken[many] = (self.taken[many] + 1) >> 1
            self.new, self.n_new = [], 0
            self._weigh()
        # A wrong prediction loses half its count; without any left it is replaced.
        n = self.sure
        right = self.ids == ids
        found = n >> 1
        found -= n
        found *= ~right
        found += right & (n < SURE)
        found += self.found
        replace = (ids << 3) - found
        replace *= right < (n < 2)
        found += replace
        self.follow[self.at] = found.ravel()
        self.before = self.last
        self.last = ids.astype(np.int64)


class _Writer:
    def __init__(self, lanes: int, expected: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, (1 << _TOP) - 1, np.uint64)
        self.count = np.zeros(lanes, np.int64)
        self.words = np.zeros((expected + 4, lanes), np.uint32)

    def code_all(self, start: np.ndarray, size: np.ndarray) -> None:
        r = self.range
        r >>= np.uint64(BITS)
        start *= r
        self.low += start
        r *= size

    def code(self, lane: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Of some lanes, in the distribution over all ids."""
        r = self.range.take(lane)
        r >>= np.uint64(ID_BITS)
        start *= r
        self.low[lane] += start
        r *= size
        self.range[lane] = r

    def emit(self) -> None:
        out = np.flatnonzero(self.range < _BOTTOM)
        while len(out):
            self.shift(out)
            out = out[self.range.take(out) < _BOTTOM]

    def shift(self, out: np.ndarray) -> None:
        at, low = self.count.take(out), self.low.take(out)
        if at.max() >= len(self.words):
            self.words = np.concatenate([self.words, np.zeros((len(self.words) // 4 + 4, len(self.low)), np.uint32)])
        self.words[at, out] = low >> _SREST     # the bit above WORD is a carry into the word before
        at += 1
        self.count[out] = at
        low &= _REST
        low <<= _SWORD
        self.low[out] = low
        self.range[out] <<= _SWORD

    def payloads(self) -> tuple[np.ndarray, np.ndarray]:
        """Words of all lanes one after the other, and how many each has."""
        every = np.arange(len(self.low))
        for _ in range(3):
            self.shift(every)
        words = self.words[:int(self.count.max())]
        for t in range(len(words) - 1, 0, -1):
            words[t - 1] += words[t] >> WORD
        words &= (1 << WORD) - 1
        used = np.arange(len(words))[:, None] < self.count
        return words.T[used.T], self.count


class _Reader:
    def __init__(self, words: np.ndarray, count: np.ndarray):
        self.words = np.concatenate([words, np.zeros(4, words.dtype)]).astype(np.uint64)
        self.at = np.cumsum(count) - count
        self.range = np.full(len(count), (1 << _TOP) - 1, np.uint64)
        self.held = np.zeros(len(count), np.uint64)
        for _ in range(3):
            self.held = (self.held << _SWORD) | self.words[self.at]
            self.at += 1

    def sight(self) -> tuple[np.ndarray, np.ndarray]:
        """Where among the weights (0 to TOTAL - 1) the lanes' next predictions lie."""
        r = self.range >> np.uint64(BITS)
        return r, np.minimum(self.held // r, np.uint64(TOTAL - 1))

    def took_all(self, r: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        start *= r
        self.held -= start
        r *= size
        self.range = r

    def sight_ids(self, lane: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of some lanes, in the distribution over all ids."""
        r, held = self.range.take(lane), self.held.take(lane)
        r >>= np.uint64(ID_BITS)
        return r, held, np.minimum(held // r, np.uint64(ID_TOTAL - 1)).astype(np.int64)

    def took(self, lane, r, held, start, size) -> None:
        start *= r
        held -= start
        r *= size
        self.held[lane] = held
        self.range[lane] = r

    def fill(self) -> None:
        more = np.flatnonzero(self.range < _BOTTOM)
        while len(more):
            at = self.at.take(more)
            held = self.held.take(more)
            held <<= _SWORD
            held |= self.words.take(at, mode="clip")
            self.held[more] = held
            at += 1
            self.at[more] = at
            self.range[more] <<= _SWORD
            more = more[self.range.take(more) < _BOTTOM]


def encode(ids: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids [position, lane] -> payload words of all lanes one after the other, words of each."""
    length, lanes = ids.shape
    model, out = _Model(lanes, vocabulary), _Writer(lanes, length * 2 // 3)
    order0 = model.order0
    ids = ids.astype(np.int32)
    for true in ids:
        right = model.predict() == true
        order = np.where(right[1], 0, 2 - right[0])
        out.code_all(*model.span(order))
        lane = np.flatnonzero(order == 2)
        if len(lane):
            rest = true.take(lane)
            out.code(lane, order0.start.take(rest), order0.size.take(rest))
            order0.learn(rest)
        out.emit()
        model.learn(order, true)
    return out.payloads()


def decode(words: np.ndarray, count: np.ndarray, length: int, vocabulary: int) -> np.ndarray:
    """The reverse of :func:`encode`."""
    lanes = len(count)
    model, source = _Model(lanes, vocabulary), _Reader(words, count)
    order0 = model.order0
    ids = np.zeros((length, lanes), np.int32)
    for true in ids:
        one, two = model.predict()
        r, at = source.sight()
        order = model.order(at)
        source.took_all(r, *model.span(order))
        true[:] = np.where(order == 0, two, one)
        lane = np.flatnonzero(order == 2)
        if len(lane):
            r, held, at = source.sight_ids(lane)
            rest = order0.found(at)
            source.took(lane, r, held, order0.start.take(rest), order0.size.take(rest))
            true[lane] = rest
            order0.learn(rest)
        source.fill()
        model.learn(order, true)
    return ids


def pack(words: np.ndarray) -> bytes:
    """Payload words as bytes, two of them in five."""
    pairs = np.zeros((len(words) + 1) // 2 * 2, np.uint64)
    pairs[:len(words)] = words
    both = pairs[0::2] | pairs[1::2] << _SWORD
    return both.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpack(data, n: int) -> np.ndarray:
    """The first n words of :func:`pack`'s bytes."""
    five = np.frombuffer(data, np.uint8, (n + 1) // 2 * 5).reshape(-1, 5)
    both = np.zeros((len(five), 8), np.uint8)
    both[:, :5] = five
    both = both.view("<u8").ravel().astype(np.uint64)
    return np.stack([both & np.uint64((1 << WORD) - 1), both >> _SWORD], 1).ravel()[:n].astype(np.uint32)
