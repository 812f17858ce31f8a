"""An adaptive context-mixing range coder for token ids, many blocks at a time.

Each block is coded by itself from a reset model. For the next id three
predictions are mixed linearly: order 2 and order 1 each name the id that
followed the same last two ids or last id before, with a probability learned
for its confidence (0 to 3); order 0 spreads the rest over ids: adaptive counts
of their high bytes, and under each high byte the frequencies that a segment's
``prior`` states for its ids. A reset model starts from the prior, so that
blocks share what is common to them and still stand alone. The mixture's
cumulative counts drive a carryless range coder with 64-bit state that writes
16-bit words.

All blocks of a segment go through the steps side by side, one numpy lane per
block, so that a step costs a few vector operations for all of them.
"""

from __future__ import annotations

import zlib

import numpy as np

U = np.uint64
TOTAL = 32  # bits of the mixture's total count
LEAST = 24  # bits of order 0's own total: 12 for the high byte, 12 for the id under it
SLOTS = 2048
REFRESH = 64
HIGH = LOW = 4096
START = 6000  # weight of the prior's high bytes against 24 for each id met
TOP, BOTTOM = U(48), U(32)
WORD = U(16)
LOW32 = U((1 << 32) - 1)


def make_prior(ids: np.ndarray, classes: int) -> bytes:
    """How often each id occurs, to a quarter of a power of two; single occurrences are left out."""
    count = np.bincount(ids, minlength=classes << 8)
    grade = np.where(count > 1, np.round(4 * np.log2(np.maximum(count, 1))), 0)
    return zlib.compress(grade.astype(np.uint8).tobytes(), 9)


class Prior:
    """Order 0's start: cumulative counts of the ids under each high byte, their inverse, and weights of the high bytes."""

    def __init__(self, stated: bytes | None, classes: int):
        grade = np.frombuffer(zlib.decompress(stated), np.uint8) if stated else np.zeros(classes << 8, np.uint8)
        weight = np.where(grade > 0, np.rint(np.exp2(grade / 4)), 1).astype(np.int64).reshape(classes, 256)
        run = np.cumsum(weight, axis=1)
        edge = np.zeros((classes, 257), np.int64)
        edge[:, 1:] = run * (LOW - 256) // run[:, -1:] + np.arange(1, 257)
        self.low = edge[:, :256].ravel()
        self.width = np.diff(edge, axis=1).ravel()
        self.inverse = np.repeat(np.tile(np.arange(256), classes), self.width)
        self.high = 1 + (START * run[:, -1] // run[:, -1].sum() if stated else np.zeros(classes, np.int64))


class Model:
    """The predictions of all lanes."""

    def __init__(self, lanes: int, classes: int, prior: Prior):
        self.lanes, self.classes = lanes, classes
        self.row = np.arange(lanes)
        self.base = self.row * SLOTS
        self.said = [np.zeros(lanes * SLOTS, np.uint32) for _ in range(2)]  # order 2, order 1
        self.trust = [np.zeros(lanes * SLOTS, np.uint8) for _ in range(2)]
        # Learned probability (of 2^16) that a prediction of a confidence holds.
        self.odds = [np.tile(np.array([600, 24000, 40000, 52000], np.int64), (lanes, 1)).ravel() for _ in range(2)]
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.prior = prior
        self.seen = np.tile(prior.high, (lanes, 1))
        self.edge = np.zeros((lanes, classes + 1), np.int32)
        self.step = 0
        self._refresh()

    def _refresh(self) -> None:
        run = np.cumsum(self.seen, axis=1)
        self.edge[:, 1:] = run * (HIGH - self.classes) // run[:, -1:] + np.arange(1, self.classes + 1)
        self.flat = self.edge.ravel().astype(np.int64)
        self.upper = np.ascontiguousarray(self.edge[:, 1:], np.int16)
        if run[0, -1] > 1 << 20:
            self.seen = (self.seen + 1) >> 1

    def predict(self) -> None:
        self.at = (
            self.base + (((self.last * 40503 + self.before * 2654435761) >> 7) & (SLOTS - 1)),
            self.base + (((self.last * 40503) >> 5) & (SLOTS - 1)),
        )
        self.slot = [(self.row << 2) + self.trust[k][self.at[k]] for k in range(2)]
        self.guess = [self.said[k][self.at[k]].astype(np.int64) for k in range(2)]
        two = self.odds[0][self.slot[0]] * 61000 >> 16
        one = (65536 - two) * self.odds[1][self.slot[1]] * 61000 >> 32
        self.mass = [two << 16, one << 16]
        self.rest = (1 << TOTAL) - self.mass[0] - self.mass[1]

    def _order0(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the ids in order 0's part alone; never empty, as ``rest`` exceeds 2^LEAST."""
        at = self.row * (self.classes + 1) + (ids >> 8)
        edge = self.flat[at]
        width = self.flat[at + 1] - edge
        cum = edge * LOW + width * self.prior.low[ids]
        low = (self.rest * cum) >> LEAST
        return low, ((self.rest * (cum + width * self.prior.width[ids])) >> LEAST) - low

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, size = self._order0(ids)
        for k in range(2):
            low += self.mass[k] * (self.guess[k] < ids)
            size += self.mass[k] * (self.guess[k] == ids)
        return low, size

    def find(self, value: np.ndarray) -> np.ndarray:
        """The id whose interval holds ``value``."""
        swap = self.guess[0] > self.guess[1]
        a, b = np.where(swap, self.guess[1], self.guess[0]), np.where(swap, self.guess[0], self.guess[1])
        fa, fb = np.where(swap, self.mass[1], self.mass[0]), np.where(swap, self.mass[0], self.mass[1])
        at_a, own_a = self._order0(a)
        at_b, own_b = self._order0(b)
        past_a, past_b = value >= at_a + own_a + fa, value >= at_b + own_b + fa + fb
        is_a = (value >= at_a) & ~past_a
        is_b = (value >= at_b + fa) & ~past_b & past_a
        # Equal guesses share one interval, of which the part past ``a``'s share is ``b``'s.
        rest = value - fa * past_a - fb * past_b
        # The greatest cumulative count that starts at or below ``rest``, then its high byte and its id.
        cum = (((rest + 1) << LEAST) - 1) // self.rest
        high = np.count_nonzero(self.upper <= (cum >> 12).astype(np.int16)[:, None], axis=1)
        high = np.minimum(high, self.classes - 1)
        at = self.row * (self.classes + 1) + high
        edge = self.flat[at]
        under = np.clip((cum - edge * LOW) // (self.flat[at + 1] - edge), 0, LOW - 1)
        low = self.prior.inverse[high * LOW + under]
        return np.where(is_a, a, np.where(is_b, b, (high << 8) + low))

    def learn(self, ids: np.ndarray) -> None:
        for k in range(2):
            hit = self.guess[k] == ids
            odds = self.odds[k][self.slot[k]]
            self.odds[k][self.slot[k]] = odds + ((np.where(hit, 65000, 300) - odds) >> 5)
            trust = self.trust[k][self.at[k]]
            fresh = ~hit & (trust == 0)
            self.said[k][self.at[k]] = np.where(fresh, ids, self.guess[k])
            self.trust[k][self.at[k]] = np.where(hit, np.minimum(trust + 1, 3), np.where(fresh, 0, trust - (trust > 0)))
        self.seen[self.row, ids >> 8] += 24
        self.before, self.last = self.last, ids
        self.step += 1
        if self.step % REFRESH == 0:
            self._refresh()


def _settled(low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lanes that must shift out a word, after shortening intervals that straddle a word edge."""
    same = ((low ^ (low + size)) >> TOP) == 0
    tight = ~same & (size < (U(1) << BOTTOM))
    if tight.any():
        size = np.where(tight, (U(0) - low) & LOW32, size)
    return np.flatnonzero(same | tight), size


def encode_blocks(ids: np.ndarray, block: int, classes: int, prior: bytes | None = None) -> list[bytes]:
    """One byte string per ``block`` ids; the last block may be shorter. Reading needs the same ``prior``."""
    n = len(ids)
    if not n:
        return []
    lanes = -(-n // block)
    padded = np.zeros(lanes * block, np.int64)
    padded[:n] = ids
    steps = padded.reshape(lanes, block).T
    tail = n - (lanes - 1) * block  # ids of the last lane
    model = Model(lanes, classes, Prior(prior, classes))
    low, size = np.zeros(lanes, U), np.full(lanes, (1 << 64) - 1, U)
    words = np.zeros((lanes, block * 3 + 8), "<u2")
    used = np.zeros(lanes, np.int64)
    # The last lane goes on over zeros; what it wrote up to its last id is kept.
    end_last = None
    for t in range(block):
        if t == tail and end_last is None:
            end_last = _finished(words[-1], int(used[-1]), int(low[-1]))
            if lanes == 1:
                break
        now = np.ascontiguousarray(steps[t])
        model.predict()
        start, width = model.interval(now)
        unit = size >> U(TOTAL)
        low = low + unit * start.astype(U)
        size = unit * width.astype(U)
        out, size = _settled(low, size)
        while len(out):
            words[out, used[out]] = (low[out] >> TOP).astype(np.uint16)
            used[out] += 1
            low[out] <<= WORD
            size[out] <<= WORD
            out, size = _settled(low, size)
        model.learn(now)
    last = lanes - 1 if end_last is not None else lanes
    coded = [_finished(words[i], int(used[i]), int(low[i])) for i in range(last)]
    return coded + ([end_last] if end_last is not None else [])


def _finished(words: np.ndarray, used: int, low: int) -> bytes:
    rest = np.array([(low >> s) & 0xFFFF for s in (48, 32, 16, 0)], "<u2")
    return words[:used].tobytes() + rest.tobytes()


def decode_blocks(coded: list[bytes], counts: list[int], classes: int, prior: bytes | None = None) -> list[np.ndarray]:
    """The ids of each block."""
    lanes = len(coded)
    if not lanes:
        return []
    most = max(counts)
    sizes = np.array([len(c) // 2 for c in coded])
    words = np.zeros((lanes, int(sizes.max()) + 3 * most + 8), "<u2") if lanes == 1 else np.zeros((lanes, int(sizes.max()) + 8), "<u2")
    for i, c in enumerate(coded):
        words[i, : sizes[i]] = np.frombuffer(c, "<u2")
    limit = words.shape[1] - 1
    model = Model(lanes, classes, Prior(prior, classes))
    low, size = np.zeros(lanes, U), np.full(lanes, (1 << 64) - 1, U)
    code = np.zeros(lanes, U)
    for k in range(4):
        code = (code << WORD) | words[:, k].astype(U)
    used = np.full(lanes, 4, np.int64)
    out = np.zeros((most, lanes), np.int64)
    top = U((1 << TOTAL) - 1)
    for t in range(most):
        model.predict()
        unit = size >> U(TOTAL)
        value = np.minimum((code - low) // unit, top).astype(np.int64)
        now = model.find(value)
        out[t] = now
        start, width = model.interval(now)
        low = low + unit * start.astype(U)
        size = unit * width.astype(U)
        shift, size = _settled(low, size)
        while len(shift):
            code[shift] = (code[shift] << WORD) | words[shift, np.minimum(used[shift], limit)].astype(U)
            used[shift] += 1
            low[shift] <<= WORD
            size[shift] <<= WORD
            shift, size = _settled(low, size)
        model.learn(now)
    return [np.ascontiguousarray(out[:c, i]) for i, c in enumerate(counts)]
