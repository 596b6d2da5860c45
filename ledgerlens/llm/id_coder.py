"""Adaptive context-mixing coder for token ids (operator 11): one block at a time, numpy only.

A block's ids are dealt to up to LANES lanes of neighbouring ids. All lanes
advance in lockstep and share one model, so each step is a handful of numpy
calls and the model learns from every lane; each lane has a coder state of its
own (a range variant of asymmetric numeral systems). All lanes read one stream of
32-bit words: at each step those whose state has run low take the next words in the order of the lanes.
Nothing outlives a block: any block decodes alone.

Three orders predict each id. Order 2 (a hashed table over the two ids before)
and order 1 (over the id before) each name one id with a confidence; order 0 is
a distribution over the whole vocabulary. The orders are mixed by the
frequencies with which, in each joint state of the confidences, order 2, order
1 or neither was right so far in the block. All interval bounds are integers,
so the decoder repeats them exactly.

The states work backwards: the coder lets the model run over the block first, keeping
the interval of every choice, and codes them from the last to the first.
"""

from __future__ import annotations

import numpy as np

LANES = 4096
# Lanes get at least so many ids, as each lane's coder costs some bytes to flush.
MIN_LANE_IDS = 64
MIX_BITS = 16
ORDER0_BITS = 20
_U = np.uint64
_WORD, _LOW32 = _U(32), _U(2**32 - 1)
# A state is at least this between two choices; below it takes a word.
_LOW_BITS = 24
_LOW = _U(1 << _LOW_BITS)
# Bits of a slot in the order-2 table, and the factors of its hash.
_SLOT_BITS = 17
_HASH1, _HASH2 = np.uint32(2654435761), np.uint32(2246822519)
# The tables hold an id and its confidence (0 to _MOST) in one number; no id: -1 with confidence 0.
_SURE_BITS = 3
_MOST = (1 << _SURE_BITS) - 1
_NOTHING = -1 << _SURE_BITS
# The gain of an id seen.
_GAIN = 48


def lane_layout(n: int) -> tuple[int, int]:
    """(lanes, ids a lane) of a block of n ids; the last lane may be shorter."""
    lanes = max(1, min(LANES, n // MIN_LANE_IDS))
    each = -(-n // lanes) if n else 0
    return (-(-n // each) if n else 0), each


class _Model:
    """Predictions of the three orders and their mixture; `learn` is called alike by coder and decoder."""

    def __init__(self, vocabulary: int):
        self.size = vocabulary
        self.table1 = np.full(vocabulary, _NOTHING, np.int32)
        self.table2 = np.full(1 << _SLOT_BITS, _NOTHING, np.int32)
        states = 2 * (_MOST + 1) ** 2
        self.hits = np.ones((states, 3), np.int64)
        self.hits[:, 2] = 4
        self.start, self.width = np.zeros((states, 3), np.int64), np.zeros((states, 3), np.int64)
        self.counts = np.ones(vocabulary, np.int64)
        self.waiting: list[np.ndarray] = []
        self.choices: list[np.ndarray] = []
        self.step = 0
        self._bounds()
        self._shares()

    def _bounds(self) -> None:
        """Cumulative order-0 frequencies of sum 2^ORDER0_BITS, at least 1 each."""
        total = np.concatenate([[0], np.cumsum(self.counts)])
        room = float((1 << ORDER0_BITS) - self.size) / float(total[-1])
        self.cum = (total * room).astype(np.int64) + np.arange(self.size + 1)
        self.cum[-1] = 1 << ORDER0_BITS
        self.owner = None

    def owners(self) -> np.ndarray:
        """The id that each of the 2^ORDER0_BITS places of order 0 falls to (for the decoder)."""
        if self.owner is None:
            self.owner = np.repeat(np.arange(self.size, dtype=np.int32), np.diff(self.cum))
        return self.owner

    def _shares(self) -> None:
        """Where the shares of the outcomes (order 2, order 1, neither) begin in each state and how wide they are, of sum 2^MIX_BITS."""
        c = np.cumsum(self.hits, axis=1)
        self.start[:, 1:] = c[:, :2] * ((1 << MIX_BITS) - 3) // c[:, 2:] + np.array([1, 2])
        self.width[:, :2] = np.diff(self.start, axis=1)
        self.width[:, 2] = (1 << MIX_BITS) - self.start[:, 2]

    def predict(self, p1: np.ndarray, p2: np.ndarray) -> None:
        self.p1 = p1
        self.slot = ((p1.astype(np.uint32) * _HASH1 + p2.astype(np.uint32) * _HASH2) >> np.uint32(32 - _SLOT_BITS)).astype(np.intp)
        self.said2, self.said1 = self.table2.take(self.slot), self.table1.take(p1)
        self.a2, self.a1 = self.said2 >> _SURE_BITS, self.said1 >> _SURE_BITS
        self.s2, self.s1 = self.said2 & _MOST, self.said1 & _MOST
        # three outcomes a state
        self.base = (((self.s2 << _SURE_BITS) + self.s1) * 2 + (self.a1 == self.a2)) * 3

    def learn(self, ids: np.ndarray, kind: np.ndarray, choice: np.ndarray, rest: np.ndarray) -> None:
        """Take the ids of a step, their outcomes, and the places of those that no order named."""
        self.step += 1
        self.choices.append(choice)
        seen = ids.astype(np.int32)
        fresh = (seen << _SURE_BITS) + 1
        for table, at, said, name, sure in (
            (self.table2, self.slot, self.said2, self.a2, self.s2), (self.table1, self.p1, self.said1, self.a1, self.s1)):
            # a wrong id keeps its place with half the confidence if that was above 1
            wrong = np.where(sure > 1, said - ((sure + 1) >> 1), fresh)
            table[at] = np.where(seen == name, said + (sure < _MOST), wrong)
        self.waiting.append(ids[rest])
        # early steps matter most: the shares are renewed at steps 1 to 16, then every fourth,
        if self.step <= 16 or self.step % 4 == 0:
            self.hits += 16 * np.bincount(np.concatenate(self.choices), minlength=self.hits.size).reshape(self.hits.shape)
            self.choices = []
            self._shares()
        # the distribution at steps 1 to 8, then every eighth, from 32 on every 32nd
        if self.step <= 8 or self.step % (8 if self.step < 32 else 32) == 0:
            self.counts += _GAIN * np.bincount(np.concatenate(self.waiting), minlength=self.size)
            self.waiting = []
            self._bounds()


def _put(state: np.ndarray, start: np.ndarray, width: np.ndarray, bits: int, out: list[np.ndarray]) -> np.ndarray:
    """The states after a choice was coded; words of states that would grow too large go out first."""
    full = np.flatnonzero(state >= width << _U(_LOW_BITS + 32 - bits))
    if len(full):
        high = state[full]
        out.append((high & _LOW32).astype(np.uint32)[::-1])
        state[full] = high >> _WORD
    turns = state // width
    return (turns << _U(bits)) + (state - turns * width) + start


class _Reader:
    def __init__(self, words: np.ndarray, state: np.ndarray):
        self.words, self.at, self.state = words.astype(_U), 0, state.astype(_U)

    def take(self, state: np.ndarray, place: np.ndarray, start: np.ndarray, width: np.ndarray, bits: int) -> np.ndarray:
        """The states after a choice was read whose interval holds `place`."""
        state = width.view(_U) * (state >> _U(bits)) + (place - start).view(_U)
        low = np.flatnonzero(state < _LOW)
        if len(low):
            state[low] = (state[low] << _WORD) | self.words[self.at : self.at + len(low)]
            self.at += len(low)
        return state


def _active(n: int, lanes: int, each: int, t: int) -> int:
    """Lanes that have an id at step t: all but perhaps the last."""
    return lanes if t < n - (lanes - 1) * each else lanes - 1


def encode_ids(ids: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """(the stream of all lanes as 16-bit words, the state from which each lane is decoded) of a block's ids, all below `vocabulary`."""
    n = len(ids)
    lanes, each = lane_layout(n)
    if not n:
        return np.zeros(0, np.uint16), np.zeros(0, _U)
    grid = np.zeros(lanes * each, np.int64)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, each).T)
    model, chosen = _Model(vocabulary), []
    zero = np.zeros(lanes, np.int64)
    for t in range(each):
        m = _active(n, lanes, each, t)
        x = grid[t, :m]
        model.predict((grid[t - 1] if t else zero)[:m], (grid[t - 2] if t > 1 else zero)[:m])
        kind = np.where(x == model.a2, 0, 2 - (x == model.a1))
        choice = model.base + kind
        rest = np.flatnonzero(kind == 2)
        named = x[rest]
        low = model.cum.take(named)
        chosen.append((model.start.take(choice), model.width.take(choice), rest, low, model.cum.take(named + 1) - low))
        model.learn(x, kind, choice, rest)
    state, out = np.full(lanes, _LOW, _U), []
    while chosen:
        start, width, rest, low, room = chosen.pop()
        m = len(start)
        if len(rest):
            state[rest] = _put(state[rest], low.view(_U), room.view(_U), ORDER0_BITS, out)
        state[:m] = _put(state[:m], start.view(_U), width.view(_U), MIX_BITS, out)
    words = np.concatenate(out)[::-1] if out else np.zeros(0, np.uint32)
    return words.astype("<u4").view("<u2"), state


def decode_ids(words: np.ndarray, states: np.ndarray, n: int, vocabulary: int) -> np.ndarray:
    """The n ids of a block, from `encode_ids`' words and states."""
    lanes, each = lane_layout(n)
    if not n:
        return np.zeros(0, np.int64)
    grid = np.zeros((each, lanes), np.int64)
    model = _Model(vocabulary)
    src = _Reader(np.ascontiguousarray(words, "<u2").view("<u4"), states)
    zero = np.zeros(lanes, np.int64)
    mixed, all_places = _U((1 << MIX_BITS) - 1), _U((1 << ORDER0_BITS) - 1)
    for t in range(each):
        m = _active(n, lanes, each, t)
        model.predict((grid[t - 1] if t else zero)[:m], (grid[t - 2] if t > 1 else zero)[:m])
        state = src.state[:m]
        at, base = (state & mixed).view(np.int64), model.base
        kind = (at >= model.start.take(base + 1)).astype(np.int32) + (at >= model.start.take(base + 2))
        choice = base + kind
        state = src.take(state, at, model.start.take(choice), model.width.take(choice), MIX_BITS)
        x = np.where(kind == 0, model.a2, model.a1).astype(np.int64)
        rest = np.flatnonzero(kind == 2)
        if len(rest):
            at = (state[rest] & all_places).view(np.int64)
            x[rest] = found = model.owners().take(at).astype(np.int64)
            low = model.cum.take(found)
            state[rest] = src.take(state[rest], at, low, model.cum.take(found + 1) - low, ORDER0_BITS)
        src.state[:m] = state
        model.learn(x, kind, choice, rest)
        grid[t, :m] = x
    return grid.T.reshape(-1)[:n]
