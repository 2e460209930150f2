"""Range coder over token ids with order-0 to order-2 predictions.

A block of ids is cut into lanes of consecutive ids. All lanes advance one id per
step, so every step is a few array operations; the lanes share one model, which
is fresh in each block. At every id the order-2 and order-1 contexts each predict
the id that followed them last, with a confidence of past hits. The two
confidences and whether the predictions agree choose a state; the state's adaptive
counts mix the three models: the chance of the order-2 prediction, of the order-1
prediction, and of any id by its order-0 frequency. The mixed chances drive a
carry-less range coder with a 64-bit low and 32-bit output words per lane.

Frequencies are refreshed after steps 1, 2, 4, ... and then every ``REFRESH``
steps, so encoder and decoder see the same tables. The model knows the block's own
ids only, numbered in ascending order, so ids that do not occur take no share of the
order-0 frequencies. Layout of a block, all numbers little-endian: magic ``TGC2``,
crc32 of the rest, number of ids, lanes, number of distinct ids, size of their list,
the list (differences, deflated), words per lane, words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TGC2"
HEADER = struct.Struct("<4sIIIII")
#: Ids per lane aimed at, and lanes of a block at most.
LANE, LANES = 256, 4096
REFRESH = 32
MIX_BITS, ID_BITS = 12, 20
CONTEXT_BITS = 20
#: Confidence runs from 0 to this; state = 2 confidences and whether they agree.
SURE = 7
STATES = 2 * (SURE + 1) ** 2

_U = np.uint64
_LOW32, _S32 = _U((1 << 32) - 1), _U(32)
_SID, _SALL = _U(ID_BITS), _U(MIX_BITS + ID_BITS)


#: What a confidence becomes, at ``confidence + 8 * hit``.
NEXT = np.array([s >> 2 for s in range(SURE + 1)] + [min(s + 1, SURE) for s in range(SURE + 1)], dtype=np.int32)


class Model:
    """Adaptive state of one block.

    ``after1`` and ``after2`` hold id * 8 + confidence by context. A case is 4 * state +
    2 * (the order-2 prediction came true) + (the order-1 prediction did). The interval
    of an id begins at ``begin`` of its case plus ``share`` times the id's order-0 begin,
    and is ``width`` plus ``share`` times its order-0 frequency wide; ``share`` is 0
    where a prediction came true, ``width`` is 0 where none did.
    """

    def __init__(self, alphabet: int):
        self.alphabet = alphabet
        self.after1 = np.zeros(alphabet + 1, dtype=np.int32)
        self.after2 = np.zeros(1 << CONTEXT_BITS, dtype=np.int32)
        self.seen = np.zeros(alphabet, dtype=np.int64)
        self.mixed = np.ones((STATES, 3), dtype=np.int64)
        self.mixed[:, 2] = 4
        self.fresh_ids: list[np.ndarray] = []
        self.fresh_cases: list[np.ndarray] = []
        self.refresh()

    def refresh(self) -> None:
        if self.fresh_ids:
            self.seen += np.bincount(np.concatenate(self.fresh_ids), minlength=self.alphabet)
            cases = np.bincount(np.concatenate(self.fresh_cases), minlength=4 * STATES).reshape(STATES, 4)
            # An order-2 prediction that came true counts, whatever the other did.
            self.mixed += np.stack([cases[:, 2] + cases[:, 3], cases[:, 1], cases[:, 0]], axis=1)
            self.fresh_ids, self.fresh_cases = [], []
        spare = (1 << ID_BITS) - self.alphabet
        freq = self.seen * spare // max(1, int(self.seen.sum())) + 1
        freq[int(freq.argmax())] += (1 << ID_BITS) - int(freq.sum())
        self.freq = freq
        self.id_freq = freq.astype(np.uint64)
        self.id_start = (np.cumsum(freq) - freq).astype(np.uint64)
        shares = self.mixed * ((1 << MIX_BITS) - 3) // self.mixed.sum(axis=1, keepdims=True) + 1
        shares[:, 2] += (1 << MIX_BITS) - shares.sum(axis=1)
        ends = np.cumsum(shares, axis=1)
        begins = ends - shares
        none = np.zeros(STATES, dtype=np.int64)
        self.begin = _table(begins[:, 2], begins[:, 1], begins[:, 0], begins[:, 0]) << _SID
        self.width = _table(none, shares[:, 1], shares[:, 0], shares[:, 0]) << _SID
        self.share = _table(shares[:, 2], none, none, none)
        self.end2, self.end1 = (ends[:, i].astype(np.uint64) << _SID for i in range(2))

    def slots(self) -> np.ndarray:
        """The id at each order-0 slot."""
        kind = np.uint16 if self.alphabet <= 1 << 16 else np.int32
        return np.repeat(np.arange(self.alphabet, dtype=kind), self.freq)

    def predict(self, prev1: np.ndarray, prev2: np.ndarray) -> np.ndarray:
        """The state of each lane."""
        self.ctx1 = prev1
        self.ctx2 = (prev2 * 40503 + prev1 * -1640531535) & ((1 << CONTEXT_BITS) - 1)
        self.held1, self.held2 = self.after1.take(prev1), self.after2.take(self.ctx2)
        self.sure1, self.sure2 = self.held1 & SURE, self.held2 & SURE
        return (self.sure2 << 4) | (self.sure1 << 1) | ((self.held1 ^ self.held2) <= SURE)

    def learn(self, ids: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Take the ids in; returns begin, width and share of each lane's case. Lanes with
        the same context write in turn; the last one stays."""
        wide = ids.astype(np.int32) << 3
        hit1, hit2 = ((held ^ wide) <= SURE for held in (self.held1, self.held2))
        case = ((state << 2) | (hit2.view(np.int8) << 1) | hit1).astype(np.intp)
        self.after1[self.ctx1] = wide | NEXT.take(self.sure1 | (hit1.view(np.int8) << 3))
        self.after2[self.ctx2] = wide | NEXT.take(self.sure2 | (hit2.view(np.int8) << 3))
        self.fresh_ids.append(ids)
        self.fresh_cases.append(case)
        return self.begin.take(case), self.width.take(case), self.share.take(case)


def _table(*by_case: np.ndarray) -> np.ndarray:
    return np.stack(by_case, axis=1).ravel().astype(np.uint64)


def due(step: int) -> bool:
    """Whether the tables are refreshed after this many steps."""
    return step % REFRESH == 0 or step < REFRESH and step & (step - 1) == 0


def lanes_for(count: int) -> int:
    return max(1, min(LANES, count // LANE))


def active(count: int, lanes: int, step: int) -> int:
    """Lanes that have an id at this step; ids are dealt to lanes in order."""
    size, longer = divmod(count, lanes)
    return lanes if step < size else longer


def by_step(ids: np.ndarray, lanes: int) -> np.ndarray:
    """The ids of consecutive lanes as a row per step; shorter lanes end in a zero."""
    size, longer = divmod(len(ids), lanes)
    grid = np.zeros((size + (longer > 0), lanes), dtype=ids.dtype)
    cut = longer * (size + 1)
    grid[:, :longer] = ids[:cut].reshape(longer, -1).T if longer else 0
    grid[:size, longer:] = ids[cut:].reshape(-1, size).T
    return grid


def by_lane(grid: np.ndarray, count: int) -> np.ndarray:
    """What :func:`by_step` was given."""
    size, longer = divmod(count, grid.shape[1])
    return np.concatenate([grid[:, :longer].T.ravel(), grid[:size, longer:].T.ravel()])


def encode_block(ids: np.ndarray) -> bytes:
    """A block of at least one id."""
    present = np.flatnonzero(np.bincount(ids))
    count, lanes, alphabet = len(ids), lanes_for(len(ids)), len(present)
    rank = np.zeros(int(present[-1]) + 1, dtype=np.intp)
    rank[present] = np.arange(alphabet)
    grid = by_step(rank.take(ids), lanes)
    model = Model(alphabet)
    low, span = np.zeros(lanes, dtype=np.uint64), np.full(lanes, (1 << 64) - 1, dtype=np.uint64)
    prev1 = prev2 = np.full(lanes, alphabet, dtype=np.intp)
    out_lane, out_word = [], []
    for step in range(len(grid)):
        n = active(count, lanes, step)
        x = grid[step, :n]
        begin, width, share = model.learn(x, model.predict(prev1[:n], prev2[:n]))
        unit = span[:n] >> _SALL
        begin += share * model.id_start.take(x)
        begin *= unit
        low[:n] += begin
        share *= model.id_freq.take(x)
        width += share
        np.multiply(unit, width, out=span[:n])
        settled, words = settle(low, span, n)
        out_lane.append(settled)
        out_word.append(words)
        prev1, prev2 = x, prev1[:n]
        if due(step + 1):
            model.refresh()
    for _ in range(2):
        out_lane.append(np.arange(lanes))
        out_word.append(low >> _S32)
        low <<= _S32
    lane, words = np.concatenate(out_lane), np.concatenate(out_word)
    order = np.argsort(lane.astype(np.uint16) if lanes <= 1 << 16 else lane, kind="stable")
    body = np.bincount(lane, minlength=lanes).astype("<u4").tobytes() + words[order].astype("<u4").tobytes()
    listed = zlib.compress(np.diff(present, prepend=0).astype("<u4").tobytes())
    tail = struct.pack("<IIII", count, lanes, alphabet, len(listed)) + listed + body
    return MAGIC + struct.pack("<I", zlib.crc32(tail)) + tail


def settle(low: np.ndarray, span: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shift out the upper word of every lane whose span fell below 32 bits.

    A span that crosses into the next word is cut there, so no carry is left.
    """
    lanes = np.flatnonzero(span[:n] <= _LOW32)
    a, s = low.take(lanes), span.take(lanes)
    same = ((a ^ (a + s)) >> _S32) == 0
    span[lanes] = np.where(same, s, (~a + _U(1)) & _LOW32) << _S32
    low[lanes] = a << _S32
    return lanes, a >> _S32


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block; raises ValueError where the block is damaged."""
    if len(block) < HEADER.size or block[:4] != MAGIC:
        raise ValueError("not a block of coded ids")
    _, check, count, lanes, alphabet, listed = HEADER.unpack_from(block)
    if zlib.crc32(memoryview(block)[8:]) != check:
        raise ValueError("checksum of a block of coded ids does not match")
    body = HEADER.size + listed
    steps = np.frombuffer(zlib.decompress(block[HEADER.size : body]), "<u4")
    present = np.cumsum(steps, dtype=np.int64)
    lengths = np.frombuffer(block, "<u4", lanes, body).astype(np.int64)
    words = np.frombuffer(block, "<u4", -1, body + 4 * lanes).astype(np.uint32)
    at = np.cumsum(lengths) - lengths
    model = Model(alphabet)
    at_slot = model.slots()
    code = (words[at].astype(np.uint64) << _S32) | words[at + 1]
    at += 2
    low, span = np.zeros(lanes, dtype=np.uint64), np.full(lanes, (1 << 64) - 1, dtype=np.uint64)
    prev1 = prev2 = np.full(lanes, alphabet, dtype=np.intp)
    grid = np.zeros((-(-count // lanes), lanes), dtype=np.intp)
    most = _U((1 << (MIX_BITS + ID_BITS)) - 1)
    for step in range(len(grid)):
        n = active(count, lanes, step)
        state = model.predict(prev1[:n], prev2[:n])
        unit = span[:n] >> _SALL
        value = np.minimum((code[:n] - low[:n]) // unit, most)
        end1 = model.end1.take(state)
        x = grid[step, :n]
        x[:] = np.where(value < model.end2.take(state), model.held2, model.held1) >> 3
        rest = np.flatnonzero(value >= end1)
        # Below 2^32 by below 2^12: the quotient of doubles has the same whole part.
        past = (value.take(rest) - end1.take(rest)).astype(np.int64)
        share = model.share.take(state.take(rest) << 2).astype(np.int64)
        x[rest] = at_slot.take((past / share).astype(np.intp))
        begin, width, share = model.learn(x, state)
        begin += share * model.id_start.take(x)
        begin *= unit
        low[:n] += begin
        share *= model.id_freq.take(x)
        width += share
        np.multiply(unit, width, out=span[:n])
        settled, _ = settle(low, span, n)
        place = at.take(settled)
        code[settled] = (code.take(settled) << _S32) | words.take(place)
        at[settled] = place + 1
        prev1, prev2 = x, prev1[:n]
        if due(step + 1):
            model.refresh()
            at_slot = model.slots()
    return present[by_lane(grid, count)].astype(np.int32)
