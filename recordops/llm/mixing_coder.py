"""Adaptive context-mixing range coder for token ids, in independently reset blocks.

A block is cut into lanes that are coded in step. Before each step the id of every
lane is predicted by three models that all lanes of the block share and feed: the id
that last followed the two preceding ids (order 2), the one that last followed the
preceding id (order 1), and the frequencies so far (order 0); ids not seen yet are
uniform. The confidences of the two contexts select the weights with which the
predictions are mixed; the weights follow what has been coded. The id's interval in
the mixture narrows the lane's range; 16-bit words leave at the top, and a carry is
added to those that have left. The decoder makes the same predictions. Nothing is kept
from one block to the next.

Block: magic, number of ids, lanes, CRC-32 of the ids, CRC-32 of what follows,
then the number of words of each lane and the words, all little-endian.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"CMR2"
HEAD = struct.Struct("<4sIIII")
WEIGHT_BITS, ID_BITS = 12, 16
TOTAL_BITS = WEIGHT_BITS + ID_BITS
PAIR_BITS = 18
SHARE_BITS = ID_BITS + 1
WHOLE = 1 << ID_BITS
U = np.uint64
WORD, TOP, UNIT, LEAST = U(16), U(48), U(TOTAL_BITS), U(1 << 32)
SPREAD, SPREAD_PAIR = np.uint32(2654435761), np.uint32(2246822519)
#: What a guess's confidence gains, by confidence and, four further, that of a right guess.
SURER = np.array([0, -1, -1, -1, 1, 1, 1, 0], np.int32)


class Damaged(ValueError):
    """The block is not what was written."""


class Mixture:
    """What both coder and decoder know of a block at a step."""

    def __init__(self, lanes: int):
        self.one = np.zeros(WHOLE, np.int32)  # id << 2 | confidence, by the preceding id
        self.two = np.zeros(1 << PAIR_BITS, np.int32)  # the same by the two preceding ids
        self.wins = np.tile(np.array([2, 2, 3, 1], np.int64), (32, 1))
        self.counts = np.zeros(WHOLE, np.int64)
        self.fresh: list[np.ndarray] = []
        self.cells: list[np.ndarray] = []
        self.step = 0
        self.first = np.zeros(lanes, np.intp)
        self.second = np.zeros(lanes, np.uint32)  # a hash of the id before the preceding one
        self.hash = np.zeros(lanes, np.uint32)  # that of the preceding one
        self.frequencies()
        self.weights()

    def frequencies(self):
        if self.fresh:
            self.counts += np.bincount(np.concatenate(self.fresh), minlength=WHOLE)
        self.fresh = []
        seen = np.flatnonzero(self.counts)
        # an id not seen yet takes one of 65,536 equal parts, numbered by the id itself
        share = np.ones(WHOLE, np.int64)
        below = np.arange(WHOLE)
        self.unseen = np.full(WHOLE, 3, np.uint8)  # the outcome of an id that no context has guessed
        self.by_slot = np.arange(WHOLE, dtype=np.int32)
        if len(seen):
            got = self.counts[seen]
            part = 1 + got * (WHOLE - len(seen)) // got.sum()
            part[np.argmax(part)] += WHOLE - part.sum()
            share[seen] = part
            below[seen] = np.cumsum(part) - part
            self.unseen[seen] = 2
            self.by_slot = np.repeat(seen.astype(np.int32), part)
        self.place_of = below << SHARE_BITS | share

    def weights(self):
        if self.cells:
            self.wins += np.bincount(np.concatenate(self.cells), minlength=128).reshape(32, 4) * 8
            heavy = self.wins.sum(1) > 1 << 20
            self.wins[heavy] = (self.wins[heavy] + 1) >> 1
        self.cells = []
        total = self.wins.sum(1, keepdims=True)
        part = 1 + self.wins * ((1 << WEIGHT_BITS) - 4) // total
        part[:, 2] += (1 << WEIGHT_BITS) - part.sum(1)
        self.part = part.ravel()
        self.from_ = (np.cumsum(part, 1) - part).ravel() << ID_BITS

    def predict(self):
        self.place = ((self.hash + self.second) >> np.uint32(32 - PAIR_BITS)).astype(np.intp)
        self.old2 = self.two.take(self.place, mode="clip")
        self.old1 = self.one.take(self.first, mode="clip")
        self.guess2, self.guess1 = self.old2 >> 2, self.old1 >> 2
        self.sure2, self.sure1 = self.old2 & 3, self.old1 & 3
        context = self.sure2 << 2
        context |= self.sure1
        context += (self.guess1 == self.guess2).view(np.int8) << np.int8(4)
        context <<= 2
        self.context = context

    def interval(self, ids: np.ndarray, outcome: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the ids' intervals in units of the lanes' ranges."""
        self.cell = (self.context + outcome).astype(np.intp)
        part = self.part.take(self.cell, mode="clip")
        place = self.place_of.take(ids, mode="clip")
        np.copyto(place, WHOLE, where=outcome < 2)
        size = (place & ((1 << SHARE_BITS) - 1)) * part
        start = place >> SHARE_BITS
        start *= part
        start += self.from_.take(self.cell, mode="clip")
        return unit * start.view(U), unit * size.view(U)

    def learn(self, ids: np.ndarray, short: np.ndarray, hit2: np.ndarray, hit1: np.ndarray):
        packed = short << 2
        for memory, place, old, sure, hit in (
            (self.two, self.place, self.old2, self.sure2, hit2),
            (self.one, self.first, self.old1, self.sure1, hit1),
        ):
            # right: one surer; wrong: one less sure, or replaced once not sure at all
            case = sure + (hit.view(np.int8) << np.int8(2))
            new = old + SURER.take(case, mode="clip")
            np.copyto(new, packed, where=case == 0)
            memory[place] = new
        self.first, self.second = ids, self.hash * SPREAD_PAIR
        self.hash = short.view(np.uint32) * SPREAD
        self.fresh.append(ids)
        self.cells.append(self.cell)
        self.step += 1
        if self.step < 16 or self.step % 4 == 0:
            self.weights()
        if self.step & (self.step - 1) == 0 or self.step % 32 == 0:
            self.frequencies()


def shape(n: int) -> tuple[int, int]:
    lanes = max(1, min(4096, n // 128))
    return lanes, -(-n // lanes)


def pack(ids: np.ndarray) -> bytes:
    """A block of ids below 65,536."""
    n = len(ids)
    if n and int(ids.max()) >> ID_BITS:
        raise ValueError("ids must be below 65,536")
    lanes, steps = shape(n)
    grid = np.zeros(lanes * steps, np.intp)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model = Mixture(lanes)
    low, span = np.zeros(lanes, U), np.full(lanes, np.iinfo(U).max, U)
    every = np.arange(lanes)
    at = np.zeros(lanes, np.int64)
    who: list[np.ndarray] = []
    words: list[np.ndarray] = []
    carried: list[tuple[np.ndarray, np.ndarray]] = []
    for s in grid:
        model.predict()
        short = s.astype(np.int32)
        hit2, hit1 = short == model.guess2, short == model.guess1
        outcome = model.unseen.take(s, mode="clip")
        np.copyto(outcome, 1, where=hit1)
        np.copyto(outcome, 0, where=hit2)
        start, span = model.interval(s, outcome, span >> UNIT)
        low += start
        over = low < start
        if over.any():
            over = np.flatnonzero(over)
            carried.append((over, at[over] - 1))
        todo = np.flatnonzero(span < LEAST)
        while len(todo):
            a, b = low[todo], span[todo] << WORD
            who.append(todo.astype(np.uint16))
            words.append((a >> TOP).astype(np.uint16))
            at[todo] += 1
            low[todo], span[todo] = a << WORD, b
            todo = todo[b < LEAST]
        model.learn(s, short, hit2, hit1)
    for _ in range(4):
        who.append(every.astype(np.uint16))
        words.append((low >> TOP).astype(np.uint16))
        low <<= WORD
    at += 4
    used = np.concatenate(words)[np.argsort(np.concatenate(who), kind="stable")].astype(np.int64)
    first = np.cumsum(at) - at
    add = np.concatenate([first[lane] + place for lane, place in carried]) if carried else []
    while len(add):
        np.add.at(used, add, 1)
        add = np.unique(add)
        add = add[used[add] > 0xFFFF]
        used[add] &= 0xFFFF
        add = add - 1
    body = at.astype("<u4").tobytes() + used.astype("<u2").tobytes()
    return HEAD.pack(MAGIC, n, lanes, zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body)) + body


def unpack(block: bytes) -> np.ndarray:
    """The ids of a block; raises Damaged if either checksum differs."""
    if len(block) < HEAD.size:
        raise Damaged("too short")
    magic, n, lanes, crc, body_crc = HEAD.unpack_from(block)
    body = block[HEAD.size :]
    if magic != MAGIC or zlib.crc32(body) != body_crc or lanes != shape(n)[0]:
        raise Damaged("header or checksum differs")
    steps = shape(n)[1]
    sizes = np.frombuffer(body, "<u4", lanes).astype(np.int64)
    words = np.concatenate([np.frombuffer(body, "<u2", offset=4 * lanes), np.zeros(4, np.uint16)])
    at = np.cumsum(sizes) - sizes
    code = np.zeros(lanes, U)  # the lanes' numbers above their lower bounds
    for _ in range(4):
        code = code << WORD | words[at]
        at += 1
    model = Mixture(lanes)
    span = np.full(lanes, np.iinfo(U).max, U)
    out = np.zeros((steps, lanes), np.uint16)
    for t in range(steps):
        model.predict()
        unit = span >> UNIT
        value = np.minimum(code // unit, U((1 << TOTAL_BITS) - 1)).astype(np.int32)
        edges = model.from_.astype(np.int32)
        context = model.context.astype(np.intp)
        outcome = (value >= edges[1:].take(context, mode="clip")).view(np.uint8)
        outcome += value >= edges[2:].take(context, mode="clip")
        outcome += value >= edges[3:].take(context, mode="clip")
        context += outcome
        short = value - edges.take(context, mode="clip")
        short //= model.part.astype(np.int32).take(context, mode="clip")
        short = np.where(outcome == 2, model.by_slot.take(short, mode="clip"), short)
        np.copyto(short, model.guess1, where=outcome == 1)
        np.copyto(short, model.guess2, where=outcome == 0)
        s = short.astype(np.intp)
        start, span = model.interval(s, outcome, unit)
        code -= start
        todo = np.flatnonzero(span < LEAST)
        while len(todo):
            place = at[todo]
            code[todo] = code[todo] << WORD | words.take(place, mode="clip")
            at[todo] = place + 1
            b = span[todo] << WORD
            span[todo] = b
            todo = todo[b < LEAST]
        out[t] = short
        model.learn(s, short, short == model.guess2, short == model.guess1)
    ids = out.T.ravel()[:n].astype(np.int64)
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise Damaged("ids differ from those written")
    return ids
