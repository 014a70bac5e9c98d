"""An adaptive context-mixing range coder for blocks of token ids.

Every block starts from an empty model. For each id the model has up to three
predictions: order 2 (what followed the last two ids), order 1 (what followed
the last id) and order 0 (the id that leads a running vote). Those that have
come true before are offered in that order, each as one coded bit, hit or miss,
and an id that none predicts stands in full, in 16 or 32 bits, among the block's
other such ids. The probability of a hit is mixed from two adaptive estimates,
one by the prediction's own record and one by the order's last three outcomes;
the weight moves to the estimate that was nearer. Everything is integer
arithmetic, so a block decodes alike anywhere.

The coder moves out 16 bits at a time, once at most for a bit; carries are kept
with the words that were moved out and added at the end.

Many blocks are coded in step, one array element each."""

from __future__ import annotations

import zlib

import numpy as np

#: Ids of a block; a multiple of blocks makes up a segment.
BLOCK = 512
_SLOTS = 256
_BOT, _LOW, _ALL = 1 << 16, (1 << 16) - 1, (1 << 32) - 1
_RATE, _LEAST = 4, 64  # of the adaptive estimates (12 bits)
_ONE, _TWO = 40503, 60493


class _Model:
    def __init__(self, lanes: int, kind: type):
        # order 1 and order 2: prediction * 4 + how often it came true in a row (3 at most)
        self.table = np.full((2, lanes * _SLOTS), -4, kind)
        self.vote = np.full(lanes, -1, kind)
        self.votes = np.zeros(lanes, np.int8)
        # estimates by order, for each lane 4 by record and 8 by the last outcomes
        self.estimates = np.full((3, lanes * 12), 1 << 11, np.int32)
        self.past = np.zeros((3, lanes), np.int32)
        self.weight = np.full((3, lanes), 128, np.int32)
        self.last = np.ones((2, lanes), np.int64)  # the last two ids, plus one
        self.first = np.arange(lanes) * _SLOTS

    def look(self, n: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By order: the lanes among the first n whose prediction of the next id
        is offered, what it is, and its record."""
        near = self.last[0, :n] * _ONE
        both = near + self.last[1, :n] * _TWO
        self.at = [self.first[:n] + (x >> 8 & (_SLOTS - 1)) for x in (near, both)]
        self.entries = [table.take(at) for table, at in zip(self.table, self.at)]
        # only one that has come true before, and no earlier one has made and missed
        who = np.flatnonzero((((self.entries[0] | self.entries[1]) & 3) > 0) | (self.votes[:n] > 1))
        one, two = (e.take(who) for e in self.entries)
        vote, votes = self.vote.take(who), self.votes.take(who)
        record1, record2 = one & 3, two & 3
        one, two = one >> 2, two >> 2
        true1, true2 = record1 > 0, record2 > 0
        fresh1 = true1 & ~(true2 & (one == two))
        fresh0 = (votes > 1) & ~(true2 & (vote == two)) & ~(true1 & (vote == one))
        record0 = np.minimum(votes >> 1, 3)
        offers = (true2, two, record2), (fresh1, one, record1), (fresh0, vote, record0)
        return [(who[fresh], guess[fresh], record[fresh]) for fresh, guess, record in offers]

    def chance(self, order: int, who: np.ndarray, record: np.ndarray) -> np.ndarray:
        """The probability (12 bits) that the lanes' prediction of the order hits."""
        self.late, self.w = self.past[order].take(who), self.weight[order].take(who)
        self.cells = np.stack([record, self.late + 4]) + who * 12
        self.p = self.estimates[order].take(self.cells)
        own, late = self.p
        mixed = (self.w * (own - late) >> 8) + late
        return np.minimum(np.maximum(mixed, _LEAST), 4096 - _LEAST)

    def learn(self, order: int, who: np.ndarray, hit: np.ndarray) -> None:
        off = hit * np.int32(4095) - self.p
        self.estimates[order][self.cells] = self.p + (off >> _RATE)
        own, late = np.abs(off)
        self.weight[order][who] = np.where(own <= late, self.w + ((256 - self.w) >> 4), self.w - (self.w >> 4))
        self.past[order][who] = (self.late << 1 & 7) | hit

    def update(self, n: int, ids: np.ndarray) -> None:
        """Take in the ids of the first n lanes."""
        new = ids << 2
        for table, at, entry in zip(self.table, self.at, self.entries):
            table[at] = new + np.minimum((entry & 3) + 1, 3) * (entry >> 2 == ids)
        vote, votes = self.vote[:n], self.votes[:n]
        np.copyto(vote, ids, where=votes <= 0)
        votes += 2 * (vote == ids).view(np.int8)
        votes -= 1
        np.minimum(votes, 64, out=votes)
        self.last[1, :n] = self.last[0, :n]
        np.add(ids, 1, out=self.last[0, :n])


class _Writer:
    def __init__(self, lanes: int, own: np.ndarray):
        self.low = np.zeros(lanes, np.int64)
        self.span = np.full(lanes, _ALL, np.int64)
        self.at = np.zeros(lanes, np.int64)
        self.moved: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # lanes, places and words
        self.out = own
        self.kept = np.ones(own.shape, bool)  # ids that stand in full

    def move(self, who: np.ndarray, low: np.ndarray) -> np.ndarray:
        at = self.at[who]
        self.moved.append((who, at, low >> 16))
        self.at[who] = at + 1
        return (low & _LOW) << 16

    def bit(self, who: np.ndarray, p: np.ndarray, guess: np.ndarray, true: np.ndarray) -> np.ndarray:
        hit = guess == true.take(who)
        span, low = self.span.take(who), self.low.take(who)
        bound = (span >> 12) * p
        low += np.where(hit, 0, bound)
        span = np.where(hit, bound, span - bound)
        short = np.flatnonzero(span < _BOT)
        if len(short):
            low[short] = self.move(who[short], low[short])
            span[short] <<= 16
        self.low[who], self.span[who] = low, span
        return hit

    def begin(self, step: int, n: int) -> np.ndarray:
        """The ids of a step, and none of them predicted."""
        self.step = step
        return self.out[step, :n]

    def predicted(self, who: np.ndarray) -> None:
        self.kept[self.step, who] = False

    def words(self) -> np.ndarray:
        """The words of all lanes, one lane after the other."""
        every = np.arange(len(self.at))
        for _ in range(2):
            self.low = self.move(every, self.low)
        starts = np.cumsum(self.at) - self.at
        words = np.zeros(int(self.at.sum()), np.int64)
        for who, at, word in self.moved:
            words[starts[who] + at] = word
        while len(over := np.flatnonzero(words > _LOW)):  # a lane's first word never is
            words[over] &= _LOW
            words[over - 1] += 1
        return words.astype("<u2")


class _Reader:
    def __init__(self, words: np.ndarray, sizes: np.ndarray, plain: np.ndarray, counts: np.ndarray, out: np.ndarray):
        self.data = np.append(words, [0, 0]).astype(np.int64)
        self.at = np.cumsum(sizes) - sizes
        self.code = self.data.take(self.at, mode="clip") << 16 | self.data.take(self.at + 1, mode="clip")
        self.at += 2
        self.span = np.full(len(sizes), _ALL, np.int64)
        self.plain, self.next = np.append(plain, 0).astype(out.dtype), np.cumsum(counts) - counts
        self.out = out

    def bit(self, who: np.ndarray, p: np.ndarray, guess: np.ndarray, true: np.ndarray) -> np.ndarray:
        span, code = self.span.take(who), self.code.take(who)
        bound = (span >> 12) * p
        hit = code < bound
        code -= np.where(hit, 0, bound)
        span = np.where(hit, bound, span - bound)
        short = np.flatnonzero(span < _BOT)
        if len(short):
            few = who[short]
            at = self.at[few]
            code[short] = code[short] << 16 | self.data.take(at, mode="clip")  # a damaged block may run over; its checksum tells
            self.at[few] = at + 1
            span[short] <<= 16
        self.code[who], self.span[who] = code, span
        true[who[hit]] = guess[hit]
        return hit

    def begin(self, step: int, n: int) -> np.ndarray:
        """The ids of a step, if none of them were predicted."""
        now = self.out[step, :n]
        self.plain.take(self.next[:n], out=now, mode="clip")
        self.next[:n] += 1
        return now

    def predicted(self, who: np.ndarray) -> None:
        self.next[who] -= 1


def _run(coder: _Writer | _Reader, total: int) -> None:
    """One pass over all blocks in step: writing the ids of ``coder.out``, or reading them into it."""
    lanes = coder.out.shape[1]
    model = _Model(lanes, coder.out.dtype)
    left = np.ones(lanes, bool)
    last = total - (lanes - 1) * BLOCK
    for step in range(min(BLOCK, total)):
        n = lanes if step < last else lanes - 1
        now = coder.begin(step, n)
        for order, (who, guess, record) in enumerate(model.look(n)):
            if order:
                more = left[who]
                who, guess, record = who[more], guess[more], record[more]
            if len(who):
                hit = coder.bit(who, model.chance(order, who, record), guess, now)
                model.learn(order, who, hit)
                got = who[hit]
                left[got] = False
                coder.predicted(got)
        left[:] = True
        model.update(n, now)


def _kinds(digits: int) -> tuple[type, str]:
    """How ids of so many times 16 bits are held and stored."""
    return (np.int32, "<u2") if digits == 1 else (np.int64, "<u4")


def checksums(ids: np.ndarray) -> np.ndarray:
    """The crc32 of each block."""
    raw = memoryview(ids.astype("<u4").tobytes())
    return np.array([zlib.crc32(raw[i : i + 4 * BLOCK]) for i in range(0, len(raw), 4 * BLOCK)], "<u4")


def encode(ids: np.ndarray) -> bytes:
    """A segment: number of ids, digits of 16 bits of each, number of blocks; of
    each block the checksum, how many words of 16 bits the coder made and how
    many ids stand in full; all words; all ids in full."""
    lanes = -(-len(ids) // BLOCK)
    digits = 1 if not len(ids) or int(ids.max()) < 1 << 16 else 2
    head = np.array([len(ids), digits, lanes], "<u4").tobytes()
    if not lanes:
        return head
    kind, stored = _kinds(digits)
    own = np.zeros(lanes * BLOCK, kind)
    own[: len(ids)] = ids
    own = own.reshape(lanes, BLOCK)
    writer = _Writer(lanes, np.ascontiguousarray(own.T))  # in the order of the steps
    writer.kept[len(ids) - (lanes - 1) * BLOCK :, -1] = False
    _run(writer, len(ids))
    words, kept = writer.words(), writer.kept.T
    parts = [checksums(ids), writer.at.astype("<u2"), kept.sum(1).astype("<u2"), words, own[kept].astype(stored)]
    return head + b"".join(x.tobytes() for x in parts)


def decode(data: bytes) -> np.ndarray:
    """The ids of a segment; a block that does not match its checksum raises."""
    total, digits, lanes = np.frombuffer(data, "<u4", 3).tolist()
    if not lanes:
        return np.empty(0, np.uint32)
    kind, stored = _kinds(digits)
    sums = np.frombuffer(data, "<u4", lanes, 12)
    sizes, counts = np.frombuffer(data, "<u2", 2 * lanes, 12 + 4 * lanes).reshape(2, lanes).astype(np.int64)
    at = 12 + 8 * lanes
    words = np.frombuffer(data, "<u2", int(sizes.sum()), at)
    plain = np.frombuffer(data, stored, int(counts.sum()), at + words.nbytes)
    reader = _Reader(words, sizes, plain, counts, np.zeros((BLOCK, lanes), kind))
    _run(reader, total)
    ids = reader.out.T.ravel()[:total].astype(np.uint32)
    wrong = np.flatnonzero(checksums(ids) != sums)
    if len(wrong):
        raise ValueError(f"block {wrong[0]} does not match its checksum")
    return ids
