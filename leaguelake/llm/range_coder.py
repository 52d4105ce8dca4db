"""An adaptive context-mixing range coder for token ids, in blocks that stand alone.

Three models predict the next id from what a block has shown so far: order 2 names the id that last followed
the two previous ids, order 1 the id that last followed the previous one, order 0 gives every id seen its
frequency. An id not seen yet is written plainly. The mix says how much of the probability each of them
gets: it is learned, separately for every combination of how often in a row the named ids came true and whether the
two names agree, from how often each was right. One range coder step writes which model was right, a
second one the id, if it takes more than that.

What is learned is taken over at fixed places: the mix every BEAT ids, the frequencies whenever the ids seen
have doubled. A block begins with nothing learned, so each can be read without any other. All blocks of a
call are worked on side by side, one id of each at a time, as arrays without a branch by block. A writer knows all ids:
step by step it only learns and narrows ranges; contexts, cells and ranges are worked out for a whole beat.

A packed stretch is: MAGIC, format, ids of a block, number of ids, number of blocks; then for each block its
bytes and the CRC-32 of its ids as little-endian unsigned 32-bit integers; then the blocks. All numbers are little-endian.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"CMRC"
FORMAT = 2
#: Ids of a block. Blocks are reset, so larger ones are smaller in total, and fewer are worked on at a time.
BLOCK_IDS = 4096
#: Ids after which the mix is taken over.
BEAT = 128
#: Ids after which order 0 is first used.
FIRST_IDS = 64
MAX_ID = (1 << 28) - 1

_HEAD = struct.Struct("<4sBxxxIQI")
_SLOT_BITS = 11
_CELLS = 32
_ORDER2, _ORDER1, _ORDER0, _NEW = range(4)
#: What is assumed before anything was seen: all four outcomes alike, weighing as much as two ids.
_PRIOR = 0.5
_LEAST = 24


class CorruptBlock(ValueError):
    """A block does not give the ids whose checksum is stored with it."""


class _Mix:
    """The models' state for many blocks ("lanes") at once."""

    def __init__(self, lanes: int) -> None:
        # Two tables a lane, of order 1 and of order 2. An entry is the id last seen in its context, times four, plus
        # how often in a row it came true (up to 3).
        self.base = np.arange(2 * lanes, dtype=np.int64).reshape(lanes, 2).T << _SLOT_BITS
        self.table = np.zeros(2 * lanes << _SLOT_BITS, np.uint32)
        self.cell_base = np.arange(lanes, dtype=np.int64) * _CELLS
        self.counts = np.full((lanes * _CELLS, 4), _PRIOR, np.float32)
        self.met = np.zeros(self.counts.size, np.int64)
        self._take_over()

    def _take_over(self) -> None:
        counts = self.counts
        scale = (65536 - 4 * _LEAST) / counts.sum(axis=1)
        parts = (counts[:, :3] * scale[:, None]).astype(np.uint32)
        parts += _LEAST
        ends = np.zeros((len(counts), 5), np.int64)
        np.cumsum(parts, axis=1, out=ends[:, 1:4])
        ends[:, 4] = 65536
        self.ends = ends.reshape(-1)

    def places(self, before: np.ndarray, before2: np.ndarray) -> np.ndarray:
        """The entries for what followed `before` and, behind it, what followed `before2` and `before`, by lane."""
        found = np.empty((*before.shape[:-1], 2, before.shape[-1]), np.int64)
        mixed = before * np.uint32(0x9E3779B1)
        found[..., 0, :] = mixed >> np.uint32(32 - _SLOT_BITS)
        mixed += before2
        mixed *= np.uint32(0x85EBCA6B)
        found[..., 1, :] = mixed >> np.uint32(32 - _SLOT_BITS)
        found += self.base[:, : before.shape[-1]]
        return found

    def cells(self, entries: np.ndarray, named: np.ndarray) -> np.ndarray:
        """The cell of the mix, counted through over all lanes."""
        cell = (named[..., 0, :] == named[..., 1, :]) * 16 + self.cell_base[: named.shape[-1]]
        cell += entries[..., 0, :] & np.uint32(3)
        cell += (entries[..., 1, :] & np.uint32(3)) << np.uint32(2)
        return cell

    def learn(self, at: np.ndarray, entries: np.ndarray, named: np.ndarray, ids: np.ndarray) -> None:
        again = entries + np.uint32(1)
        np.minimum(again, entries | np.uint32(3), out=again)
        self.table[at] = np.where(named == ids, again, ids << np.uint32(2))

    def count(self, cells: np.ndarray, outcome: np.ndarray, done: int) -> None:
        """Counts what came true up to `done` ids of each lane; the mix is taken over every BEAT."""
        self.met += np.bincount((cells * 4 + outcome).reshape(-1), minlength=self.met.size)
        if done % BEAT == 0:
            self.counts += self.met.reshape(self.counts.shape)
            self.met[:] = 0
            self._take_over()


class _Seen:
    """Order 0: the sorted ids that a lane has shown, each as often as it came."""

    def __init__(self, ids: np.ndarray) -> None:
        lanes, self.n = ids.shape
        self.ordered = np.sort(ids, axis=1, kind="stable")
        place = np.arange(self.n, dtype=np.int32)
        opens = np.ones((lanes, self.n), bool)
        np.not_equal(self.ordered[:, 1:], self.ordered[:, :-1], out=opens[:, 1:])
        self.opens = opens
        self.first = np.maximum.accumulate(np.where(opens, place, 0), axis=1)
        closes = np.ones((lanes, self.n), bool)
        closes[:, :-1] = opens[:, 1:]
        last = np.minimum.accumulate(np.where(closes, place, self.n)[:, ::-1], axis=1)[:, ::-1]
        self.times = last + 1 - self.first

    def find(self, ids: np.ndarray, at_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each id of each lane: where it begins, and how often it was seen (0: never).

        at_of is a work area of an entry for each id there may be; what it held before does not matter.
        """
        first = np.empty(ids.shape, np.int32)
        times = np.empty(ids.shape, np.int32)
        for i in range(len(ids)):
            ordered, places = self.ordered[i], np.flatnonzero(self.opens[i])
            at_of[ordered[places]] = places
            at = at_of[ids[i]]
            np.minimum(at, self.n - 1, out=at)
            first[i] = at
            np.multiply(self.times[i, at], ordered[at] == ids[i], out=times[i])
        return first, times

    def packed(self) -> np.ndarray:
        """By place: the id, where it begins and how often it came, in one number."""
        return self.ordered.astype(np.int64) | (self.first.astype(np.int64) << 28) | (self.times.astype(np.int64) << 46)


def _chunks(length: int) -> list[tuple[int, int]]:
    """Stretches of a block between which order 0 is taken anew."""
    edges = [0, FIRST_IDS]
    while edges[-1] < length:
        edges.append(2 * edges[-1])
    return [(a, min(b, length)) for a, b in zip(edges, edges[1:], strict=False) if a < length]


class _Writer:
    """Ranges of many lanes; the words that leave them are kept row by row and put together at the end."""

    def __init__(self, lanes: int) -> None:
        self.low, self.range = np.zeros(lanes, np.int64), np.full(lanes, 1 << 48, np.int64)
        self.rows: list[np.ndarray] = []
        self.left: list[np.ndarray] = []

    def settle(self, m: int) -> None:
        """Words leave the first m lanes until all their ranges are wide enough."""
        low, span = self.low[:m], self.range[:m]
        small = span < 1 << 32
        while small.any():
            word = low >> 32
            word *= small
            low -= word << 32
            shift = small * np.int64(16)
            low <<= shift
            span <<= shift
            self.rows.append(word.astype(np.int32))
            self.left.append(small)
            small = span < 1 << 32

    def step(self, m: int, bits, start: np.ndarray, size) -> None:
        """Narrows the first m lanes to `size` parts from `start` of 2 ** bits."""
        low, span = self.low[:m], self.range[:m]
        span >>= bits
        low += span * start
        span *= size

    def finish(self) -> list[bytes]:
        lanes = len(self.low)
        for shift in (32, 16, 0):
            self.rows.append(((self.low >> shift) & (0xFFFF if shift < 32 else 0x1FFFF)).astype(np.int32))
            self.left.append(np.ones(lanes, bool))
        found = []
        for a in range(0, lanes, 128):
            b = min(a + 128, lanes)
            some = [i for i, r in enumerate(self.rows) if len(r) > a]
            words = np.zeros((b - a, len(some)), np.int32)
            left = np.zeros((b - a, len(some)), bool)
            for column, i in enumerate(some):
                n = min(len(self.rows[i]), b) - a
                words[:n, column], left[:n, column] = self.rows[i][a : a + n], self.left[i][a : a + n]
            used = left.sum(axis=1)
            flat, edges = words[left], np.cumsum(used)
            # A word that overflowed carries into the one before it; a block's first word has none before it.
            while (carry := flat >> 16).any():
                flat &= 0xFFFF
                flat[:-1] += carry[1:]
            raw = flat.astype("<u2").tobytes()
            found += [raw[2 * (e - n) : 2 * e] for e, n in zip(edges.tolist(), used.tolist(), strict=True)]
        return found


class _Reader:
    def __init__(self, blocks: list[bytes]) -> None:
        lanes = len(blocks)
        # A damaged block may ask for more than there is; it reads on in the words behind it.
        sizes = np.array([len(b) // 2 for b in blocks], np.int64)
        self.words = np.zeros(int(sizes.sum()) + 4, np.int64)
        self.words[:-4] = np.frombuffer(b"".join(b[: 2 * (len(b) // 2)] for b in blocks), "<u2")
        self.at = np.cumsum(sizes) - sizes
        self.range = np.full(lanes, 1 << 48, np.int64)
        self.code = np.zeros(lanes, np.int64)
        for _ in range(3):
            self.code = (self.code << 16) | self.words.take(self.at, mode="clip")
            self.at += 1

    def settle(self, m: int) -> None:
        code, span, at = self.code[:m], self.range[:m], self.at[:m]
        small = span < 1 << 32
        while small.any():  # twice at most: a range is never empty
            shift = small * np.int64(16)
            code <<= shift
            span <<= shift
            code += self.words.take(at, mode="clip") * small
            at += small
            small = span < 1 << 32

    def value(self, m: int, bits) -> np.ndarray:
        """Which of 2 ** bits parts the first m lanes lie in; the quotient is exact, as both numbers have 48 bits."""
        span = self.range[:m]
        span >>= bits
        return (self.code[:m] / span).astype(np.int64)

    def step(self, m: int, start: np.ndarray, size) -> None:
        code, span = self.code[:m], self.range[:m]
        code -= span * start
        span *= size


def _lane_lengths(total: int, block: int) -> np.ndarray:
    lengths = np.full(-(-total // block), block, np.int64)
    if len(lengths):
        lengths[-1] = total - block * (len(lengths) - 1)
    return lengths


def _segments(begin: int, end: int, shortest: int) -> list[tuple[int, int]]:
    """Stretches of a chunk between which neither the mix nor the number of lanes changes."""
    edges = sorted({begin, end, *range(begin + BEAT - begin % BEAT, end, BEAT), *([shortest] if begin < shortest < end else [])})
    return list(zip(edges, edges[1:], strict=False))


def _encode_blocks(ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    lanes, longest = len(lengths), int(lengths[0])
    grid = np.zeros((lanes, longest), ids.dtype)
    grid.reshape(-1)[: len(ids)] = ids
    wide = grid.itemsize > 2
    # Ids too many for a table of their own are looked up by rank, which orders them alike.
    ranks = grid if not wide else np.unique(grid, return_inverse=True)[1].reshape(grid.shape).astype(np.uint32)
    at_of = np.zeros(int(ranks.max()) + 1, np.int64)
    mix, out = _Mix(lanes), _Writer(lanes)
    for begin, end in _chunks(longest):
        part = grid[:, begin:end]
        first = times = np.zeros(part.shape, np.int32)
        if begin:
            first, times = _Seen(ranks[:, :begin]).find(ranks[:, begin:end], at_of)
        # Two ids before the chunk come first.
        columns = np.zeros((end - begin + 2, lanes), np.uint32)
        columns[2:] = part.T
        if begin:
            columns[:2] = grid[:, begin - 2 : begin].T
        first, times = np.ascontiguousarray(first.T), np.ascontiguousarray(times.T)
        bits = begin.bit_length() - 1
        for a, b in _segments(begin, end, int(lengths[-1])):
            m = lanes if a < lengths[-1] else lanes - 1
            i, j = a - begin, b - begin
            now, often = columns[i + 2 : j + 2, :m], times[i:j, :m]
            at = mix.places(columns[i + 1 : j + 1, :m], columns[i:j, :m])
            entries = np.empty(at.shape, np.uint32)
            for t in range(j - i):
                entry = mix.table.take(at[t], out=entries[t], mode="clip")
                mix.learn(at[t], entry, entry >> np.uint32(2), now[t])
            named = entries >> np.uint32(2)
            cells = mix.cells(entries, named)
            outcome = np.where(often > 0, _ORDER0, _NEW)
            outcome[now == named[:, 0]] = _ORDER1
            outcome[now == named[:, 1]] = _ORDER2
            row = cells * 5 + outcome
            start = mix.ends.take(row)
            size = mix.ends.take(row + 1) - start
            # The second step names the id if the first did not.
            old, new = outcome == _ORDER0, outcome == _NEW
            bits2 = old * np.int64(bits) + new * np.int64(16)
            start2 = np.where(old, first[i:j, :m], np.where(new, now & np.uint32(0xFFFF), 0)).astype(np.int64)
            size2 = np.where(old, often, 1).astype(np.int64)
            high = np.where(new, now >> np.uint32(16), 0).astype(np.int64) if wide else None
            for t in range(j - i):
                out.step(m, 16, start[t], size[t])
                out.step(m, bits2[t], start2[t], size2[t])
                out.settle(m)
                if high is not None:
                    out.step(m, new[t] * np.int64(16), high[t], 1)
                    out.settle(m)
            mix.count(cells, outcome, b)
    return out.finish()


def _decode_blocks(blocks: list[bytes], lengths: np.ndarray, wide: bool) -> np.ndarray:
    lanes, longest = len(lengths), int(lengths[0])
    grid = np.zeros((lanes, longest), np.uint32 if wide else np.uint16)
    mix, source = _Mix(lanes), _Reader(blocks)
    before = before2 = np.zeros(lanes, np.uint32)
    for begin, end in _chunks(longest):
        seen = _Seen(grid[:, :begin]).packed().reshape(-1) if begin else np.zeros(1, np.int64)
        seen_base = np.arange(lanes, dtype=np.int64) * begin
        bits2 = np.array([0, 0, max(begin.bit_length() - 1, 0), 16])
        most2 = (1 << bits2) - 1
        columns = np.zeros((end - begin, lanes), grid.dtype)
        for a, b in _segments(begin, end, int(lengths[-1])):
            m = lanes if a < lengths[-1] else lanes - 1
            before, before2 = before[:m], before2[:m]
            cells, outcomes = np.empty((b - a, m), np.int64), np.empty((b - a, m), np.int64)
            ends1, ends2, ends3 = (mix.ends[k:] for k in (1, 2, 3))
            for t in range(b - a):
                at = mix.places(before, before2)
                entries = mix.table.take(at, mode="clip")
                named = entries >> np.uint32(2)
                cells[t] = mix.cells(entries, named)
                row = cells[t] * 5
                value = np.minimum(source.value(m, 16), 65535)
                outcome = np.add(value >= ends1.take(row, mode="clip"), value >= ends2.take(row, mode="clip"), dtype=np.int64)
                outcome += value >= ends3.take(row, mode="clip")
                outcomes[t] = outcome
                row += outcome
                start = mix.ends.take(row, mode="clip")
                source.step(m, start, ends1.take(row, mode="clip") - start)
                value = np.minimum(source.value(m, bits2.take(outcome)), most2.take(outcome))
                old, new = outcome == _ORDER0, outcome == _NEW
                found = seen.take(seen_base[:m] + value, mode="clip")
                times = found >> 46
                start = np.where(old, (found >> 28) & 0x3FFFF, value * new)
                source.step(m, start, np.where(old, np.maximum(times, 1), 1))
                source.settle(m)
                now = np.where(outcome == _ORDER2, named[1], named[0])
                np.copyto(now, found & MAX_ID, where=old, casting="unsafe")
                np.copyto(now, value, where=new, casting="unsafe")
                if wide:
                    value = np.minimum(source.value(m, new * np.int64(16)), 0xFFFF) * new
                    source.step(m, value, 1)
                    source.settle(m)
                    now |= (value << 16).astype(np.uint32)
                    now &= np.uint32(MAX_ID)  # a damaged block may give more
                columns[a - begin + t, :m] = now
                mix.learn(at, entries, named, now)
                before2, before = before, now
            mix.count(cells, outcomes, b)
        grid[:, begin:end] = columns.T
    return grid.reshape(-1)[: int(lengths.sum())]


def _checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def pack(ids: np.ndarray, block: int = BLOCK_IDS) -> bytes:
    """ids, of 0 to MAX_ID, as one packed stretch."""
    if len(ids) and int(ids.max()) > MAX_ID:
        raise ValueError(f"ids may not exceed {MAX_ID}")
    narrow = not len(ids) or int(ids.max()) < 1 << 16
    ids = np.asarray(ids).astype(np.uint16 if narrow else np.uint32)
    lengths = _lane_lengths(len(ids), block)
    packed = _encode_blocks(ids, lengths) if len(ids) else []
    starts = np.arange(len(lengths)) * block
    sums = [_checksum(ids[a : a + n]) for a, n in zip(starts, lengths, strict=True)]
    table = np.array([[len(b) for b in packed], sums], "<u4").T.tobytes()
    head = _HEAD.pack(MAGIC, FORMAT if narrow else FORMAT | 0x80, block, len(ids), len(packed))
    return b"".join([head, table, *packed])


def unpack(data: bytes) -> np.ndarray:
    """The ids of a packed stretch; raises CorruptBlock if a block is damaged."""
    if len(data) < _HEAD.size or data[:4] != MAGIC:
        raise CorruptBlock("not a packed stretch of ids")
    _, form, block, total, count = _HEAD.unpack_from(data)
    lengths = _lane_lengths(total, block)
    table = np.frombuffer(data, "<u4", 2 * count, _HEAD.size).reshape(count, 2)
    edges = _HEAD.size + table.nbytes + np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])
    if form & 0x7F != FORMAT or len(lengths) != count or edges[-1] != len(data):
        raise CorruptBlock("the head does not fit the data")
    if not count:
        return np.empty(0, np.uint32)
    blocks = [data[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    ids = _decode_blocks(blocks, lengths, bool(form & 0x80))
    for i, a in enumerate(np.arange(count) * block):
        if _checksum(ids[a : a + lengths[i]]) != table[i, 1]:
            raise CorruptBlock(f"block {i} does not give the ids it was made of")
    return ids.astype(np.uint32)
