"""The nearest of a block of tag lists to each of many, by sums of incidence columns."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = "part int, block binary"
NEAREST = "members array<int>, near array<int>, shared array<int>, longer array<int>, mine array<long>, theirs array<long>"
_LISTS = {"near": np.int32, "shared": np.int32, "longer": np.int32, "mine": np.int64, "theirs": np.int64}
#: A tag of more than a 100th of a block's lists is held as a column of ones and zeros, the most frequent first, while the columns stay within COLUMNS bytes.
DENSE, COLUMNS = 100, 150_000_000
#: Lists whose results are returned together, and how many arrays of thresholds are remembered.
TOGETHER, REMEMBERED = 2_000, 64
#: A mask has a bit for each of so many tags of a list.
MASKED = 63


def _lists(codes: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The lengths of lists, and their values one after another."""
    return np.diff(codes.offsets.to_numpy()), codes.flatten().to_numpy(zero_copy_only=False)


def packed_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, number, codes) of one part to one row with all of them, by length and number."""
    rows = pa.Table.from_batches(held).combine_chunks() if (held := [b for b in batches if b.num_rows]) else None
    if rows is None:
        return
    numbers, lengths = rows.column(1).to_numpy(), np.diff(rows.column(2).combine_chunks().offsets.to_numpy())
    rows = rows.take(pa.array(np.lexsort((numbers, lengths))))
    lengths, flat = _lists(rows.column(2).combine_chunks())
    tags, codes = np.unique(flat, return_inverse=True)
    np.savez_compressed(out := io.BytesIO(), tags=tags, codes=codes.astype(np.int32), lengths=lengths, numbers=rows.column(1).to_numpy())
    yield pa.RecordBatch.from_arrays([pa.array([rows.column(0)[0].as_py()], pa.int32()), pa.array([out.getvalue()], pa.binary())], names=["part", "block"])


def _places(mask: np.ndarray) -> np.ndarray:
    """np.flatnonzero(), eight at once, as few are true."""
    whole = len(mask) // 8 * 8
    at = np.flatnonzero(mask[:whole].view(np.uint64) != 0)
    k = np.flatnonzero(mask[:whole].reshape(-1, 8)[at])
    return np.concatenate([8 * at[k // 8] + k % 8, np.flatnonzero(mask[whole:]) + whole])


class Block:
    """Lists of tags, of which nearest() finds the `most` that share the greatest part of the longer list with another, by least numbers."""

    def __init__(self, packed: bytes, least: int, most: int):
        held = np.load(io.BytesIO(packed))
        self.least, self.most = least, most
        self.tags, self.codes, self.lengths, self.numbers = (held[k] for k in ("tags", "codes", "lengths", "numbers"))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        n = len(self.lengths)
        counts = np.bincount(self.codes, minlength=len(self.tags))
        self.rows = np.repeat(np.arange(n, dtype=np.intp), self.lengths)[np.argsort(self.codes, kind="stable")]
        self.at = np.concatenate([[0], np.cumsum(counts)])
        self.sums = np.zeros(n, dtype=np.uint8 if self.lengths[-1] < 255 else np.uint32)
        self.never = np.iinfo(self.sums.dtype).max
        self.columns = {}
        frequent = np.argsort(-counts, kind="stable")[: COLUMNS // self.sums.nbytes]
        for c in frequent[counts[frequent] * DENSE > n].tolist():
            self.columns[c] = np.zeros(n, dtype=self.sums.dtype)
            self.columns[c][self.rows[self.at[c] : self.at[c + 1]]] = 1
        self.widths, first = np.unique(self.lengths, return_index=True)
        self.bounds = np.append(first, n)
        self.levels: dict[int, list[tuple[int, int]]] = {}
        self.known: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        self.guesses: dict[int, int] = {}

    def _levels(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The weights that a list of this length can have, greatest first, and a numerator and denominator of each."""
        if length not in self.levels:
            pairs = {o / max(length, m): (o, max(length, m)) for m in self.widths.tolist() for o in range(min(length, m), self.least - 1, -1)}
            weights = sorted(pairs, reverse=True)
            self.levels[length] = np.array(weights), *np.array([pairs[w] for w in weights], dtype=np.int64).reshape(-1, 2).T
        return self.levels[length]

    def _thresholds(self, length: int, level: int) -> tuple[int, np.ndarray]:
        """How many tags each of the block's lists must share to reach the level; given from the first list on that can, to the last."""
        if (length, level) not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            _, above, below = self._levels(length)
            needed = np.maximum(self.least, -(-above[level] * np.maximum(length, self.widths) // below[level]))
            able = needed <= np.minimum(length, self.widths)
            a, b = np.flatnonzero(able)[[0, -1]]
            needed = np.where(able, needed, self.never)[a : b + 1]
            self.known[length, level] = int(self.bounds[a]), np.repeat(needed.astype(self.sums.dtype), np.diff(self.bounds[a : b + 2]))
        return self.known[length, level]

    def nearest(self, codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Of a list of so many tags, of which codes are those that the block has: places of the nearest lists, and how many tags each shares."""
        weights = self._levels(length)[0]
        if len(codes) < self.least or not len(weights):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        sums = self.sums
        sums.fill(0)
        for c in codes.tolist():
            column = self.columns.get(c)
            if column is not None:
                np.add(sums, column, out=sums)
            else:
                sums[self.rows[self.at[c] : self.at[c + 1]]] += 1
        last, step = len(weights) - 1, 1
        level = min(self.guesses.get(length, 0), last)
        while True:
            first, needed = self._thresholds(length, level)
            reach = sums[first : first + len(needed)] >= needed
            if level == last or np.count_nonzero(reach) >= self.most:
                break
            level, step = min(last, level + step), 2 * step
        found = _places(reach) + first
        shared = sums[found].astype(np.int64)
        if len(found) > self.most:
            weight = shared / np.maximum(length, self.lengths[found])
            cut = -np.partition(-weight, self.most - 1)[self.most - 1]
            above, tied = np.flatnonzero(weight > cut), np.flatnonzero(weight == cut)
            wanted = self.most - len(above)
            kept = np.concatenate([above, tied[np.argpartition(self.numbers[found[tied]], wanted - 1)[:wanted]]])
            found, shared = found[kept], shared[kept]
            level = int(np.searchsorted(-weights, -cut))
        self.guesses[length] = level
        return found, shared

    def of(self, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """How many are nearest to each of the lists that lie in flat, and what NEAREST says of these, the nearest first."""
        at = np.minimum(np.searchsorted(self.tags, flat), len(self.tags) - 1)
        codes = np.where(self.tags[at] == flat, at, -1)
        ends = np.cumsum(lengths)
        each: list = [None] * len(lengths)
        for k in np.argsort(lengths, kind="stable").tolist():  # those of one length have thresholds in common
            own = codes[ends[k] - lengths[k] : ends[k]]
            each[k] = self.nearest(own[own >= 0], int(lengths[k]))
        sizes = np.array([len(x) for x, _ in each], dtype=np.int64)
        query, place, shared = np.repeat(np.arange(len(each)), sizes), *(np.concatenate(x) if each else np.empty(0, dtype=np.int64) for x in zip(*each))
        longer = np.maximum(lengths[query], self.lengths[place])
        order = np.lexsort((self.numbers[place], -(shared / longer), query))
        query, place, shared, longer = query[order], place[order], shared[order], longer[order]
        # what each pair shares, by places in either list
        key = np.repeat(np.arange(len(lengths)), lengths) * len(self.tags) + codes
        here = np.arange(len(flat)) - np.repeat(ends - lengths, lengths)
        known = codes >= 0
        key, here = key[known], here[known]
        key, here = key[by := np.argsort(key)], here[by]
        n = self.lengths[place]
        pair = np.repeat(np.arange(len(place)), n)
        there = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        sought = query[pair] * len(self.tags) + self.codes[self.starts[place][pair] + there]
        hit = np.minimum(np.searchsorted(key, sought), max(0, len(key) - 1))
        both = key[hit] == sought if len(key) else np.zeros(0, dtype=bool)
        masks = []
        for bit in (here[hit] if len(key) else there, there):
            mask = np.zeros(len(place), dtype=np.int64)
            np.bitwise_or.at(mask, pair[both], np.left_shift(1, np.minimum(bit[both], MASKED - 1), dtype=np.int64))
            masks.append(mask)
        return sizes, {"near": self.numbers[place], "shared": shared, "longer": longer, "mine": masks[0], "theirs": masks[1]}


def nearest_lists(least: int, most: int):
    """Rows (part, block, codes, members) of one part, one of which holds a packed_block() and the others codes and members, to NEAREST.

    near are the numbers of the `most` lists of the block that are nearest to codes. mine and theirs have a bit for each tag that is
    shared, by its place in codes and in the other list; they mean nothing of lists of more than MASKED tags.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []
        for batch in batches:
            packed = batch.column(1)
            if packed.null_count < len(packed):
                block = Block(packed.drop_null()[0].as_py(), least, most)
            held.append(pa.RecordBatch.from_arrays(batch.filter(packed.is_null()).columns[2:], names=["codes", "members"]))
        if block is None:
            return
        for rows in held:
            for first in range(0, rows.num_rows, TOGETHER):
                some = pa.table(rows.slice(first, TOGETHER).to_pydict(), schema=rows.schema)
                lengths, flat = _lists(some.column(0).combine_chunks())
                sizes, found = block.of(flat, lengths)
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(found[k].astype(kind))) for k, kind in _LISTS.items()]
                yield pa.RecordBatch.from_arrays([some.column(1).combine_chunks(), *lists], names=["members", *_LISTS])

    return run
