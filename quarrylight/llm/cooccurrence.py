"""Items that occur together more often than chance: a blocked Gram matrix of the baskets' sparse item blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrylight.storage import materialize

#: Items a side of a block of the matrix, pairs expanded at once, and cells other than 0 a task holds before it hands them on.
SIDE, AT_ONCE, HELD = 512, 2_000_000, 4_000_000
#: Items that may be broadcast with their numbers; more are joined by a shuffle.
BROADCAST_ITEMS = 500_000


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """grp, items (sorted distinct numbers) to grp, i, j, n: baskets of these batches that hold both i < j.

    A block of records is one sparse item block a side: of X'X only the cells above the diagonal that aren't 0 are
    formed, and the blocks' sums are held by block of the matrix in that form, HELD cells at most and one step more.
    """
    blocks: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
    held = 0

    def added(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        return codes[starts], np.add.reduceat(counts, starts)

    def summed() -> None:
        nonlocal held
        for key, parts in blocks.items():
            if len(parts) > 1:
                blocks[key] = [added(*(np.concatenate(x) for x in zip(*parts)))]
        held = sum(len(parts[0][0]) for parts in blocks.values())

    def drained() -> Iterator[pa.RecordBatch]:
        nonlocal held
        summed()
        for (grp, _), ((codes, counts),) in blocks.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), grp, dtype=np.int32)), pa.array((codes >> 32).astype(np.int32)), pa.array((codes & 0xFFFFFFFF).astype(np.int32)), pa.array(counts)], names=["grp", "i", "j", "n"])
        blocks.clear()
        held = 0

    def expand(grp: int, items: np.ndarray, first: int, last: int, rest: np.ndarray) -> None:
        """Adds the pairs that the items from first to last begin: each meets those that follow it in its basket."""
        nonlocal held
        after = rest[first:last]
        i = np.repeat(np.arange(first, last), after)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)
        codes, n = np.unique((items[i].astype(np.int64) << 32) | items[j].astype(np.int64), return_counts=True)
        band = (codes >> 32) // SIDE  # rows of blocks; the codes are sorted, so each is one run
        cuts = np.flatnonzero(np.diff(band)) + 1
        for part, counts in zip(np.split(codes, cuts), np.split(n, cuts)):
            if len(part):
                blocks.setdefault((grp, int(part[0] >> 32) // SIDE), []).append((part, counts))
                held += len(part)

    for batch in batches:
        lists = batch.column(1)
        offsets, flat, grps = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False), batch.column(0).to_numpy(zero_copy_only=False)
        lengths = np.diff(offsets)
        for grp in np.unique(grps):
            own = np.flatnonzero((grps == grp) & (lengths > 1))
            items = np.concatenate([flat[offsets[k] : offsets[k + 1]] for k in own] or [flat[:0]])
            ends = np.repeat(np.cumsum(lengths[own]), lengths[own])
            rest = ends - np.arange(len(items)) - 1
            step = np.cumsum(rest) // AT_ONCE  # a wide basket is cut too, between items
            at = np.concatenate([[0], np.flatnonzero(np.diff(step)) + 1, [len(items)]])
            for first, last in zip(at[:-1], at[1:]):
                if last > first:
                    expand(int(grp), items, int(first), int(last), rest)
                if held > HELD:
                    summed()
                    if held > HELD // 2:
                        yield from drained()
    yield from drained()


def together(baskets: DataFrame, least: int = 5, share: int = 500, lift: int = 3) -> DataFrame:
    """grp, item_a < item_b, n_ab, n_a, n_b and records of the pairs with n_ab >= least, share * n_ab >= N and n_ab * N >= lift * n_a * n_b.

    baskets: grp int, key, items array<string>; N counts the keys of a grp with at least one item, n_a those that hold
    a, n_ab those that hold both. Null keys, null lists and null items don't count; repeats of an item in a key, in one
    row or several, count once. No baskets, no rows.

    Only an item of at least max(least, N / share) records can be in such a pair. There are at most share times the mean
    basket size of them, however many records there are; up to BROADCAST_ITEMS are broadcast, more are joined. Runs jobs
    and writes to the shared folder when called.
    """
    pairs = baskets.where(F.col("key").isNotNull()).select("grp", "key", F.explode("items").alias("item")).where(F.col("item").isNotNull())
    single = pairs.distinct()
    counted = materialize(single.groupBy("grp", "item").agg(F.count("*").alias("n")), "items")
    totals = materialize(pairs.groupBy("grp").agg(F.count_distinct("key").alias("records")), "totals")  # one row a grp
    often = counted.join(F.broadcast(totals), "grp").where(F.col("n") >= least).where(F.col("n") * share >= F.col("records"))
    ranked = often.select("grp", "item", F.row_number().over(Window.partitionBy("grp").orderBy("item")).alias("at"))
    known = materialize(ranked.withColumn("at", F.col("at") - 1), "known")
    small = known.count() <= BROADCAST_ITEMS
    sent = F.broadcast if small else lambda df: df
    coded = pairs.join(sent(known), ["grp", "item"]).groupBy("grp", "key").agg(F.array_sort(F.collect_set("at")).alias("items"))
    gram = coded.where(F.size("items") > 1).select("grp", "items").mapInArrow(_gram, "grp int, i int, j int, n long")
    sums = gram.groupBy("grp", "i", "j").agg(F.sum("n").alias("n_ab"))
    items = often.join(known, ["grp", "item"]).select("grp", "item", "n", "at", "records")
    one = items.select("grp", F.col("at").alias("i"), F.col("item").alias("item_a"), F.col("n").alias("n_a"), "records")
    two = items.select("grp", F.col("at").alias("j"), F.col("item").alias("item_b"), F.col("n").alias("n_b"))
    both = sums.join(sent(one), ["grp", "i"]).join(sent(two), ["grp", "j"])
    both = both.where((F.col("n_ab") >= least) & (F.col("n_ab") * share >= F.col("records")))
    both = both.where(F.col("n_ab").cast("decimal(38,0)") * F.col("records") >= F.col("n_a").cast("decimal(38,0)") * F.col("n_b") * lift)
    return both.select("grp", "item_a", "item_b", "n_ab", "n_a", "n_b", "records")
