"""Set similarity join by chosen paths.

Every record is a set, held as 32 minwise values (its coordinates). A node of a tree holds records; it branches
on a few coordinates chosen by a hash of the node, none twice on a path, and a record goes to the child named by its
value there, so two sets of similarity J meet in J of the children. A node of at most leaf_rows records is compared
exhaustively, as is one of at most dense_rows that keeps most of its parent; larger ones branch on, however alike their
records are, since records that share a template fall apart where they differ. Deep down a node has only so many
branches that a pair at the threshold just survives. Trees repeat this until a pair at the threshold is met with the
probability target_recall. They all draw from the same coordinates, so a pair that agrees in few of them is likely
missed by every tree; the number of trees allows for that. The caller verifies the pairs exactly.

Pairs are compared by sketches: 32 nibbles of the coordinates in shallow leaves, 128 nibbles of a one-permutation hash in
deep and dense ones, where many pairs are nearly similar enough and a narrow sketch would pass them all.

A path depends on nothing but the record's own coordinates, so each level is computed where the record lies; what is
shuffled a level is one pre-aggregated count a node, and at the end the rows of the leaves, each of which is small. Every
few levels the rows that branch on are written, so that levels aren't computed again and again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylight.llm import hashing
from quarrylight.storage import materialize

COORDINATES = 32
#: Nodes that may be broadcast; more are joined by a shuffle.
BROADCAST_NODES = 200_000
#: Rows compared at once.
AT_ONCE = 200_000
PAIRS = "grp int, a long, b long, side int"
#: Levels at which all nodes branch alike, and after how many further ones rows are written.
SHALLOW, WRITTEN = 3, 4


@dataclass(frozen=True)
class Forest:
    """threshold: the least similarity sought. branches: children of a root; deeper: of the nodes of the next levels, SHALLOW in all; below, `surviving` / threshold on average. target_recall: of pairs right at the threshold, met three levels down. leaf_rows: the most a node compares as a whole. dense_share: part of its parent from which on a node of up to dense_rows no longer branches. block_rows: of a node that is compared in blocks."""

    threshold: float
    branches: int = 5
    deeper: int = 2
    target_recall: float = 0.9975
    leaf_rows: int = 256
    dense_share: float = 0.5
    dense_rows: int = 2048
    block_rows: int = 1024
    deepest: int = 24
    surviving: float = 1.15

    def spread(self, depth: int) -> float:
        """Children of a node at this depth, on average."""
        return self.deeper if depth < SHALLOW else min(self.deeper, self.surviving / self.threshold)

    def met(self, depth: int = 3, agreeing: float | None = None) -> float:
        """The probability that one tree keeps a pair together down to depth, if this share of its coordinates agrees."""
        p, share = 1.0, self.threshold if agreeing is None else agreeing
        for level in range(depth, 1, -1):
            mean = self.spread(level - 1)
            part = mean - math.floor(mean)
            p = 1 - (1 - part) * (1 - share * p) ** math.floor(mean) - part * (1 - share * p) ** (math.floor(mean) + 1)
        return 1 - (1 - share * p) ** self.branches

    def recall(self, trees: int, depth: int = 3) -> float:
        """The probability that so many trees over the same coordinates meet a pair at the threshold, over how many of these agree."""
        t, n = self.threshold, COORDINATES
        return math.fsum(math.comb(n, k) * t**k * (1 - t) ** (n - k) * (1 - (1 - self.met(depth, k / n)) ** trees) for k in range(n + 1))

    @property
    def trees(self) -> int:
        """So many that recall is target_recall, or as many as there are coordinates if none are enough."""
        return next((n for n in range(1, COORDINATES) if self.recall(n) >= self.target_recall), COORDINATES)

    def least_wide(self, filled: np.ndarray, deviations: float = 3) -> np.ndarray:
        """Of so many bins that either record fills, those that must agree: so many standard deviations below what a pair at the threshold has."""
        p = self.threshold + (1 - self.threshold) / 15
        return filled * p - deviations * np.sqrt(filled * p * (1 - p))

    def least_nibbles(self) -> int:
        """Of 32 nibbles that agree: three standard deviations below what a pair at the threshold has."""
        p = self.threshold + (1 - self.threshold) / 16
        return max(0, math.floor(32 * p - 3 * math.sqrt(32 * p * (1 - p))))


def with_signature(values: np.ndarray, lengths: np.ndarray) -> dict[str, pa.Array]:
    """The columns sig, s0, s1 and wide of records whose hashed values lie one after another; no record may be empty."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    sig = hashing.minwise(values, starts, COORDINATES) if len(lengths) else np.empty((0, COORDINATES), dtype=np.int32)
    s0, s1 = hashing.nibbles(sig)
    offsets = pa.array(np.arange(len(lengths) + 1, dtype=np.int32) * COORDINATES)
    bins = pa.array(np.arange(len(lengths) + 1, dtype=np.int32) * hashing.WIDE)
    wide = hashing.packed_bins(hashing.bin_minima(values, lengths))
    return {"sig": pa.ListArray.from_arrays(offsets, pa.array(sig.ravel())), "s0": pa.array(s0), "s1": pa.array(s1), "wide": pa.ListArray.from_arrays(bins, pa.array(wide.ravel()))}


def _value(at: Column) -> Column:
    return F.element_at("sig", at + 1)


def _name(*parts: Column) -> Column:
    """A node's name: 48 bits, which shuffle smaller than 64 and at worst let two nodes be one."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 16)


def _roots(records: DataFrame, forest: Forest) -> DataFrame:
    nodes = []
    for tree in range(forest.trees):
        for j in range(forest.branches):
            at = (tree * forest.branches + j) % COORDINATES
            nodes.append(_name(F.lit(tree), F.col("grp"), F.lit(at), _value(F.lit(at))))
    rows = records.select("*", F.posexplode(F.array(*nodes)).alias("_k", "node"))
    return rows.withColumn("used", F.expr(f"shiftleft(1L, _k % {COORDINATES})")).drop("_k")


def _children(rows: DataFrame, forest: Forest, depth: int) -> DataFrame:
    """The children of nodes at depth: used are the bits of the coordinates of a node's path, which aren't taken again."""
    bits = lambda salt: F.xxhash64(F.col("node"), F.lit(salt)).bitwiseAND(F.lit(COORDINATES - 1)).cast("int")
    part = forest.spread(depth) - 1
    twice = F.pmod(F.xxhash64(F.col("node"), F.lit(3)), F.lit(1 << 20)) < int(part * (1 << 20))
    if depth <= SHALLOW:  # few are taken: another try is enough, and cheaper than a list
        step = bits(2).bitwiseOR(F.lit(1))
        again = lambda at: F.when(F.getbit(F.col("used"), at) == 1, (at + step).bitwiseAND(F.lit(COORDINATES - 1))).otherwise(at)
        first = bits(1)
        chosen = F.array(again(first), again((first + bits(4).bitwiseOR(F.lit(1))).bitwiseAND(F.lit(COORDINATES - 1))))
        rows = rows.withColumn("_at", F.explode(chosen if part == 1 else F.when(twice, chosen).otherwise(F.slice(chosen, 1, 1))))
    else:
        free = F.filter(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), lambda c: F.getbit(F.col("used"), c) == 0)
        rows = rows.withColumn("_free", free).withColumn("_n", F.size("_free"))
        first = F.pmod(F.xxhash64(F.col("node"), F.lit(1)), F.col("_n"))
        second = F.pmod(first + 1 + F.pmod(F.xxhash64(F.col("node"), F.lit(2)), F.col("_n") - 1), F.col("_n"))
        chosen = F.when(twice, F.array(first, second)).otherwise(F.array(first))
        rows = rows.withColumn("_at", F.explode(F.transform(chosen, lambda k: F.get("_free", k.cast("int")))))
    return rows.withColumns({"node": _name(F.col("node"), F.col("_at"), _value(F.col("_at"))), "used": F.expr("used | shiftleft(1L, _at)")}).drop("_free", "_n", "_at")


def _blocks(rows: DataFrame, forest: Forest) -> DataFrame:
    """Cells of a dense node: every two of its blocks meet in one."""
    blocks = F.ceil(F.col("cnt") / forest.block_rows).cast("int")
    rows = rows.withColumn("_n", blocks).withColumn("_own", F.pmod(F.xxhash64("rid", F.lit(5)), F.col("_n")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return rows.withColumn("node", _name(F.col("node"), F.least("_own", "_other"), F.greatest("_own", "_other")))



def _compare(forest: Forest, by_size: bool, broad: bool):
    """Compares the rows of each node, which follow one another, many nodes at once; by the wide sketches if broad."""
    least, ratio = forest.least_nibbles(), forest.threshold

    def near(sketch: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = sketch[i], sketch[j]
        if not broad:
            return hashing.equal_nibbles(a[:, 0], b[:, 0]) + hashing.equal_nibbles(a[:, 1], b[:, 1]) >= least
        filled = hashing.filled_nibbles(a | b).sum(axis=1)
        return filled - hashing.filled_nibbles(a ^ b).sum(axis=1) >= forest.least_wide(filled) - 1e-9

    def pairs(cols: list[np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
        node, rid, meta, sketch = cols
        at, lag = np.arange(len(node) - 1), 1
        while True:
            at = at[at + lag < len(node)]
            at = at[node[at] == node[at + lag]]
            if not len(at):
                return
            kept = near(sketch, at, at + lag)
            i, j = at[kept], at[kept] + lag
            keep = (rid[i] != rid[j]) | (meta[i] != meta[j])
            keep &= (meta[i] & meta[j] & 1) == 0
            if by_size:
                m, n = (meta[i] >> 1) & 0xFFFFFFFF, (meta[j] >> 1) & 0xFFFFFFFF
                keep &= np.minimum(m, n) >= ratio * np.maximum(m, n) - 1e-9
            i, j = i[keep], j[keep]
            side_i, side_j = meta[i] & 1, meta[j] & 1
            turn = (side_i > side_j) | ((side_i == side_j) & (rid[i] > rid[j]))
            a, b = np.where(turn, j, i), np.where(turn, i, j)
            yield (meta[a] >> 33).astype(np.int32), rid[a], rid[b], (meta[b] & 1).astype(np.int32)
            lag += 1

    schema = pa.schema([("grp", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("side", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0

        def flush(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for found in pairs(cols):
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], schema=schema)

        for batch in batches:
            held.append([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)])
            if broad:
                held[-1].append(batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, hashing.WIDE))
            else:
                held[-1].append(np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 4)], axis=1))
            rows += batch.num_rows
            if rows >= AT_ONCE:
                cols = [np.concatenate(x) for x in zip(*held)]
                cut = int(np.searchsorted(cols[0], cols[0][-1]))  # where the last node, which may go on, begins
                yield from flush([c[:cut] for c in cols])
                held, rows = [[c[cut:] for c in cols]], len(cols[0]) - cut
        if rows:
            yield from flush([np.concatenate(x) for x in zip(*held)])

    return run, PAIRS


def candidates(records: DataFrame, forest: Forest, by_size: bool = False) -> DataFrame:
    """Pairs of records that met in a node and whose sketches don't rule the threshold out.

    records: grp int (only records of one grp are compared), rid long, side int (0 or 1; two records of side 1 aren't
    compared), size int, sig, s0, s1, wide as with_signature() makes them; a stored table, as each level reads it. Returns distinct grp, a, b, side: a is of side 0,
    side is b's, and a < b where that is 0. An empty input gives no rows; by_size drops pairs whose sizes alone rule
    the threshold out. Records should be distinct: a record met by its own copy gives no pair.
    """
    spark = records.sparkSession
    meta = F.shiftleft(F.col("grp").cast("long"), 33).bitwiseOR(F.shiftleft(F.col("size").cast("long"), 1)).bitwiseOR(F.col("side").cast("long"))
    records = records.select("grp", "rid", meta.alias("meta"), "sig", "s0", "s1", "wide")
    totals = {r["grp"]: r["n"] for r in records.groupBy("grp").agg(F.count("*").alias("n")).collect()}  # one row a grp, of which the caller has a fixed few
    slim, broad = ["node", "rid", "meta", "s0", "s1"], ["node", "rid", "meta", "wide"]
    leaves: list[DataFrame] = []
    deep: list[DataFrame] = []
    if totals:
        parent = F.create_map(*[F.lit(x) for kv in totals.items() for x in kv])
        rows = _roots(records, forest).withColumn("pcnt", parent[F.col("grp")].cast("long"))
        for depth in range(1, forest.deepest + 1):
            counts = rows.groupBy("node").agg(F.count("*").alias("cnt"), F.max("pcnt").alias("pcnt")).where(F.col("cnt") > forest.leaf_rows)
            last = depth == forest.deepest
            dense = F.lit(last) | ((F.col("cnt") >= forest.dense_share * F.col("pcnt")) & (F.col("cnt") <= forest.dense_rows))
            counts = materialize(counts.select("node", "cnt", dense.alias("dense")), "nodes")
            kinds = {r["dense"]: r["n"] for r in counts.groupBy("dense").agg(F.count("*").alias("n")).collect()}
            small, kept = (leaves, slim) if depth <= SHALLOW else (deep, broad)
            if not kinds:
                small.append(rows.select(kept))
                break
            large = F.broadcast(counts) if sum(kinds.values()) <= BROADCAST_NODES else counts
            small.append(rows.join(large.select("node"), "node", "left_anti").select(kept))
            inner = rows.drop("pcnt").join(large, "node")
            if kinds.get(True):
                deep.append(_blocks(inner.where("dense"), forest).select(broad))
            if not kinds.get(False):
                break
            rows = _children(inner.where("not dense").withColumnRenamed("cnt", "pcnt").drop("dense"), forest, depth)
            if depth >= SHALLOW and (depth - SHALLOW) % WRITTEN == 0:
                rows = materialize(rows, "paths")
    names = ["grp", "a", "b", "side"]
    parts = []
    for found, is_broad in ((leaves, False), (deep, True)):
        if found:
            compare, schema = _compare(forest, by_size, is_broad)
            met = reduce(DataFrame.unionByName, found).repartition("node").sortWithinPartitions("node")
            parts.append(met.mapInArrow(compare, schema))
    if not parts:
        return spark.createDataFrame([], PAIRS)
    return reduce(DataFrame.unionByName, parts).groupBy(*names).agg(F.lit(1).alias("_")).drop("_")


def _narrow(forest: Forest):
    """grp, a, b, wide sketch of a, of b to the pairs that pass five standard deviations below what one at the threshold has; one in a million of those there fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(k).flatten().to_numpy(zero_copy_only=False).reshape(-1, hashing.WIDE) for k in (3, 4))
            filled = hashing.filled_nibbles(x | y).sum(axis=1)
            kept = filled - hashing.filled_nibbles(x ^ y).sum(axis=1) >= forest.least_wide(filled, 5) - 1e-9
            yield pa.RecordBatch.from_arrays(batch.columns[:3], names=["grp", "a", "b"]).filter(pa.array(kept))

    return run, "grp int, a long, b long"


def narrowed(pairs: DataFrame, records: DataFrame, forest: Forest) -> DataFrame:
    """The pairs grp, a, b of records rid, wide (a and b are rids) that pass by their wide sketches too.

    Shallow leaves compare 32 nibbles, which most pairs of half the threshold pass; where verifying a pair is dear, this pays.
    """
    ends, (narrow, schema) = records.select("rid", "wide"), _narrow(forest)
    both = pairs.join(ends.withColumnsRenamed({"rid": "a", "wide": "x"}), "a").join(ends.withColumnsRenamed({"rid": "b", "wide": "y"}), "b")
    return both.select("grp", "a", "b", "x", "y").mapInArrow(narrow, schema)


#: Keys of one record that are joined in one part.
PART = 1000


def expanded(links: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """links (on..., a, side, b) with x, the keys of a, and y, those of b; keys: on..., side, rid, key; a is of side 0.

    The keys of a record with many (copies of one text, say) are dealt to parts, and each of its links is joined with
    every part, so that no join key has more than about PART rows of keys.
    """
    by = [*on, "side", "rid"]
    hot = materialize(keys.groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") > PART).select(*by, F.ceil(F.col("n") / PART).cast("int").alias("parts")), "hot")
    keys = keys.join(hot, by, "left").withColumn("part", F.pmod(F.xxhash64("key", F.lit(8)), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    for end, name, own in (("a", "x", lambda df: df.where("side = 0").drop("side")), ("b", "y", lambda df: df)):
        ends = [*on, end] if end == "a" else [*on, "side", end]
        links = links.join(own(hot).withColumnRenamed("rid", end), ends, "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        links = links.join(own(keys).withColumnsRenamed({"rid": end, "key": name}), [*ends, "part"]).drop("part")
    return links
