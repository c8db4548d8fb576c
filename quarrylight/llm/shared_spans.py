"""Long exact spans that occur in several texts, by seeds that are chained collinearly and aligned.

Of every `least` characters at least one k-mer is a seed: the one with the smallest hash among the k-mers of each window
of least - k + 1 positions, which depends on those characters alone. Texts that share so long a stretch share a seed. The
seeds two texts share are chained with gap costs through a Fenwick tree, and the seeds of each chain are extended to
maximal equal blocks. Of a seed with more than `often` occurrences the texts aren't paired, since pairs grow with the
square: the fingerprints of all stretches of `least` characters around its occurrences are counted instead, which finds
the same characters in time that grows with the text. Equal texts are one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrylight.llm import hashing
from quarrylight.storage import materialize

#: Characters fingerprinted at once, so that memory doesn't grow with the text, and positions kept of one seed in one text.
PIECE, KEPT = 1 << 20, 4
BROADCAST_IDS = 1_000_000
_U = np.uint64
_BASE = 0x5851F42D4C957F2D
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def fingerprints(codes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """A 64-bit fingerprint of each width consecutive code points."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=_U)
    if n > PIECE:
        return np.concatenate([fingerprints(codes[k : k + PIECE + width - 1], width, seed) for k in range(0, n, PIECE)])
    if seed not in _powers:
        base = (_BASE + 2 * seed * 0x632BE59BD9B4E019) % (1 << 64) | 1
        up, down = np.full(PIECE + 4096, base, dtype=_U), np.full(PIECE + 4096, pow(base, -1, 1 << 64), dtype=_U)
        _powers[seed] = np.cumprod(up), np.cumprod(down)
    up, down = _powers[seed]
    sums = np.zeros(len(codes) + 1, dtype=_U)
    np.cumsum(hashing.mixed(codes.astype(_U) + _U(seed + 1)) * up[: len(codes)], out=sums[1:])
    return hashing.mixed((sums[width:] - sums[:-width]) * down[:n])


def winnowed(values: np.ndarray, window: int) -> np.ndarray:
    """Positions that hold the minimum of some window consecutive values, ties included."""
    if len(values) < window:
        return np.empty(0, dtype=np.int64)
    least = hashing.sliding_min(values, window)
    edge = np.zeros(window - 1, dtype=_U)
    most = ~hashing.sliding_min(~np.concatenate([edge, least, edge]), window)
    return np.flatnonzero(most == values)


def _seeds(least: int, k: int):
    """rid, text to its seeds: rid, seed, positions (the first few), times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, seeds, lists, times = [], [], [], []
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = fingerprints(code_points(text), k)
                at = winnowed(values, least - k + 1)
                found = values[at]
                order = np.argsort(found, kind="stable")
                found, at = found[order], at[order]
                starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else []
                counts = np.diff(np.append(starts, len(found)))
                for s, n in zip(starts, counts):
                    rids.append(rid)
                    seeds.append(found[s])
                    lists.append(at[s : s + min(n, KEPT)].tolist())
                    times.append(int(n))
            if rids:
                yield pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(np.array(seeds, dtype=_U).view(np.int64)), pa.array(lists, pa.list_(pa.int32())), pa.array(times, pa.int64())], names=["rid", "seed", "positions", "times"])

    return run, "rid long, seed long, positions array<int>, times long"


def chains(anchors: list[tuple[int, int]], k: int, gap: float = 0.1) -> list[list[tuple[int, int]]]:
    """Anchors (position in a, position in b) of length k as collinear chains, best first; each anchor is in one.

    A chain scores k for each anchor less gap for each character between the starts of two neighbours, in either text.
    A Fenwick tree over the positions in b holds the best score so far of the chains that end there.
    """
    anchors = sorted(set(anchors))
    ranks = {b: r + 1 for r, b in enumerate(sorted({b for _, b in anchors}))}
    tree: list[tuple[float, int]] = [(float("-inf"), -1)] * (len(ranks) + 1)
    score, before = [0.0] * len(anchors), [-1] * len(anchors)
    at = 0
    while at < len(anchors):
        same = at
        while same < len(anchors) and anchors[same][0] == anchors[at][0]:  # anchors of one position don't precede each other
            a, b = anchors[same]
            best, r = (float("-inf"), -1), ranks[b] - 1
            while r:
                best = max(best, tree[r])
                r -= r & -r
            gain = best[0] - gap * (a + b)
            score[same], before[same] = k + max(0.0, gain), best[1] if gain > 0 else -1
            same += 1
        for i in range(at, same):
            a, b = anchors[i]
            entry, r = (score[i] + gap * (a + b), i), ranks[b]
            while r < len(tree):
                tree[r] = max(tree[r], entry)
                r += r & -r
        at = same
    used, out = [False] * len(anchors), []
    for i in sorted(range(len(anchors)), key=lambda i: (-score[i], i)):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(anchors[i])
            i = before[i]
        if path:
            out.append(path[::-1])
    return out


def _equal_run(a: np.ndarray, b: np.ndarray) -> int:
    """How many of the first values agree."""
    n, at, step = min(len(a), len(b)), 0, 256
    while at < n:
        differ = np.flatnonzero(a[at : min(at + step, n)] != b[at : min(at + step, n)])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 2
    return n


def aligned(a: np.ndarray, b: np.ndarray, path: list[tuple[int, int]], k: int) -> list[tuple[int, int, int]]:
    """The maximal equal blocks around a chain's anchors: start in a, start in b, length."""
    blocks: list[tuple[int, int, int]] = []
    reach: dict[int, int] = {}
    for p, q in path:
        if reach.get(p - q, -1) >= p + k or not np.array_equal(a[p : p + k], b[q : q + k]):
            continue
        left = _equal_run(a[:p][::-1], b[:q][::-1])
        right = _equal_run(a[p:], b[q:])
        blocks.append((p - left, q - left, left + right))
        reach[p - q] = p + right
    return blocks


def _align(least: int, k: int):
    """a, b, text of a, text of b, anchors to the equal spans: rid, from, to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = set()
            for i, j, x, y, anchors in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = code_points(x), code_points(y)
                for path in chains([(p["p"], p["q"]) for p in anchors], k):
                    for p, q, n in aligned(a, b, path, k):
                        if n >= least:
                            rows |= {(i, p, p + n), (j, q, q + n)}
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["rid", "from", "to"])

    return run, "rid long, from long, to long"


def _around(least: int, k: int):
    """rid, text, seeds to the stretches of least characters that hold one of the seeds: rid, h0, h1 (their fingerprints), at (all starts of a stretch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, text, seeds in zip(*(c.to_pylist() for c in batch.columns)):
                codes = code_points(text)
                hits = np.isin(fingerprints(codes, k), np.array(seeds, dtype=np.int64).view(_U))
                n = len(codes) - least + 1
                reach = np.concatenate([[0], np.cumsum(hits)])
                starts = np.arange(n)
                starts = starts[reach[starts + least - k + 1] > reach[starts]]
                h0, h1 = fingerprints(codes, least)[starts], fingerprints(codes, least, 1)[starts]
                for s in range(0, len(starts), 100_000):
                    part = slice(s, s + 100_000)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(starts[part]), rid)), pa.array(h0[part].view(np.int64)), pa.array(h1[part].view(np.int64)), pa.array(starts[part].astype(np.int64))], names=["rid", "h0", "h1", "at"])

    return run, "rid long, h0 long, h1 long, at long"


def merged(spans: DataFrame, key: str) -> DataFrame:
    """The maximal runs of what the spans (key, from, to) of each key cover; spans that touch are one run."""
    # sort-based and streaming, so the spans of one key needn't fit in memory
    before = Window.partitionBy(key).orderBy("from", "to").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(key).orderBy("from", "to").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max("to").over(before)
    marked = spans.withColumn("_new", (reach.isNull() | (F.col("from") > reach)).cast("int"))
    marked = marked.withColumn("_run", F.sum("_new").over(upto))
    return marked.groupBy(key, "_run").agg(F.min("from").alias("from"), F.max("to").alias("to")).drop("_run")


def shared_spans(docs: DataFrame, least: int = 300, k: int = 150, often: int = 16) -> DataFrame:
    """doc, from, to: the maximal runs of characters that lie in a stretch of at least `least` characters which the text of another doc also contains.

    docs: doc (any type that can be compared), text string; other columns are ignored, and a doc given twice with one
    text counts once. Positions count code points from 0, `to` is exclusive. Null texts and those of fewer than `least`
    characters share nothing; no rows give no rows. A doc given with several texts has the spans of each.
    """
    rows = docs.where(F.length("text") >= least).select("doc", F.xxhash64("text").alias("rid"), "text")
    owners = rows.select("doc", "rid", F.length("text").cast("long").alias("n")).distinct()
    pick, schema = _seeds(least, k)
    seeds = materialize(rows.dropDuplicates(["rid"]).select("rid", "text").mapInArrow(pick, schema), "seeds")
    total = seeds.groupBy("seed").agg(F.sum("times").alias("times"), F.max("times").alias("most"), F.min("rid").alias("one"), F.max("rid").alias("other")).where("one <> other")
    total = total.select("seed", (F.greatest(F.col("times"), F.when(F.col("most") > KEPT, often + 1).otherwise(0)) > often).alias("hot"))
    shared = materialize(seeds.join(total, "seed"), "shared")
    rare = shared.where("not hot").select("seed", "rid", "positions")
    left = rare.select("seed", F.col("rid").alias("a"), F.explode("positions").alias("p"))
    right = rare.select("seed", F.col("rid").alias("b"), F.explode("positions").alias("q"))
    anchors = left.join(right, "seed").where("a < b").groupBy("a", "b").agg(F.collect_set(F.struct("p", "q")).alias("anchors"))  # of two texts: no more than the longer has seeds, times `often`
    ids = materialize(shared.select("rid").distinct(), "ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = rows.join(wanted, "rid", "left_semi").dropDuplicates(["rid"]).select("rid", "text")
    paired = anchors.join(texts.withColumnsRenamed({"rid": "a", "text": "x"}), "a").join(texts.withColumnsRenamed({"rid": "b", "text": "y"}), "b")
    align, schema = _align(least, k)
    parts = [paired.select("a", "b", "x", "y", "anchors").mapInArrow(align, schema)]
    hot = shared.where("hot").groupBy("rid").agg(F.collect_set("seed").alias("seeds"))  # of one text
    around, schema = _around(least, k)
    stretches = hot.join(texts, "rid").select("rid", "text", "seeds").mapInArrow(around, schema)
    twice = stretches.groupBy("h0", "h1").agg(F.min("rid").alias("one"), F.max("rid").alias("other")).where("one <> other").select("h0", "h1")
    parts.append(stretches.join(twice, ["h0", "h1"]).select("rid", F.col("at").alias("from"), (F.col("at") + least).alias("to")))
    spans = merged(reduce(DataFrame.unionByName, parts), "rid")
    of_doc = owners.select("doc", "rid").join(spans, "rid").select("doc", "from", "to")
    copies = owners.groupBy("rid").agg(F.count_distinct("doc").alias("docs")).where("docs > 1").select("rid")
    whole = owners.join(copies, "rid").select("doc", F.lit(0).cast("long").alias("from"), F.col("n").alias("to"))
    return merged(of_doc.unionByName(whole), "doc")
