"""Held-out passages inside a corpus: size-partitioned MinHash containment search, verified word by word.

A query is each run of `window` words of an item, or the whole item if it is shorter; the queries are partitioned by
their size, since a document holds runs of every size. A run's sketch is the minimum of the hashes of its three-word
shingles: a document that contains the run has a run of the same shingles, hence the same minimum, so no case is missed,
and since neighbouring runs mostly share their minimum a document has few of them. What agrees is compared exactly.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylight.llm import hashing
from quarrylight.storage import materialize

SHINGLE = 3
#: Runs of the items that are sent to every task; with more of them documents and items meet in a join.
BROADCAST_RUNS = 300_000
#: Words hashed at once.
AT_ONCE = 500_000


def _sketches(values: np.ndarray, size: int) -> np.ndarray:
    """The sketch of each run of size words."""
    width = min(SHINGLE, size)
    return hashing.sliding_min(hashing.shingles(values, width), size - width + 1)


def _groups(texts: list[str]) -> Iterator[tuple[int, list[list[str]]]]:
    """The words of the texts, some texts at a time, and which text is the first."""
    first, held, n = 0, [], 0
    for k, text in enumerate(texts):
        held.append(hashing.words_of(text))
        n += len(held[-1])
        if n >= AT_ONCE:
            yield first, held
            first, held, n = k + 1, [], 0
    if held:
        yield first, held


def _item_runs(window: int):
    """item, text to its runs: item, size, sketch, run (its words with a space between)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hashing.WordHashes()
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = hashing.words_of(text)
                size = min(window, len(words))
                if size:
                    sketches = _sketches(known.flat([words]), size).view(np.int64)
                    rows += {(item, size, int(s), " ".join(words[k : k + size])) for k, s in enumerate(sketches)}
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.string()))], names=["item", "size", "sketch", "run"])

    return run, "item long, size int, sketch long, run string"


def _search(index: dict[int, dict[str, list[int]]], sketches: dict[int, np.ndarray]):
    """doc, text to doc, item, by an index of all runs that each task holds."""
    mask = (1 << 20) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hashing.WordHashes()
        maps = {}
        for size, values in sketches.items():
            maps[size] = np.zeros(mask + 1, dtype=bool)
            maps[size][values & np.uint64(mask)] = True
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = set()
            for first, lists in _groups(texts):
                values, ends = known.flat(lists), np.cumsum([len(x) for x in lists])
                words = list(chain.from_iterable(lists))
                for size, runs in index.items():
                    at = _sketches(values, size)
                    hits = np.flatnonzero(maps[size][at & np.uint64(mask)])
                    hits = hits[np.isin(at[hits], sketches[size])]
                    own = np.searchsorted(ends, hits, side="right")
                    inside = hits + size <= ends[own]
                    for p, k in zip(hits[inside].tolist(), own[inside].tolist()):
                        for item in runs.get(" ".join(words[p : p + size]), ()):
                            found.add((docs[first + k], item))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["doc", "item"])

    return run, "doc long, item long"


def _doc_sketches(sizes: list[int]):
    """doc, text to its distinct sketches: doc, size, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hashing.WordHashes()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = known.flat([hashing.words_of(text)])
                for size in sizes:
                    at = np.unique(_sketches(values, size)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), doc)), pa.array(np.full(len(at), size, dtype=np.int32)), pa.array(at)], names=["doc", "size", "sketch"])

    return run, "doc long, size int, sketch long"


def _contains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, item, text, runs of the item (all of one size): the pairs whose text contains one of the runs."""
    for batch in batches:
        rows = []
        for doc, item, text, runs in zip(*(c.to_pylist() for c in batch.columns)):
            words, size = hashing.words_of(text), runs[0].count(" ") + 1
            wanted = set(runs)
            if any(" ".join(words[k : k + size]) in wanted for k in range(len(words) - size + 1)):
                rows.append((doc, item))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["doc", "item"])


def leaks(docs: DataFrame, items: DataFrame, window: int = 12, broadcast_runs: int = BROADCAST_RUNS) -> DataFrame:
    """doc, item: distinct pairs such that doc holds window consecutive words of item as consecutive words of its own, or all its words if it has fewer.

    docs: doc long, text string; items: item long, text string; other columns are ignored, rows given twice count once.
    Null texts, and texts without a word, take no part; empty tables give no rows. Words are maximal runs of letters or
    digits of the lower-cased text. Up to broadcast_runs distinct runs of the items go to every task, and the documents
    aren't shuffled; beyond that the sketches of documents and items are joined, with the same result.
    """
    spark = docs.sparkSession
    cut, schema = _item_runs(window)
    runs = materialize(items.where("text is not null").select("item", "text").mapInArrow(cut, schema).distinct(), "runs")
    docs = docs.where("text is not null").select("doc", "text")
    if runs.count() <= broadcast_runs:
        index: dict[int, dict[str, list[int]]] = defaultdict(lambda: defaultdict(list))
        values: dict[int, set[int]] = defaultdict(set)
        for r in runs.collect():
            index[r["size"]][r["run"]].append(r["item"])
            values[r["size"]].add(r["sketch"])
        if not index:
            return spark.createDataFrame([], "doc long, item long")
        sketches = {size: np.array(sorted(v), dtype=np.int64).view(np.uint64) for size, v in values.items()}
        search, schema = _search({size: dict(v) for size, v in index.items()}, sketches)
        return docs.mapInArrow(search, schema).distinct()
    sizes = [r["size"] for r in runs.select("size").distinct().collect()]  # at most window of them
    sketch, schema = _doc_sketches(sizes)
    met = docs.mapInArrow(sketch, schema).join(runs.select("item", "size", "sketch").distinct(), ["size", "sketch"]).select("doc", "item").distinct()
    texts = docs.join(met.select("doc").distinct(), "doc", "left_semi").distinct()
    wanted = runs.groupBy("item").agg(F.collect_set("run").alias("runs"))  # the runs of one text
    return met.join(texts, "doc").join(wanted, "item").select("doc", "item", "text", "runs").mapInArrow(_contains, "doc long, item long").distinct()
