"""Near-duplicate texts: pairs whose word sequences overlap above a threshold, found by chosen paths and verified exactly."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylight.llm import chosen_path, hashing
from quarrylight.llm.chosen_path import Forest
from quarrylight.storage import materialize

#: Ids that may be broadcast to thin out the texts before they are shuffled; with more of them the join alone does it.
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class NearDuplicates:
    """texts: grp, key, rid (one text), of every text long enough. pairs: grp, a, b, similarity: rids of different texts, a < b."""

    texts: DataFrame
    pairs: DataFrame

    def key_pairs(self) -> DataFrame:
        """grp, key_a, key_b of all different keys whose texts are equal or near, the smaller key first."""
        of = self.texts.select("grp", "rid", "key")
        copies = of.groupBy("grp", "rid").agg(F.count("*").alias("n")).where("n > 1").select("grp", F.col("rid").alias("a"), F.col("rid").alias("b"))
        links = self.pairs.select("grp", "a", "b").unionByName(copies).withColumn("side", F.lit(0))
        both = chosen_path.expanded(links, of.withColumn("side", F.lit(0)), ["grp"]).where("x <> y")
        return both.select("grp", F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b")).distinct()

    def classes(self) -> DataFrame:
        """grp, key, rid and links: how many other texts are near the key's text. Copies share a rid."""
        ends = self.pairs.select("grp", F.explode(F.array("a", "b")).alias("rid")).groupBy("grp", "rid").agg(F.count("*").alias("links"))
        return self.texts.join(ends, ["grp", "rid"], "left").select("grp", "key", "rid", F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def _sign(width: int, least_words: int):
    """grp, h0, h1, text to the records of chosen_path; texts of too few words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hashing.WordHashes()
        for batch in batches:
            lists = [hashing.words_of(t) for t in batch.column(3).to_pylist()]
            counts = np.array([len(x) for x in lists], dtype=np.int64)
            kept = np.flatnonzero(counts >= max(least_words, width))
            values = known.flat([lists[i] for i in kept])
            ends = np.cumsum(counts[kept])
            grams = hashing.shingles(values, width)
            inside = np.ones(len(grams), dtype=bool)  # a shingle doesn't reach into the next text
            for k in range(1, width):
                cut = ends - k
                inside[cut[cut < len(grams)]] = False
            columns = {name: batch.column(k).take(pa.array(kept)) for k, name in enumerate(("grp", "h0", "h1"))}
            columns |= chosen_path.with_signature(grams[inside], counts[kept] - width + 1)
            yield pa.RecordBatch.from_pydict(columns)

    return run, "grp int, h0 long, h1 long, sig array<int>, s0 long, s1 long, wide array<long>"


def _verify(width: int, threshold: float):
    """grp, a, b, text of a, text of b to the pairs of at least threshold."""

    def shingle_set(text: str) -> set:
        words = hashing.words_of(text)
        return set(zip(*(words[k:] for k in range(width))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grp, a, b, x, y = (c.to_pylist() for c in batch.columns)
            sets: dict[int, set] = {}
            rows = []
            for k in range(len(a)):
                for rid, text in ((a[k], x[k]), (b[k], y[k])):
                    if rid not in sets:
                        sets[rid] = shingle_set(text)
                p, q = sets[a[k]], sets[b[k]]
                common = len(p & q)
                if p and common >= threshold * (len(p) + len(q) - common) - 1e-9:
                    rows.append((grp[k], a[k], b[k], common / (len(p) + len(q) - common)))
            if rows:
                g, i, j, s = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array(s, pa.float64())], names=["grp", "a", "b", "similarity"])

    return run, "grp int, a long, b long, similarity double"


def near_duplicates(texts: DataFrame, width: int = 5, threshold: float = 0.8, least_words: int = 0, forest: Forest | None = None) -> NearDuplicates:
    """Pairs of texts that share at least threshold of their sequences of width words (those in both / in either).

    texts: grp int (texts of different grps aren't compared), key string, text string; other columns are ignored.
    Null texts and those of fewer than max(width, least_words) words belong to no pair. Equal texts (by 128
    bits of hash) are one text with one rid, of which texts names the keys; rows repeated as a whole count once. A key may have
    several texts. Empty input gives empty results. Runs jobs and writes to the shared folder when called. Words are maximal runs of letters or digits of the lower-cased text.
    """
    forest = forest or Forest(threshold)
    short = 2 * max(least_words, width) - 1  # so many words have at least so many characters
    both_hashes = F.xxhash64("text").alias("h0"), F.xxhash64(F.lit(1), "text").alias("h1")
    rows = texts.where(F.col("text").isNotNull() & (F.length("text") >= short)).select("grp", "key", *both_hashes, "text")
    same = ["grp", "h0", "h1"]
    sign, schema = _sign(width, least_words)
    signed = rows.dropDuplicates(same).select(*same, "text").mapInArrow(sign, schema).withColumn("rid", F.monotonically_increasing_id())
    signed = materialize(signed, "signed")
    met = chosen_path.candidates(signed.select("*", F.lit(0).alias("side"), F.lit(0).alias("size")), forest)
    met = materialize(chosen_path.narrowed(met.select("grp", "a", "b"), signed, forest), "met")
    ids = met.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
    ids = materialize(signed.select(*same, "rid").join(ids, "rid", "left_semi"), "ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    found = rows.join(wanted, same).dropDuplicates(["rid"]).select("rid", "text")
    both = met.join(found.withColumnsRenamed({"rid": "a", "text": "x"}), "a").join(found.withColumnsRenamed({"rid": "b", "text": "y"}), "b")
    verify, schema = _verify(width, threshold)
    pairs = materialize(both.select("grp", "a", "b", "x", "y").mapInArrow(verify, schema), "pairs")
    keyed = rows.select(*same, "key").distinct().join(signed.select(*same, "rid"), same).select("grp", "rid", "key")
    return NearDuplicates(materialize(keyed, "keyed"), pairs)
