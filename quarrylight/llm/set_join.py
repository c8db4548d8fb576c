"""All pairs of similar sets, within or between two tables, found by chosen paths and verified exactly."""

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


#: Values of a set that is kept in one row; larger ones stay rows of their own, a chunk of this size a group.
LARGE = 1_000_000


@dataclass(frozen=True)
class SimilarSets:
    """members: grp, side, key, rid (one set), of every set large enough. pairs: grp, a, b, side, common, either: rids of different sets (or of equal ones of both sides); side is b's."""

    members: DataFrame
    pairs: DataFrame

    def key_pairs(self) -> DataFrame:
        """grp, side, key_a, key_b of all different keys whose sets are equal or similar, the smaller key first; side 1: one of each table."""
        of = self.members
        copies = of.where("side = 0").groupBy("grp", "rid").agg(F.count("*").alias("n")).where("n > 1").select("grp", F.col("rid").alias("a"), F.col("rid").alias("b"), F.lit(0).alias("side"))
        links = self.pairs.select("grp", "a", "b", "side").unionByName(copies)
        both = chosen_path.expanded(links, of, ["grp"]).where("x <> y")
        return both.select("grp", "side", F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b")).distinct()

    def classes(self) -> DataFrame:
        """grp, side, key, rid and links: to how many other sets the key's set is similar. Copies share a rid."""
        ends = self.pairs.select("grp", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("rid")), F.struct("side", F.col("b").alias("rid")))).alias("e")).select("grp", "e.*")
        ends = ends.groupBy("grp", "side", "rid").agg(F.count("*").alias("links"))
        return self.members.join(ends, ["grp", "side", "rid"], "left").select("grp", "side", "key", "rid", F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """grp, side, h0, h1, tokens to the records of chosen_path."""
    for batch in batches:
        tokens = batch.column(4)
        lengths = np.diff(tokens.offsets.to_numpy())
        values = tokens.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        columns = {"grp": batch.column(0), "side": batch.column(1), "h0": batch.column(2), "h1": batch.column(3), "size": pa.array(lengths.astype(np.int32))}
        yield pa.RecordBatch.from_pydict(columns | chosen_path.with_signature(values, lengths) | {"tokens": tokens})


def gathered(rows: DataFrame, large: int = LARGE) -> tuple[DataFrame, DataFrame | None]:
    """Rows of grp, side, key, token as sets for similar_sets, and the rows of the keys that have more than `large`, if any, with their number n."""
    keys = ["grp", "side", "key"]
    many = materialize(rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > large), "many")
    if many.isEmpty():
        return rows.groupBy(*keys).agg(F.collect_set("token").alias("tokens")), None
    small = rows.join(many.select(*keys), keys, "left_anti").groupBy(*keys).agg(F.collect_set("token").alias("tokens"))
    return small, materialize(rows.join(many, keys).select(*keys, "token", "n").distinct(), "large")


def _sign_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """grp, side, key, tokens to grp, side, key, size, sig of these tokens."""
    for batch in batches:
        tokens = batch.column(3)
        lengths = np.diff(tokens.offsets.to_numpy())
        values = tokens.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        signed = chosen_path.with_signature(values, lengths)
        offsets = pa.array(np.arange(len(lengths) + 1, dtype=np.int32) * hashing.BINS)
        bins = pa.ListArray.from_arrays(offsets, pa.array(hashing.bin_minima(values, lengths).ravel().view(np.int32)))
        yield pa.RecordBatch.from_pydict({"grp": batch.column(0), "side": batch.column(1), "key": batch.column(2), "size": pa.array(lengths.astype(np.int64)), "sig": signed["sig"], "bins": bins})


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """grp, side, key, size, bins, sig to the same with s0, s1 and wide instead of bins."""
    for batch in batches:
        bins, sig = (batch.column(k).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, n) for k, n in ((4, hashing.BINS), (5, chosen_path.COORDINATES)))
        s0, s1 = hashing.nibbles(sig)
        offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * hashing.WIDE)
        wide = pa.ListArray.from_arrays(offsets, pa.array(hashing.packed_bins(bins).ravel()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], batch.column(5), pa.array(s0), pa.array(s1), wide], names=["grp", "side", "key", "size", "sig", "s0", "s1", "wide"])


def _signed_large(large: DataFrame, least_size: int, chunk: int) -> DataFrame:
    """grp, side, rid, key, size, sig, s0, s1 of sets that stay rows: their signature is the least of their chunks'."""
    keys = ["grp", "side", "key"]
    parts = large.withColumn("_chunk", F.pmod(F.xxhash64("token", F.lit(3)), F.ceil(F.col("n") / chunk))).groupBy(*keys, "_chunk").agg(F.collect_set("token").alias("tokens"))
    signed = parts.select(*keys, "tokens").mapInArrow(_sign_chunks, "grp int, side int, key string, size long, sig array<int>, bins array<int>")
    least = F.array(*[F.min(F.col("sig")[c]) for c in range(chosen_path.COORDINATES)])
    bins = F.array(*[F.min(F.col("bins")[c]) for c in range(hashing.BINS)])
    whole = signed.groupBy(*keys).agg(F.sum("size").cast("int").alias("size"), bins.alias("bins"), least.alias("sig")).where(F.col("size") >= least_size)
    whole = whole.select("grp", "side", "key", "size", "bins", "sig").mapInArrow(_sketch, "grp int, side int, key string, size int, sig array<int>, s0 long, s1 long, wide array<long>")
    return materialize(whole.withColumn("rid", -1 - F.monotonically_increasing_id()), "signed")  # others are not negative


def similar_sets(sets: DataFrame, numerator: int = 3, denominator: int = 4, least_size: int = 1, forest: Forest | None = None, large: DataFrame | None = None, chunk: int = LARGE) -> SimilarSets:
    """Pairs of sets whose common values are at least numerator / denominator of their distinct values.

    sets: grp int, side int, key string, tokens array<long> (hashes of the values); sets of different grps aren't
    compared, nor two of side 1. Null tokens, repeats and sets of fewer than least_size values (at least one) are left
    out; a row whose key is null too. Equal sets are one set with one rid, of which members names the keys; a key given
    in several rows with different sets has each of them. Empty input gives empty results. Sets are equal by 128 bits of
    hash, values by the caller's 64. Runs jobs and writes to the shared folder when called. large: grp, side, key, token,
    n, the sets too large for a row, as gathered() gives them; they are signed in chunks of about `chunk` values and
    verified by joins, and equal ones are a pair each instead of one set.
    """
    forest = forest or Forest(numerator / denominator, branches=4)
    clean = F.array_sort(F.array_distinct(F.array_compact("tokens")))
    rows = sets.where(F.col("key").isNotNull()).select("grp", "side", "key", clean.alias("tokens")).where(F.size("tokens") >= max(1, least_size))
    same = ["grp", "side", "h0", "h1"]
    rows = materialize(rows.withColumns({"h0": F.xxhash64("tokens"), "h1": F.xxhash64(F.lit(1), "tokens")}), "sets")
    distinct = rows.dropDuplicates(same).select(*same, "tokens")
    signed = distinct.mapInArrow(_sign, "grp int, side int, h0 long, h1 long, size int, sig array<int>, s0 long, s1 long, wide array<long>, tokens array<long>")
    signed = materialize(signed.withColumn("rid", F.monotonically_increasing_id()), "signed")
    records = signed.drop("tokens", "h0", "h1")
    members = rows.select(*same, "key").distinct().join(signed.select(*same, "rid"), same).select("grp", "side", "rid", "key")
    if large is not None:
        big = _signed_large(large.where(F.col("key").isNotNull() & F.col("token").isNotNull()), least_size, chunk)
        records, members = records.unionByName(big.drop("key")), members.unionByName(big.select("grp", "side", "rid", "key"))
    met = chosen_path.candidates(records, forest, by_size=True)
    if large is not None:
        met = materialize(met, "met")
    left = signed.where("side = 0").select("grp", F.col("rid").alias("a"), F.col("tokens").alias("x"))
    right = signed.select("grp", "side", F.col("rid").alias("b"), F.col("tokens").alias("y"))
    both = met.join(left, ["grp", "a"]).join(right, ["grp", "side", "b"])
    both = both.select("grp", "a", "b", "side", F.size(F.array_intersect("x", "y")).alias("common"), (F.size("x") + F.size("y")).alias("sum"))
    if large is not None:
        both = both.unionByName(_counted(met, signed, big, large))
    both = both.withColumn("either", F.col("sum") - F.col("common")).where(F.col("common") * denominator >= F.col("either") * numerator)
    pairs = materialize(both.select("grp", "a", "b", "side", "common", "either"), "pairs")
    return SimilarSets(members, pairs)


def _counted(met: DataFrame, signed: DataFrame, big: DataFrame, large: DataFrame) -> DataFrame:
    """grp, a, b, side, common, sum of the pairs with a large set, by joining the values of both."""
    ids = big.select("grp", F.col("rid").alias("r"), F.col("side").alias("s"))
    open_pairs = met.join(ids.where("s = 0").select("grp", F.col("r").alias("a"), F.lit(True).alias("_a")), ["grp", "a"], "left")
    open_pairs = open_pairs.join(ids.select("grp", F.col("r").alias("b"), F.col("s").alias("side"), F.lit(True).alias("_b")), ["grp", "b", "side"], "left").where("_a or _b").select("grp", "a", "b", "side")
    values = large.join(big.select("grp", "side", "key", "rid", "size"), ["grp", "side", "key"]).select("grp", "side", "rid", "size", "token")
    near = open_pairs.select("grp", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("rid")), F.struct("side", F.col("b").alias("rid")))).alias("e")).select("grp", "e.*").distinct()
    values = values.unionByName(signed.join(near, ["grp", "side", "rid"]).select("grp", "side", "rid", "size", F.explode("tokens").alias("token")))
    left = values.where("side = 0").select("grp", F.col("rid").alias("a"), F.col("size").alias("m"), "token")
    right = values.select("grp", "side", F.col("rid").alias("b"), F.col("size").alias("n"), "token")
    common = open_pairs.join(left, ["grp", "a"]).join(right, ["grp", "side", "b", "token"]).groupBy("grp", "a", "b", "side").agg(F.count("*").cast("int").alias("common"), F.first(F.col("m") + F.col("n")).alias("sum"))
    return common.select("grp", "a", "b", "side", "common", "sum")
