"""Nearest neighbours by cosine similarity, exact, in blocks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _block_top(k: int):
    """The k best of the right block for each vector of the left one."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("id").to_numpy(), right.column("id").to_numpy()
        if not len(ids[0]) or not len(ids[1]):
            return pa.table({"source": pa.array([], pa.int64()), "target": pa.array([], pa.int64()), "similarity": pa.array([], pa.float64())})
        mats = [np.array(t.column("v").to_pylist(), dtype=np.float64) for t in (left, right)]
        norms = [np.sqrt((m * m).sum(axis=1)) for m in mats]
        with np.errstate(divide="ignore", invalid="ignore"):
            sims = (mats[0] @ mats[1].T) / np.outer(*norms)
        sims[(ids[0][:, None] == ids[1][None, :]) | ~np.isfinite(sims)] = -np.inf
        n = min(k, len(ids[1]))
        kept = -np.partition(-sims, n - 1, axis=1)[:, n - 1]
        i, j = np.nonzero((sims >= kept[:, None]) & np.isfinite(sims))  # ties at the end are all kept; the ranking below decides
        return pa.table({"source": ids[0][i], "target": ids[1][j], "similarity": sims[i, j]})

    return run


def neighbours(queries: DataFrame, vectors: DataFrame, k: int, block: int = 2048) -> DataFrame:
    """source, target, similarity, rank: the k vectors nearest to each query but itself, ties by target.

    queries, vectors: id long, v array<float>, of one length; null ids and vectors, and those without length, have no
    neighbours. Queries and vectors are cut into blocks of about `block` rows; every two blocks are one matrix product
    in one task, of which only k rows a query are handed on.
    """
    clean = lambda df: df.where("id is not null and v is not null").select("id", "v")
    queries, vectors = clean(queries), clean(vectors)
    parts = [max(1, math.ceil(df.count() / block)) for df in (queries, vectors)]
    part = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    left = queries.withColumn("p", part(parts[0], 1)).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(parts[1] - 1))))
    right = vectors.withColumn("q", part(parts[1], 2)).withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(parts[0] - 1))))
    found = left.groupBy("p", "q").cogroup(right.groupBy("p", "q")).applyInArrow(_block_top(k), "source long, target long, similarity double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("similarity"), "target")))
    return ranked.where(F.col("rank") <= k)


def similarity_edges(vectors: DataFrame, k: int = 12, least: float = 0.4) -> DataFrame:
    """source, target, similarity (4 places), rank: each vector's k nearest of at least `least`, or its nearest if none is."""
    near = neighbours(vectors, vectors, k)
    return near.where((F.col("similarity") >= least) | (F.col("rank") == 1)).select("source", "target", F.round("similarity", 4).alias("similarity"), F.col("rank").cast("long").alias("rank"))
