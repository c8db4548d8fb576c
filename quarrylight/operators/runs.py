"""The log of runs as a table: each change is a row, and the newest of a run counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A change of a run: seq orders them; checkpoint and counts are null unless the change sets them.
SCHEMA = "run long, seq long, status string, at timestamp_ntz, checkpoint string, counts map<string,bigint>, error string"


def current(changes: DataFrame) -> DataFrame:
    """One row a run: run, status, started_at, finished_at, checkpoint, counts, error after its changes, which are in SCHEMA.

    A run starts with the status `running`; `success` and `failed` finish it. A checkpoint holds until a later one or
    success takes its place; counts are those of the success, the error that of the failure.
    """
    last = changes.groupBy("run").agg(
        F.max_by("status", "seq").alias("status"),
        F.min("at").alias("started_at"),
        F.max(F.when(F.col("status") != "running", F.col("at"))).alias("finished_at"),
        F.max_by("checkpoint", F.when(F.col("checkpoint").isNotNull(), F.col("seq"))).alias("checkpoint"),
        F.max_by("counts", F.when(F.col("status") == "success", F.col("seq"))).alias("counts"),
        F.max_by("error", F.when(F.col("status") == "failed", F.col("seq"))).alias("error"),
    )
    return last.withColumn("checkpoint", F.when(F.col("status") != "success", F.col("checkpoint")))


def crashed(runs: DataFrame) -> DataFrame:
    """The newest run that is still running and has a checkpoint, with it; no row if there is none."""
    return runs.where("status = 'running' and checkpoint is not null").orderBy(F.desc("started_at"), F.desc("run")).limit(1).select("run", "checkpoint")


def prior_counts(runs: DataFrame) -> DataFrame:
    """edge_type and edges of the newest success that has counts, for edges.regression_gate()."""
    newest = runs.where("status = 'success' and counts is not null").orderBy(F.desc("finished_at"), F.desc("run")).limit(1)
    return newest.select(F.explode("counts").alias("edge_type", "edges"))


def pending(keys: DataFrame, progress: DataFrame, key: str, done: str = "done") -> DataFrame:
    """The keys without a row of status `done` in progress (key, status), for a run that goes on after a stop."""
    return keys.select(key).distinct().join(progress.where(F.col("status") == done).select(key), key, "left_anti")


def expired(rows: DataFrame, at: Column, before: Column) -> DataFrame:
    """One row: how many rows merging.expire() keeps and deletes."""
    gone = F.coalesce(at < before, F.lit(False))
    return rows.agg(F.count_if(~gone).alias("kept"), F.count_if(gone).alias("deleted"))


def statistics(cache: DataFrame, runs: DataFrame, calls: DataFrame) -> DataFrame:
    """One row: total_repos, permanent_cached, daily_cached of a cache, total_runs, total_api_calls_logged."""
    one = cache.agg(F.count("*").alias("total_repos"), F.count("permanent_fetched_at").alias("permanent_cached"), F.count("daily_fetched_at").alias("daily_cached"))
    return one.crossJoin(runs.agg(F.count("*").alias("total_runs"))).crossJoin(calls.agg(F.count("*").alias("total_api_calls_logged")))  # one row each
