"""Trend snapshots and coverage gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def frequencies(rows: DataFrame, column: str, key: str = "id") -> DataFrame:
    """item and repos: in how many rows of an array column each item occurs; nulls don't count, repeats in a row once."""
    return rows.select(key, F.explode(F.array_distinct(column)).alias("item")).where("item is not null").groupBy("item").agg(F.count("*").alias("repos"))


def top(counts: DataFrame, n: int) -> DataFrame:
    """The n most frequent items, ties by item."""
    return counts.orderBy(F.desc("repos"), "item").limit(n)


def summary(rows: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """One row: total, active (tagged Active), new_last_30d (updated within so many days: the name is the published one)."""
    since = as_of - F.make_dt_interval(F.lit(days))
    return rows.agg(F.count("*").alias("total"), F.count_if(F.coalesce(F.array_contains("tags", "Active"), F.lit(False))).alias("active"), F.count_if(F.coalesce(F.col("updated") > since, F.lit(False))).alias("new_last_30d"))


def gaps(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """category, severity, repo_count, description, suggestion of the categories with fewer repos than expected, the worst first.

    counts: item, repos; expected: ord int, category, expected int, a table of fixed size. Severity is high from a
    deficit of three quarters of what is expected, medium from two fifths, else low.
    """
    both = F.broadcast(expected).join(counts, F.col("category") == F.col("item"), "left").withColumn("n", F.coalesce("repos", F.lit(0)))
    both = both.where(F.col("n") < F.col("expected")).withColumn("short", F.col("expected") - F.col("n"))
    rank = F.when(F.col("short") >= F.col("expected") * 0.75, 0).when(F.col("short") >= F.col("expected") * 0.4, 1).otherwise(2)
    named = both.withColumn("_rank", rank).orderBy("_rank", "ord")
    return named.select(
        "category",
        F.element_at(F.array(F.lit("high"), F.lit("medium"), F.lit("low")), F.col("_rank") + 1).alias("severity"),
        F.col("n").cast("long").alias("repo_count"),
        # The texts of the two columns.
        F.format_string("Only %d repos in %s (expected %d+)", "n", "category", "expected").alias("description"),
        F.format_string("Add %d more repos covering %s", "short", "category").alias("suggestion"),
    )


def snapshot(rows: DataFrame, as_of: Column, tags: int = 20, categories: int = 10) -> DataFrame:
    """One row: captured_at, total_repos, active_repos, new_repos_last_30d, top_tags, top_categories, tag_counts, category_counts.

    rows: id, tags array<string>, categories array<string>, updated. The maps hold every tag and category, so they grow
    with the vocabulary, not with the rows; keep them as rows (frequencies()) where it has no bound. Ties by name.
    """

    def counted(column: str, n: int) -> tuple[Column, Column, DataFrame]:
        counts = frequencies(rows.where(F.col(column).isNotNull()), column).where("item <> ''")
        listed = counts.agg(F.collect_list(F.struct((-F.col("repos")).alias("n"), "item")).alias("l"))
        ordered = F.transform(F.slice(F.array_sort("l"), 1, n), lambda x: x["item"])
        return ordered.alias(f"top_{column}"), F.map_from_entries(F.transform("l", lambda x: F.struct(x["item"], -x["n"]))).alias(f"{column}_counts"), listed

    top_tags, tag_counts, listed_tags = counted("tags", tags)
    top_categories, category_counts, listed_categories = counted("categories", categories)
    one = summary(rows, as_of).select(as_of.alias("captured_at"), F.col("total").alias("total_repos"), F.col("active").alias("active_repos"), F.col("new_last_30d").alias("new_repos_last_30d"))
    first = listed_tags.select(top_tags, tag_counts.alias("tag_counts"))
    second = listed_categories.select(top_categories, category_counts.alias("category_counts"))
    return one.crossJoin(first).crossJoin(second)  # one row each
