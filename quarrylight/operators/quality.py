"""Checks of enriched rows: each gives one row a failed row, or one verdict."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a model says when it fails, in order of search.
FAILURE_MARKERS = ("I cannot", "As an AI", "I don't have", "I do not have", "Sorry, I", "I'm unable", "I am unable", "I'm sorry", "I am sorry")


def enriched(tags: Column, summary: Column, category: Column) -> Column:
    """Whether any of the enrichment's fields is filled."""
    return F.coalesce(F.size(tags) > 0, F.lit(False)) | F.coalesce(summary != "", F.lit(False)) | F.coalesce(category != "", F.lit(False))


def fresh_sample(rows: DataFrame, n: int, since: Column) -> DataFrame:
    """The n newest rows of column updated since then; if there are fewer than n, the n newest of all. Ties by id.

    One pass: rows are the n newest either way, and the n newest hold all fresh ones if these are fewer.
    """
    newest = rows.orderBy(F.desc_nulls_last("updated"), "id").limit(n)
    return newest.withColumn("is_fresh", F.coalesce(F.col("updated") >= since, F.lit(False)))


def failures(rows: DataFrame, categories: DataFrame, longest_tag: int = 50, shortest: int = 50, longest: int = 2000, markers: tuple[str, ...] = FAILURE_MARKERS) -> DataFrame:
    """id, check, issue of every row that fails a check.

    rows: id, category, tags array<string>, summary; categories: category, the allowed ones, a table of fixed size. A
    null category passes; null or empty tags, an overlong tag, a null or too short or long summary, and the first marker
    of a model's refusal (in any case) fail. A row fails each check at most once.
    """
    allowed = F.broadcast(categories.select("category").distinct().withColumn("_ok", F.lit(True)))
    rows = rows.join(allowed, "category", "left")
    n = F.length("summary")
    marker = F
    for m in markers:
        marker = marker.when(F.contains(F.lower("summary"), F.lit(m.lower())), F.lit(m))
    checks = {
        "category": F.when(F.col("category").isNotNull() & F.col("_ok").isNull(), F.concat(F.lit("unknown category "), "category")),
        "tags": F.when(F.coalesce(F.size("tags"), F.lit(0)) < 1, "no tags").when(F.exists("tags", lambda t: F.length(t) > longest_tag), "tag too long"),
        "summary": F.when(F.col("summary").isNull(), "no summary").when(n < shortest, "too short").when(n > longest, "too long"),
        "refusal": marker.otherwise(F.lit(None).cast("string")),
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("check"), v.alias("issue")) for k, v in checks.items()])
    return rows.select("id", F.explode(F.filter(pairs, lambda p: p["issue"].isNotNull())).alias("p")).select("id", "p.check", "p.issue")


def verdict(rows: DataFrame, failed: DataFrame, least_tags: int = 100, least_enriched: int = 1500) -> DataFrame:
    """One row a check: check, failed (rows), passed. Beside the checks of failures: tag_total and enriched_total, of columns tags and is_enriched."""
    names = ("category", "tags", "summary", "refusal")
    counts = failed.groupBy("check").agg(F.count("*").alias("failed"))
    listed = rows.sparkSession.createDataFrame([(n,) for n in names], "check string").join(counts, "check", "left").select("check", F.coalesce("failed", F.lit(0)).cast("long").alias("failed"))
    one = rows.agg(F.coalesce(F.sum(F.greatest(F.size("tags"), F.lit(0))), F.lit(0)).alias("t"), F.count_if("is_enriched").alias("e"))
    totals = one.select(F.explode(F.array(F.struct(F.lit("tag_total").alias("check"), F.greatest(F.lit(least_tags) - F.col("t"), F.lit(0)).cast("long").alias("failed")), F.struct(F.lit("enriched_total").alias("check"), F.greatest(F.lit(least_enriched) - F.col("e"), F.lit(0)).cast("long").alias("failed")))).alias("s")).select("s.*")
    return reduce(DataFrame.unionByName, [listed, totals]).withColumn("passed", F.col("failed") == 0)


def overall(verdicts: DataFrame) -> DataFrame:
    """One row: passed (all checks did) and exit_code, 0 or 1; a probe that couldn't run ends with 2, which its caller sets."""
    return verdicts.agg(F.coalesce(F.every("passed"), F.lit(True)).alias("passed")).withColumn("exit_code", F.when(F.col("passed"), 0).otherwise(1))


def missing_dates(rows: DataFrame, *columns: str) -> DataFrame:
    """Forks (column is_fork) that lack one of the dates."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return rows.where(F.coalesce("is_fork", F.lit(False)) & missing)


def orphans(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges (source, target, ...) an end of which isn't among ids (column id)."""
    known = ids.select("id").distinct()
    both = edges.join(known.withColumnRenamed("id", "source"), "source", "left_semi").join(known.withColumnRenamed("id", "target"), "target", "left_semi")
    return edges.join(both.select("source", "target").distinct(), ["source", "target"], "left_anti")


def uncovered(ids: DataFrame, **parts: DataFrame) -> DataFrame:
    """One row: repos, and for each part (column id) how many of ids (column id, unique) it lacks."""
    rows = ids.select("id")
    for name, part in parts.items():
        rows = rows.join(part.where("id is not null").select("id").distinct().withColumn(f"_{name}", F.lit(True)), "id", "left")
    return rows.agg(F.count("*").alias("repos"), *[F.count_if(F.col(f"_{name}").isNull()).alias(f"no_{name}") for name in parts])
