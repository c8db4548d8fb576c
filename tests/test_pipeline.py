import datetime

import pytest
from harness import rows
from pyspark.sql import functions as F

from quarrylight.functions import budget, scores, text
from quarrylight.operators import edges, quality, runs, trends, vocabulary
from quarrylight.streaming import posting


@pytest.mark.parametrize(
    "url, clean",
    [
        ("postgresql+asyncpg://u:p@h:1/d?ssl=require", "postgresql://u:p@h:1/d?sslmode=require"),
        ("postgresql+psycopg://h/d?ssl=0&a=b", "postgresql://h/d?a=b&sslmode=disable"),
        ("postgresql://h/d?sslmode=prefer&ssl=true", "postgresql://h/d?sslmode=prefer"),
        ("postgresql://h/d", "postgresql://h/d"),
    ],
)
def test_database_url(url, clean):
    assert budget.database_url(url) == clean


def test_budget(spark):
    got = spark.createDataFrame([("quick", 5), ("weekly", 90), ("full", 10), ("fix", 10)], "m string, n long").select("m", budget.estimated_calls(F.col("m"), F.col("n")))
    assert dict(map(tuple, got.collect())) == {"quick": 10, "weekly": 7 + 27 + 180 + 30, "full": 57, "fix": 7}
    got = spark.createDataFrame([(None, 9), (200, 100), (150, 100), (99, 1)], "a long, w long").select(budget.decision(F.col("a"), F.col("w")))
    assert [r[0] for r in got.collect()] == ["ok", "ok", "warn", "wait"]


def test_posting(spark):
    def service(batch):
        if batch[0]["n"] >= 900:
            raise ValueError("down")
        return (401, "no") if batch[0]["n"] >= 800 else (200, "")

    sent = posting.posted(spark.range(100).coalesce(1).withColumnRenamed("id", "n"), service, pause=0.0)
    assert rows(sent.select("upserted", "status", "attempts")) == [(50, 200, 1)] * 2
    sent = posting.posted(spark.createDataFrame([(800,), (900,)], "n long").repartition(2, "n"), service, size=1, pause=0.0)
    assert rows(sent) == [(0, 0, 3, "down"), (0, 401, 1, "no")]
    assert rows(posting.totals(sent)) == [(0, 2, 2)] and rows(posting.totals(sent.limit(0))) == [(0, 0, 0)]


def test_runs(spark):
    at = [datetime.datetime(2025, 1, d) for d in range(1, 9)]
    log = [(1, 1, "running", at[0], None, None, None), (1, 2, "running", at[1], "c", None, None), (1, 3, "success", at[2], None, {"EXTENDS": 4}, None)]
    log += [(2, 1, "running", at[3], None, None, None), (2, 2, "failed", at[4], None, None, "e"), (3, 1, "running", at[5], None, None, None), (3, 2, "running", at[6], "d", None, None), (4, 1, "running", at[7], None, None, None)]
    now = runs.current(spark.createDataFrame(log, runs.SCHEMA))
    assert rows(now.select("run", "status", "checkpoint", "error")) == [(1, "success", None, None), (2, "failed", None, "e"), (3, "running", "d", None), (4, "running", None, None)]
    assert rows(runs.crashed(now)) == [(3, "d")] and rows(runs.prior_counts(now)) == [("EXTENDS", 4)]
    assert runs.crashed(now.where("run < 3")).count() == 0


def test_small_columns(spark):
    one = spark.createDataFrame([('{"overall": 0.123456}',), ('{"overall": "x"}',), ("[",), (None,)], "q string").select(scores.quality_overall(F.col("q")))
    assert [r[0] for r in one.collect()] == [0.1235, None, None, None]
    one = spark.createDataFrame([("a, b  c,,",), (" ",), (None,)], "n string").select(text.listed_names(F.col("n")))
    assert [r[0] for r in one.collect()] == [["a", "b", "c"], [], []]
    paths = spark.createDataFrame([(["Test_x"],), ([".GitHub", "contest"],), ([".github"],), (None,)], "p array<string>")
    assert [tuple(r) for r in paths.select(text.has_tests(F.col("p")), text.has_ci(F.col("p"))).collect()] == [(True, False), (False, False), (False, True), (False, False)]


def test_overall_and_uncovered(spark):
    verdicts = spark.createDataFrame([("a", True), ("b", False)], "check string, passed boolean")
    assert rows(quality.overall(verdicts)) == [(False, 1)] and rows(quality.overall(verdicts.where("passed"))) == [(True, 0)]
    ids = spark.createDataFrame([("x",), ("y",)], "id string")
    assert rows(quality.uncovered(ids, tags=ids.where("id = 'x'").union(ids), dates=ids.limit(0))) == [(2, 0, 2)]


def test_trend_snapshot(spark):
    data = [("1", ["b", "a", "a"], ["X"], None), ("2", ["b", "Active"], None, None), ("3", None, ["Y", ""], None)]
    one = trends.snapshot(spark.createDataFrame(data, "id string, tags array<string>, categories array<string>, updated timestamp_ntz"), F.lit("2025-01-01").cast("timestamp_ntz"), tags=2).first()
    assert one["top_tags"] == ["b", "Active"] and one["tag_counts"] == {"a": 1, "b": 2, "Active": 1} and one["category_counts"] == {"X": 1, "Y": 1} and one["active_repos"] == 1
    assert trends.snapshot(spark.createDataFrame([], "id string, tags array<string>, categories array<string>, updated timestamp_ntz"), F.lit("2025-01-01").cast("timestamp_ntz")).first()["top_tags"] == []


def test_depends_on_upstream_names(spark):
    repos = spark.createDataFrame([("1", "mine", "up/My_Lib"), ("2", "app", None)], "id string, name string, forked_from string")
    deps = spark.createDataFrame([("2", "my-lib", "pypi", True), ("2", "mine", "pypi", True)], "id string, package string, ecosystem string, is_direct boolean")
    assert [(r["source"], r["target"], r["package"]) for r in edges.depends_on_edges(deps, repos).collect()] == [("2", "1", "my-lib")]


def test_canonical_tags_like_the_library(spark):
    import difflib
    import random

    random.seed(3)
    names = sorted({"".join(random.choices("abcde", k=random.randint(3, 9))) for _ in range(60)})
    raw = ["".join(random.choices("abcde", k=random.randint(2, 10))) for _ in range(150)]
    got = dict(map(tuple, vocabulary.canonical_tags(spark.createDataFrame([(r,) for r in raw], "tag string"), names).collect()))
    assert got == {r: r if r in names else next(iter(difflib.get_close_matches(r, names, n=1, cutoff=0.82)), None) for r in raw}
