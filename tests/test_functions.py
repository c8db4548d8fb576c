import math

import pytest
from pyspark.sql import functions as F

from quarrylight.functions import scores, text
from quarrylight.functions.sets import clean_items
from quarrylight.operators import tagging


def one(spark, value, kind, f):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize("word, keyword, hit", [("pytorch is great", "torch", False), ("amalgamate", "game", False), ("a Torch!", "torch", True), ("C++ code", "c++", True), ("torch2", "torch", False), ("Key", "key", True)])
def test_keyword(spark, word, keyword, hit):
    assert one(spark, word, "string", lambda x: x.rlike(text.keyword_pattern([keyword]))) is hit


@pytest.mark.parametrize("name, slug", [("RAG & Retrieval", "rag-and-retrieval"), ("Industry: Healthcare", "industry-healthcare"), (None, None)])
def test_slug(spark, name, slug):
    assert one(spark, name, "string", text.slug) == slug


@pytest.mark.parametrize("readme, summary", [("x" * 34, None), ("# " + "y" * 60, "y" * 60), ("z" * 1200, "z" * 500), ("![image](" + "i" * 80 + ")\n\n\t" + "t" * 50 + " ", "t" * 50), ("", None), (None, None)])
def test_first_paragraph(spark, readme, summary):
    assert one(spark, readme, "string", text.first_paragraph) == summary


@pytest.mark.parametrize("value, parsed", [("2025-01-02T03:04:05Z", "2025-01-02 03:04:05"), ("2025-01-02T03:04:05+02:00", "2025-01-02 01:04:05"), ("02/01/2025", None), ("", None), (None, None), ("2025-13-01", None)])
def test_instant(spark, value, parsed):
    assert one(spark, value, "string", lambda x: text.instant(x).cast("string")) == parsed


@pytest.mark.parametrize("json, items", [('["a", 1, null, "b"]', ["a", "b"]), ("oops", []), ("{}", []), (None, []), ("[]", [])])
def test_string_items(spark, json, items):
    assert one(spark, json, "string", text.string_items) == items


def test_model_reply(spark):
    schema = "struct<a:string>"
    assert one(spark, '```json\n{"a": "x"}\n```', "string", lambda x: text.model_reply(x, schema)).a == "x"


def test_names(spark):
    assert one(spark, "My-Lib_x", "string", text.package_key) == "mylibx"
    assert one(spark, "Owner /repo", "string", text.owner_part) == "owner"
    assert one(spark, "bare", "string", text.owner_part) is None
    assert one(spark, "o/r", "string", text.repo_part) == "r" and one(spark, "r", "string", text.repo_part) == "r"


def test_clean_items(spark):
    assert one(spark, [" A", "a ", None, "  ", "b\t"], "array<string>", clean_items) == ["a", "b"]
    assert one(spark, None, "array<string>", clean_items) is None


@pytest.mark.parametrize("stars, forks, c7, c30, c90, archived", [(0, 0, 0, 0, 0, False), (5000, 300, 4, 20, 30, False), (5000, 0, 9, 9, 9, True), (None, None, None, None, None, None), (10**6, 10**6, 50, 50, 1, False)])
def test_activity(spark, stars, forks, c7, c30, c90, archived):
    df = spark.createDataFrame([(stars, forks, c7, c30, c90, archived)], "s long, f long, a long, b long, c long, x boolean")
    got = df.select(scores.activity_score(*map(F.col, "sfabcx"))).first()[0]
    s, f, a, b, c = (v or 0 for v in (stars, forks, c7, c30, c90))
    live = min(60, b * 3 + a * 5) + min(15, int(math.log2(s + 1) * 2)) + min(15, int(math.log2(f + 1) * 3)) + 10 * (c > 0)
    assert got == (min(10, int(math.log2(s + 1) * 1.5)) if archived else min(100, live))


def test_windows(spark):
    at = F.lit("2026-01-31 00:00:00").cast("timestamp_ntz")
    commits = ["2026-01-30T12:00:00Z", "2026-01-25T00:00:00Z", "2026-01-01T00:00:00Z", "2026-02-03T00:00:00Z", "bad", None]
    df = spark.createDataFrame([(commits,), (None,)], "c array<string>")
    got = df.select(*[c.alias(n) for n, c in scores.commit_windows(F.col("c"), at).items()]).collect()
    assert [tuple(r) for r in got] == [(1, 3, 3, 4), (0, 0, 0, 0)]
    weeks = spark.createDataFrame([([1, 2, 3],), ([1, 2, 3, 4, 5],), ([],)], "w array<long>")
    got = weeks.select(*scores.week_windows(F.col("w")).values()).collect()
    assert [tuple(r) for r in got] == [(3, 0, 0), (5, 14, 0), (0, 0, 0)]


def test_shares_and_states(spark):
    assert one(spark, {"a": 1, "b": 2}, "map<string,long>", scores.shares) == {"a": 33.3, "b": 66.7}
    assert one(spark, {"a": 0}, "map<string,long>", scores.shares) == {}
    df = spark.createDataFrame([(1, 1), (0, 1), (1, 0), (0, 0), (None, 0)], "a int, b int")
    assert [r[0] for r in df.select(scores.sync_state(F.col("a"), F.col("b"))).collect()] == ["diverged", "behind", "ahead", "up-to-date", "unknown"]


def test_meta_tags(spark):
    df = spark.createDataFrame([(5000, "2026-01-20T00:00:00Z", "Rust", ["Vector DB", None], True, True), (999, "2020-01-01T00:00:00Z", None, None, None, None), (None, "bad", "Klingon", [], False, False)], "s int, u string, l string, t array<string>, f boolean, a boolean")
    at = F.lit("2026-01-31").cast("timestamp_ntz")
    got = df.select(tagging.meta_tags(*map(F.col, "sultfa"), at, {"vector-db": "Vectors"})).collect()
    assert [r[0] for r in got] == [["Active", "Archived", "Forked", "Popular", "Rust", "Systems", "Vectors"], ["Built by Me", "Inactive"], ["Built by Me"]]
    assert one(spark, "uses LangChain and chromadb", "string", lambda x: tagging.text_tags(x, {"LangChain": ["langchain"], "Chroma": ["chroma", "chromadb"]})) == ["LangChain", "Chroma"]
    assert one(spark, None, "string", lambda x: tagging.text_tags(x, {"A": ["a"]})) == []


def test_categories_and_builders(spark):
    vocabulary = spark.createDataFrame([(1, "First", "a"), (1, "First", "b"), (2, "Second", "b"), (2, "Second", "c")], "ord int, category string, tag string")
    tagged = spark.createDataFrame([("x", ["b", "c", "c"]), ("y", ["b"]), ("z", ["?"]), ("n", None)], "id string, tags array<string>")
    assert dict(map(tuple, tagging.primary_category(tagged, vocabulary).collect())) == {"x": "Second", "y": "First", "z": "", "n": ""}
    assert dict(map(tuple, tagging.all_categories(tagged, vocabulary).collect())) == {"x": ["First", "Second"], "y": ["First", "Second"], "z": [], "n": []}
    repos = spark.createDataFrame([(1, "me", True, "Big/thing"), (2, "me", False, "Big/thing"), (3, "me", True, None)], "id int, owner string, is_fork boolean, forked_from string")
    orgs = spark.createDataFrame([("big", "big-tech", "Big Inc")], "login string, org_category string, display_name string")
    assert [tuple(r)[1:] for r in tagging.builders(repos, orgs).orderBy("id").collect()] == [("Big", "Big Inc", "big-tech", True), ("me", "me", "individual", False), ("me", "me", "individual", False)]


def test_sentences_levels_and_paths(spark):
    assert one(spark, "A longer sentence. More", "string", text.first_sentence) == "A longer sentence."
    assert one(spark, "Short. More", "string", text.first_sentence) is None
    assert one(spark, " HIGH ", "string", lambda x: text.one_of(x, ["high"], "medium")) == "high"
    assert one(spark, "great", "string", lambda x: text.one_of(x, ["high"], "medium")) == "medium" and one(spark, None, "string", lambda x: text.one_of(x, ["a"])) is None
    assert one(spark, "", "string", lambda x: text.filled(x, F.lit("Agents"), {"Agents": "Bots"}, "Tools")) == "Bots"
    assert one(spark, None, "string", lambda x: text.filled(x, F.lit("?"), {"Agents": "Bots"}, "Tools")) == "Tools"
    has = lambda x: text.has_path(x, ["tests"], "test_", any_case=True)
    assert [one(spark, p, "array<string>", has) for p in (["Tests"], ["TEST_a.py"], ["src"], [None], None)] == [True, True, False, False, False]
    assert one(spark, "a/b/setup.py", "string", text.file_name) == "setup.py"
    assert one(spark, "x", "string", lambda x: text.labelled(("name", x), ("none", F.lit("")), ("null", F.lit(None)))) == "name: x"
