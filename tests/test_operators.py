import pytest
from harness import rows
from pyspark.sql import functions as F

from quarrylight.operators import manifests, merging, quality, trends, vocabulary
from quarrylight.sources import landing

FILES = {
    "requirements.txt": ("numpy>=1.24\npandas==2.0.0\r\ntorch\nRequests>=2.28,<3.0\n# note\n-e .\n\nruamel.yaml\n", ["numpy", "pandas", "torch", "requests", "ruamel"]),
    "pyproject.toml": ('[project]\nname = "x"\ndependencies = [\n  "Httpx>=1",\n  \'rich\',\n]\n[tool]\na = "b"\n', ["httpx", "rich"]),
    "sub/pyproject.toml": ('dependencies = ["a-b>1", "c"]\n"d"\n', ["a-b", "c"]),
    "package.json": ('{"dependencies": {"b": "1", "A": "2"}, "devDependencies": {"b": "1"}, "peerDependencies": {"c": "*"}, "x": 1}', ["A", "b", "c"]),
    "setup.py": ('setup(install_requires=["One>=1", \'two\'], extras=["x"])', ["one", "two"]),
    "go.mod": ("module m\nrequire (\n\tgithub.com/a/B v1 // indirect\n\t// note\n)\nrequire x.y/z v2\n", ["github.com/a/B", "x.y/z"]),
    "Cargo.toml": ('[package]\nname = "p"\n[dependencies]\nserde = "1"\n# c = 1\n[features]\nf = []\n[dev-dependencies]\nrand = "2"\n', ["serde", "rand"]),
    "other.txt": ("numpy", []),
}


def test_manifests(spark):
    df = spark.createDataFrame([(k, c) for k, (c, _) in FILES.items()] + [("package.json", "{oops"), ("go.mod", None), ("setup.py", "")], "file string, content string")
    got = [r["packages"] for r in manifests.packages(df).collect()]
    assert got == [p for _, p in FILES.values()] + [[], [], []]


def test_chosen_manifest(spark):
    df = spark.createDataFrame([("a", False, "requirements.txt", "own"), ("a", True, "package.json", '{"dependencies": {"up": "1"}}'), ("a", True, "requirements.txt", "# empty"), ("b", False, "setup.py", "nothing")], "id string, upstream boolean, file string, content string")
    assert rows(manifests.chosen_packages(df).select("id", "package", "ecosystem", "is_direct")) == [("a", "up", "npm", True), ("b", "__none__", "__sentinel__", False)]


def test_merging(spark):
    old = spark.createDataFrame([("a", "1", 0.5), ("b", "2", 0.3)], "k string, v string, w double")
    new = spark.createDataFrame([("a", "9", 0.9), ("c", "", None)], "k string, v string, w double")
    assert rows(merging.upsert(old, new, ["k"])) == [("a", "9", 0.9), ("b", "2", 0.3), ("c", "", None)]
    assert rows(merging.fill(old, new.withColumn("v", F.lit("")), ["k"], ["v", "w"])) == [("a", "1", 0.9), ("b", "2", 0.3)]
    assert rows(merging.insert_missing(old, new.union(new), ["k"], F.col("v"))) == [("a", "1", 0.5), ("b", "2", 0.3), ("c", "", None)]
    assert rows(merging.replace_groups(old, new, ["k"])) == [("a", "9", 0.9), ("b", "2", 0.3), ("c", "", None)]
    assert rows(merging.versions(old.union(new), "k", "w").where("is_current").select("k", "v")) == [("a", "9"), ("b", "2"), ("c", "")]
    assert rows(merging.expire(new, F.col("w"), F.lit(1.0))) == [("c", "", None)]
    assert rows(merging.upsert(old.limit(0), new, ["k"])) == rows(new)


def test_swap(spark):
    shape = "source string, target string, edge_type string, weight double, confidence double, created_at timestamp_ntz"
    live = spark.createDataFrame([("a", "b", "DEPENDS_ON", 1.0, 0.9, None), ("a", "z", "MAINTAINED_BY", 1.0, 0.9, None)], shape)
    staged = spark.createDataFrame([("a", "c", "DEPENDS_ON", 1.0, 0.9, None)], shape)
    now, history = merging.swap(live, staged, ["DEPENDS_ON"], 3, F.lit("2026-01-01").cast("timestamp_ntz"))
    assert [r[1] for r in rows(now)] == ["c", "z"] and [(r["target"], r["run"]) for r in history.collect()] == [("b", 3)]


@pytest.mark.parametrize(
    "category, tags, summary, failed",
    [
        ("ok", ["t"], "s" * 60, []),
        (None, ["t"], "s" * 2000, []),
        ("bogus", [], None, ["category", "summary", "tags"]),
        ("ok", ["x" * 51], "s" * 2001, ["summary", "tags"]),
        ("ok", None, "i CANNOT do that, as an AI I don't have access to this file", ["refusal", "tags"]),
        ("ok", ["t"], "ss", ["summary"]),
    ],
)
def test_quality(spark, category, tags, summary, failed):
    df = spark.createDataFrame([("r", category, tags, summary)], "id string, category string, tags array<string>, summary string")
    found = quality.failures(df, spark.createDataFrame([("ok",)], "category string"))
    assert sorted(r["check"] for r in found.collect()) == failed
    checks = quality.verdict(df.withColumn("is_enriched", F.lit(True)), found, least_tags=1, least_enriched=1)
    assert checks.count() == 6 and {r["check"] for r in checks.where("not passed and check not like '%_total'").collect()} == set(failed)


def test_sample(spark):
    df = spark.createDataFrame([(k, k * 10 if k else None) for k in range(6)], "id int, updated int")
    got = quality.fresh_sample(df, 3, F.lit(45)).collect()
    assert [(r["id"], r["is_fresh"]) for r in got] == [(5, True), (4, False), (3, False)]


def test_gaps(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 6), ("c", 9), ("d", 20)], "item string, repos long")
    expected = spark.createDataFrame([(1, "c", 10), (2, "b", 10), (3, "a", 10), (4, "d", 10), (5, "e", 4)], "ord int, category string, expected int")
    got = trends.gaps(counts, expected).collect()
    assert [(r["category"], r["severity"], r["repo_count"]) for r in got] == [("a", "high", 1), ("e", "high", 0), ("b", "medium", 6), ("c", "low", 9)]
    assert got[0]["description"] == "Only 1 repos in a (expected 10+)" and got[0]["suggestion"] == "Add 9 more repos covering a"


def test_frequencies(spark):
    df = spark.createDataFrame([(1, ["a", "a", None]), (2, ["b", "a"]), (3, None)], "id int, tags array<string>")
    assert rows(trends.top(trends.frequencies(df, "tags"), 1)) == [("a", 2)]


def test_canonical(spark):
    raw = spark.createDataFrame([("PYTHON ",), ("langchian",), ("zzz",), ("",), (None,), ("PYTHON ",)], "tag string")
    got = dict(map(tuple, vocabulary.canonical_tags(raw, ["Python", "LangChain"]).collect()))
    assert got == {"PYTHON ": "Python", "langchian": "LangChain", "zzz": None, "": None}


def test_landing(spark):
    repos = spark.createDataFrame([("o/a", True, "p/x", "NOASSERTION", None, "u", "c", False), ("o/b", True, None, "MIT", "p", "u", "c", None), ("o/c", False, None, None, "p", "u", "c", True)], "full_name string, is_fork boolean, forked_from string, license_spdx string, pushed_at string, updated_at string, created_at string, is_private boolean")
    got = landing.listing(repos).select("full_name", "license_spdx", "pushed_at", "forked_at")
    assert rows(got) == [("o/a", None, "u", "c"), ("o/b", "MIT", "p", "c")]
    parents = spark.createDataFrame([("o/b", "q/b"), ("o/c", "q/c")], "full_name string, forked_from string")
    assert [r["forked_from"] for r in landing.with_parents(repos, parents).orderBy("full_name").collect()] == ["p/x", "q/b", None]
    coded = spark.createDataFrame([("aGVs\nbG8=",), (None,)], "c string").select(landing.decoded_file(F.col("c")))
    assert [r[0] for r in coded.collect()] == ["hello", None]
    log = spark.createDataFrame([("r", '[{"sha": "0123456789", "message": "first\\nsecond", "committed_at": "t"}]'), ("s", None)], "id string, c string")
    assert rows(landing.commits(log, "id", "c")) == [("r", "01234567", "first", "t")]


def test_library_file(spark, tmp_path):
    (tmp_path / "library.json").write_text('{\n"items": [\n{"name": "a", "tags": ["x"]},\n{"name": "b"}\n]}')
    got = landing.nested(landing.json_files(spark, str(tmp_path), "repos array<struct<name:string>>, items array<struct<name:string>>", multi_line=True), "repos", "items")
    assert rows(got) == [("a",), ("b",)]
