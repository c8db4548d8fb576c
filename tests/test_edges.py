import itertools
import random
import time

import pytest
from harness import rows

from quarrylight.operators import edges, knn
from quarrylight.plans import repository


def tagged(spark, *lists):
    return spark.createDataFrame([(f"n{k:02d}", list(x) if x is not None else None) for k, x in enumerate(lists)], "id string, tags array<string>")


@pytest.mark.parametrize(
    "lists, confidence",
    [
        ([["RAG", "Python"], ["RAG", "TypeScript"]], None),
        ([["RAG", "Vector Database", "Python"], ["rag", "vector database", "TypeScript"]], 0.4),
        ([list("abcdefg"), list("abcdefg")], 0.85),
        ([None, [], ["a", None, " "]], None),
    ],
)
def test_compatible(spark, lists, confidence):
    found = edges.compatible_edges(tagged(spark, *lists)).collect()
    assert [r["confidence"] for r in found] == ([] if confidence is None else [confidence])


def test_compatible_against_all_pairs(spark):
    random.seed(3)
    sets = {f"n{k:03d}": frozenset(random.choices("abcdefghijkl", weights=range(1, 13), k=random.randint(0, 8))) for k in range(60)}
    pairs = {(a, b): len(sets[a] & sets[b]) / max(len(sets[a]), len(sets[b])) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= 2}
    kept = set()
    for n in sets:
        kept |= set(sorted((p for p in pairs if n in p), key=lambda p: (-pairs[p], p))[:5])
    df = spark.createDataFrame([(k, sorted(v)) for k, v in sets.items()], "id string, tags array<string>")
    found = edges.compatible_edges(df, most=5).collect()
    assert {(r["source"], r["target"]): r["weight"] for r in found} == {p: pairs[p] for p in kept}


@pytest.mark.parametrize("block, wide", [(500_000, 0), (7, 0), (7, 70)])
def test_compatible_of_copies_blocks_and_wide_lists(spark, monkeypatch, block, wide):
    monkeypatch.setattr(edges, "MEMBERS", 3)
    random.seed(5)
    lists = [frozenset(random.choices("abcdefghijkl", weights=range(1, 13), k=random.randint(0, 8))) for _ in range(30)] + [frozenset(f"t{k:02d}" for k in range(wide - d)) for d in range(3)]
    sets = {f"n{k:03d}": lists[k % len(lists)] for k in range(4 * len(lists))} | {f"m{k}": frozenset("ab") for k in range(9)}
    pairs = {(a, b): len(sets[a] & sets[b]) / max(len(sets[a]), len(sets[b])) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= 2}
    kept = set()
    for n in sets:
        kept |= set(sorted((p for p in pairs if n in p), key=lambda p: (-pairs[p], p))[:5])
    df = spark.createDataFrame([(k, sorted(v)) for k, v in sets.items()], "id string, tags array<string>")
    found = edges.compatible_edges(df, most=5, block=block).collect()
    assert sorted((r["source"], r["target"]) for r in found) == sorted(kept)
    for r in found:
        a, b = sets[r["source"]], sets[r["target"]]
        assert (r["shared_tags"], r["shared_count"], r["weight"]) == (sorted(a & b), len(a & b), pairs[r["source"], r["target"]])


def test_hot_tags_write_no_pairs(spark):
    executors = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(False)
    written = lambda: sum(e.apply(k).totalShuffleWrite() for e in [executors()] for k in range(e.size()))
    n = 4200
    df = spark.createDataFrame([(f"n{k:05d}", ["hot", "warm", f"a{k % 61}", f"b{k % 53}"]) for k in range(n)], "id string, tags array<string>").localCheckpoint()
    before = written()
    assert edges.compatible_edges(df).where("shared_count >= 2").count() > 15 * n
    time.sleep(0.5)  # the figures are kept by a listener
    assert 0 < (written() - before) / n < 800  # bytes a repo


def test_alternatives_keep_what_either_end_keeps(spark):
    nodes = [f"n{k:03d}" for k in range(40)]
    df = spark.createDataFrame([(n, "x") for n in nodes] + [("z", None), ("solo", "y")], "id string, category string")
    pairs = list(itertools.combinations(nodes, 2))
    kept = set()
    for n in nodes:
        kept |= set([p for p in pairs if n in p][:7])
    assert {(r["source"], r["target"]) for r in edges.alternative_edges(df, most=7).collect()} == kept


def test_keyword_groups_match_within_words(spark):
    df = spark.createDataFrame([("a", "We provide things"), ("b", "An IDE"), ("c", "nothing"), ("d", None)], "id string, problem string")
    groups = {"editor": ["ide"], "none": ["thing"]}
    found = edges.keyword_alternatives(df, groups).collect()
    assert [(r["source"], r["target"], r["category"], r["confidence"]) for r in found] == [("a", "b", "editor", 0.4)]
    assert edges.keyword_alternatives(df, groups, None).count() == 1


def test_keyword_classes_stand_for_all_pairs(spark):
    described = [(f"n{k:03d}", ["an IDE", "a queue"][k % 3 == 0]) for k in range(130)] + [("solo", "a shard"), ("none", "nothing"), ("null", None), (None, "an IDE")]
    df = spark.createDataFrame(described, "id string, problem string")
    groups = {"editor": ["ide"], "queue": ["queue"], "shard": ["shard"]}
    found = edges.keyword_classes(df, groups).collect()
    ids = {c: sorted(r["id"] for r in found if r["category"] == c) for c in groups}
    pairs = {p for c in groups for p in itertools.combinations(ids[c], 2)}
    assert pairs == {(r["source"], r["target"]) for r in edges.keyword_alternatives(df, groups, None).collect()}
    assert sum(r["links"] for r in found) == 2 * len(pairs) and not ids["shard"]
    assert {(r["weight"], r["confidence"]) for r in found} == {(0.7, 0.4)}


def test_registered_keyword_classes_hold_every_pair(spark, tmp_path):
    n = 70
    spark.createDataFrame([(f"n{k:03d}", "a queue") for k in range(n)], "repo_id string, problem_solved string").write.parquet(f"{tmp_path}/enrichment_result.parquet")
    found = repository.QUERIES["alternative_keyword_classes"](spark, str(tmp_path)).collect()
    assert {r["id"] for r in found} == {f"n{k:03d}" for k in range(n)} and {(r["category"], r["links"]) for r in found} == {("queue", n - 1)}


def test_depends_on(spark):
    deps = spark.createDataFrame([("app", "My-Lib", "pypi", True), ("app", "my_lib", "npm", True), ("lib", "mylib", "pypi", True), ("x", "__none__", "s", False), ("y", "mylib", "pypi", False)], "id string, package string, ecosystem string, is_direct boolean")
    repos = spark.createDataFrame([("lib", "my-lib"), ("app", "my-app"), ("e", "")], "id string, name string")
    assert [tuple(r) for r in edges.depends_on_edges(deps, repos).collect()] == [("app", "lib", "My-Lib", "pypi", 1.0, 0.95)]
    assert edges.depends_on_edges(deps.limit(0), repos).count() == 0


@pytest.mark.parametrize("n, count", [(1, 0), (2, 1), (3, 3), (30, 390), (31, 0)])
def test_extends(spark, n, count):
    df = spark.createDataFrame([(f"n{k:02d}", ["Org/x", "org/y"][k % 2]) for k in range(n)] + [("p", None), ("q", "noslash")], "id string, forked_from string")
    found = edges.extends_edges(df).collect()
    assert len(found) == count
    assert all(abs(r["weight"] - 1 / (n - 1)) < 1e-9 and r["owner"] == "org" for r in found)


def test_typed_edges_in_order_and_uncapped(spark):
    many = [("a", "b", "ALTERNATIVE_TO", k / 2000, 0.7) for k in range(1200)] + [("b", "c", "DEPENDS_ON", None if k else 0.9, 0.9) for k in range(60)] + [("a", "zz", "EXTENDS", 1.0, 0.6)]
    df = spark.createDataFrame(many, "source string, target string, edge_type string, weight double, confidence double")
    found = edges.typed_edges(df, spark.createDataFrame([("a",), ("b",), ("c",)], "id string")).collect()
    assert len(found) == 1260
    assert [r["edge_type"] for r in found[:60]] == ["DEPENDS_ON"] * 60 and found[0]["weight"] == 0.9 and found[1]["weight"] == 0.5


@pytest.mark.parametrize(
    "before, after, verdict",
    [
        ({"A": 500, "B": 300, "DEPENDS_ON": 200}, {"A": 480, "B": 290, "DEPENDS_ON": 195}, "pass"),
        ({"A": 500, "B": 300, "DEPENDS_ON": 200}, {"A": 500, "B": 300}, "abort"),
        ({"A": 1000}, {"A": 499}, "abort"),
        ({"A": 1000}, {"A": 700}, "warn"),
        ({"A": 1000, "B": 99}, {"A": 1000}, "pass"),
        ({}, {"A": 5}, "pass"),
        ({}, {}, "pass"),
    ],
)
def test_gate(spark, before, after, verdict):
    make = lambda d: spark.createDataFrame(list(d.items()), "edge_type string, edges long")
    assert edges.regression_gate(make(before), make(after)).first()["verdict"] == verdict


def test_neighbours(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None)], "id long, v array<float>")
    found = {(r["source"], r["target"]) for r in knn.similarity_edges(df, k=2, least=0.9).collect()}
    assert found == {(1, 2), (2, 1), (3, 2)}
    whole, blocks = (rows(knn.neighbours(df, df, 2, block=b)) for b in (100, 1))
    assert whole == blocks
    assert knn.neighbours(df.limit(0), df, 2).count() == 0
