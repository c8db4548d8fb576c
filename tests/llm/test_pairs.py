"""Near-duplicate texts and similar sets against all pairs, by brute force."""

import itertools
import random

import numpy as np
import pytest
from harness import DATA, compare, rows
from pyspark.sql import functions as F

from quarrylight.llm import chosen_path, hashing, oracle, queries
from quarrylight.llm import near_duplicates as near_duplicates_module
from quarrylight.llm.chosen_path import Forest
from quarrylight.llm.near_duplicates import near_duplicates
from quarrylight.llm.set_join import gathered, similar_sets
from quarrylight.storage import materialize

WORDS = [f"w{k}" for k in range(4000)]


def grams(text, n):
    words = hashing.words_of(text)
    return set(zip(*(words[k:] for k in range(n))))


def edited(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


@pytest.mark.parametrize("forest", [None, Forest(0.6, leaf_rows=3, block_rows=4), Forest(0.6, leaf_rows=2, dense_share=2.0, deepest=3, block_rows=3)])
def test_near_duplicates_against_all_pairs(spark, forest):
    rng = random.Random(5)
    stock = " ".join(rng.choices(WORDS, k=30))
    texts = []
    for k in range(60):
        base = " ".join(rng.choices(WORDS, k=50)) + (" " + stock if k % 2 else "")
        texts += [base, *[edited(rng, base, rng.choice([1, 3, 5])) for _ in range(rng.randrange(4))]]
    texts += [texts[0], texts[0].upper(), texts[5], "", "  ", "one two three", None]
    keys = [f"k{k:03d}" for k in range(len(texts))]
    want = set()
    for (a, x), (b, y) in itertools.combinations(zip(keys, texts), 2):
        if x and y and len(x.split()) >= 20 and len(y.split()) >= 20:
            p, q = grams(x, 3), grams(y, 3)
            if len(p & q) >= 0.6 * len(p | q):
                want.add((0, a, b))
    df = spark.createDataFrame(list(zip(keys, texts)), "key string, text string")
    df = df.union(df.limit(20)).select(F.lit(0).alias("grp"), "key", "text", F.lit(1).alias("rid"), F.lit("x").alias("sig"))
    found = near_duplicates(df, 3, 0.6, 20, forest)
    assert set(rows(found.key_pairs())) == want and len(want) > 40
    links = {r["key"]: r["links"] for r in found.classes().collect()}
    assert len(links) == len([t for t in texts if t and len(t.split()) >= 20]) and max(links.values()) > 0


def test_few_texts_are_compared_that_are_not_near(spark, monkeypatch):
    """Texts that share a template, at a similarity of 0.27, meet in the leaves, but wide sketches tell them apart before their words are read."""
    rng = random.Random(11)
    stock = " ".join(rng.choices(WORDS, k=60))
    texts = [" ".join(rng.choices(WORDS, k=80)) + " " + stock for _ in range(120)]
    texts += [edited(rng, t, 4) for t in texts[:40]]
    met = {}
    monkeypatch.setattr(near_duplicates_module, "materialize", lambda df, label: met.setdefault(label, materialize(df, label)))
    found = near_duplicates(spark.createDataFrame([(0, f"k{k:03d}", t) for k, t in enumerate(texts)], "grp int, key string, text string"), 3, 0.6, 20)
    near = {(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if len((p := grams(texts[a], 3)) & (q := grams(texts[b], 3))) >= 0.6 * len(p | q)}
    assert {(int(r["key_a"][1:]), int(r["key_b"][1:])) for r in found.key_pairs().collect()} == near and len(near) >= 40
    assert met["met"].count() < 2 * len(near)


def test_minima_of_long_and_short_runs(monkeypatch):
    rng = np.random.default_rng(3)
    lengths = np.array([1, 5, 70, 2, 1, 64, 3])
    values, starts = rng.integers(0, 1 << 63, lengths.sum()).astype(np.uint64), np.cumsum(lengths) - lengths
    whole = hashing.minwise(values, starts, 8)
    monkeypatch.setattr(hashing, "CACHED", 16)
    assert (hashing.minwise(values, starts, 8) == whole).all()
    assert (whole == np.concatenate([hashing.minwise(values[a : a + n], np.array([0]), 8) for a, n in zip(starts, lengths)])).all()


def test_dense_groups_are_whole(spark):
    """A third of the texts resemble each other: their node is compared in blocks."""
    rng = random.Random(7)
    base = " ".join(rng.choices(WORDS, k=120))
    near = [edited(rng, base, 1) for _ in range(60)]
    other = [" ".join(rng.choices(WORDS, k=40)) for _ in range(120)]
    df = spark.createDataFrame([(0, f"k{k}", t) for k, t in enumerate(near + other)], "grp int, key string, text string")
    found = near_duplicates(df, 5, 0.8, forest=Forest(0.8, leaf_rows=8, block_rows=16)).key_pairs()
    assert found.count() == sum(len(grams(a, 5) & grams(b, 5)) >= 0.8 * len(grams(a, 5) | grams(b, 5)) for a, b in itertools.combinations(near, 2))


def test_no_texts(spark):
    empty = spark.createDataFrame([], "grp int, key string, text string")
    found = near_duplicates(empty)
    assert found.key_pairs().count() == 0 and found.classes().count() == 0
    short = spark.createDataFrame([(0, "a", "too short"), (0, "b", "too short"), (0, "c", None)], "grp int, key string, text string")
    assert near_duplicates(short).key_pairs().count() == 0


def test_very_long_and_repetitive_texts(spark):
    long = " ".join(random.Random(1).choices(WORDS, k=100_000))
    df = spark.createDataFrame([(0, "a", long), (0, "b", long + " end"), (0, "c", "x " * 50_000), (0, "d", "x " * 60_000), (1, "a", long)], "grp int, key string, text string")
    assert rows(near_duplicates(df).key_pairs()) == [(0, "a", "b"), (0, "c", "d")]


@pytest.mark.parametrize("forest", [None, Forest(0.75, branches=4, leaf_rows=4, block_rows=8)])
def test_similar_sets_against_all_pairs(spark, forest):
    rng = random.Random(11)
    data = []
    for k in range(80):
        base = set(rng.choices(range(200), weights=[1000 // (w + 1) + 1 for w in range(200)], k=rng.randrange(1, 25)))
        data.append(base)
        for _ in range(rng.randrange(3)):
            data.append(set(base) ^ set(rng.choices(range(200), k=rng.randrange(3))))
    sets = [(0, int(rng.random() < 0.2), f"k{k:03d}", sorted(s)) for k, s in enumerate(data)]
    want = set()
    for (_, s, a, x), (_, t, b, y) in itertools.combinations(sets, 2):
        x, y = set(x), set(y)
        if len(x) >= 6 and len(y) >= 6 and not (s and t) and 4 * len(x & y) >= 3 * len(x | y):
            want.add((0, s | t, a, b))
    df = spark.createDataFrame([*sets, (0, 0, None, [1, 2, 3, 4, 5, 6]), (0, 0, "n", None), (0, 0, "e", [])], "grp int, side int, key string, tokens array<long>")
    df = df.unionByName(df).withColumn("tokens", F.concat("tokens", F.array(F.lit(None).cast("long")))).withColumn("rid", F.lit("clash"))
    found = similar_sets(df, 3, 4, 6, forest)
    assert set(rows(found.key_pairs())) == want and len(want) > 30
    assert sum(r["links"] for r in found.classes().dropDuplicates(["grp", "side", "rid"]).collect()) == 2 * found.pairs.count()


@pytest.mark.parametrize("large, chunk", [(1000, 1000), (10, 4), (0, 1000)])
def test_sets_too_large_for_a_row(spark, large, chunk):
    rng = random.Random(12)
    base = [set(rng.choices(range(500), k=rng.randrange(6, 20))) for _ in range(30)]
    sets = {f"k{k:02d}": s for k, s in enumerate([*base, *[s | {1000 + k} for k, s in enumerate(base)], base[0], base[1]])}
    want = {(0, 0, a, b) for (a, x), (b, y) in itertools.combinations(sorted(sets.items()), 2) if len(x) >= 6 and len(y) >= 6 and 4 * len(x & y) >= 3 * len(x | y)}
    df = spark.createDataFrame([(0, 0, k, t) for k, s in sets.items() for t in [*s, min(s)]], "grp int, side int, key string, token long")
    small, rest = gathered(df, large)
    assert (rest is None) == (large == 1000)
    found = similar_sets(small, 3, 4, 6, large=rest, chunk=chunk)
    assert set(rows(found.key_pairs())) == want and len(want) > 25
    assert {r["key"] for r in found.classes().collect()} == {k for k, s in sets.items() if len(s) >= 6}


def test_no_sets(spark):
    empty = spark.createDataFrame([], "grp int, side int, key string, tokens array<long>")
    assert similar_sets(empty).key_pairs().count() == 0


def test_recall_is_what_the_trees_promise():
    for threshold in (0.5, 0.6, 0.75, 0.9):
        forest = Forest(threshold)
        assert 1 - (1 - forest.met()) ** forest.trees >= forest.target_recall
    assert Forest(0.6).least_nibbles() <= 12


@pytest.mark.parametrize("threshold, branches", [(0.6, 5), (0.75, 4)])
def test_recall_with_shared_coordinates(threshold, branches):
    forest, rng, n = Forest(threshold, branches=branches), random.Random(8), chosen_path.COORDINATES

    def met(agree, level):
        if level == 3:
            return True
        start, step = rng.randrange(n), rng.randrange(1, n, 2)
        return any(agree[(start + step * j) % n] and met(agree, level + 1) for j in range(forest.deeper))

    found, trials = 0, 20_000
    for _ in range(trials):
        agree = [rng.random() < threshold for _ in range(n)]
        found += any(agree[r % n] and met(agree, 1) for r in range(forest.trees * branches))
    assert found / trials >= forest.target_recall - 0.001


def test_nodes_differ_between_trees(spark):
    records = spark.createDataFrame([(0, list(range(chosen_path.COORDINATES)))], "grp int, sig array<int>")
    nodes = [r["node"] for r in chosen_path._roots(records, Forest(0.6)).collect()]
    assert len(set(nodes)) == len(nodes) == Forest(0.6).trees * Forest(0.6).branches


@pytest.mark.parametrize("name", oracle.oracle_sql())
def test_same_rows_as_sql(spark, name):
    compare(spark, queries.queries()[name], oracle.oracle_sql()[name])


@pytest.mark.parametrize("name", queries.queries())
def test_rows_are_distinct(spark, name):
    df = queries.queries()[name](spark, DATA)
    assert df.count() == df.distinct().count() > 0
