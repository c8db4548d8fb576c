"""Counts of terms, pairs of items and canonical values."""

import itertools
import random
from collections import Counter

import pytest
from harness import rows
from pyspark.sql import functions as F

from quarrylight.llm import canonical, cooccurrence
from quarrylight.llm.canonical import mapped
from quarrylight.llm.cooccurrence import together
from quarrylight.llm.term_counts import term_counts, term_of


def test_term_counts_against_a_dictionary(spark):
    rng = random.Random(2)
    data = [(rng.choice("ab"), f"r{rng.randrange(30)}", rng.randrange(3), rng.choice(["x", "y", "hot", "hot", "é", ""]), rng.choice([0, 1, 5, None, -3])) for _ in range(2000)]
    per_row = Counter()
    for grp, record, row, term, times in data:
        if term and times and times >= 1:
            per_row[grp, term, record, row] += times
    per_record = {}
    for (grp, term, record, row), n in per_row.items():
        per_record[grp, term, record] = max(per_record.get((grp, term, record), 0), n)
    want = Counter()
    records = Counter()
    for (grp, term, record), n in per_record.items():
        want[grp, term] += n
        records[grp, term] += 1
    df = spark.createDataFrame([*data, ("a", None, 1, "lost", 1), ("a", "r", 1, None, 1)], "grp string, record string, row long, term string, times long")
    got = term_counts(df.withColumn("occurrences", F.lit("clash")), least_records=20, least_occurrences=60, common_share=0.9)
    for r in got.collect():
        key = r["grp"], r["term"]
        assert (r["occurrences"], r["records"]) == (want[key], records[key])
        total = len({k[2] for k in per_record if k[0] == r["grp"]})
        mark = "rare" if records[key] < 20 or want[key] < 60 else "common" if records[key] > 0.9 * total else None
        assert r["mark"] == mark
    assert got.count() == len(want)


def test_no_terms(spark):
    df = spark.createDataFrame([], "grp string, record string, row long, term string, times long")
    assert term_counts(df).count() == 0


def test_batches_dont_cut_counts(spark):
    """One term in every record, over many Arrow batches and partitions."""
    df = spark.range(0, 30_000, 1, 4).select(F.lit("g").alias("grp"), F.col("id").alias("record"), F.lit(0).cast("long").alias("row"), F.lit("t").alias("term"), F.lit(2).cast("long").alias("times"))
    assert rows(term_counts(df.union(df.limit(1000)))) == [("g", "t", 62_000, 30_000, "common")]
    assert rows(term_counts(df)) == [("g", "t", 60_000, 30_000, "common")]


def test_term_of(spark):
    df = spark.createDataFrame([("  A \t\n b  ",), (" x",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(term_of(F.col("t"))).collect()] == ["a b", " x", "", None]


@pytest.mark.parametrize("wide, side", [(512, 512), (2, 4), (512, 3)])
def test_together_against_counting(spark, monkeypatch, wide, side):
    rng = random.Random(3)
    names = [f"i{k:02d}" for k in range(30)]
    baskets = {f"k{k}": sorted(set(rng.choices(names, weights=range(1, 31), k=rng.randrange(0, 12)))) for k in range(300)}
    single = Counter(x for b in baskets.values() for x in b)
    pairs = Counter(p for b in baskets.values() for p in itertools.combinations(b, 2))
    n = sum(1 for b in baskets.values() if b)
    want = {(0, a, b, c, single[a], single[b], n) for (a, b), c in pairs.items() if c >= 5 and 40 * c >= n and c * n >= 1 * single[a] * single[b]}
    data = [(0, k, b) for k, b in baskets.items()] + [(0, None, names), (0, "none", None), (0, "nulls", [None])]
    df = spark.createDataFrame(data, "grp int, key string, items array<string>")
    df = df.unionByName(df.withColumn("items", F.reverse("items"))).withColumn("n", F.lit("clash"))
    run = cooccurrence._gram
    if (wide, side) == (512, 512):
        assert set(rows(together(df, 5, 40, 1))) == want and len(want) > 20
    else:  # the same matrix in smaller blocks, without Spark
        import numpy as np
        import pyarrow as pa

        monkeypatch.setattr(cooccurrence, "AT_ONCE", wide * 10)
        monkeypatch.setattr(cooccurrence, "SIDE", side)
        monkeypatch.setattr(cooccurrence, "HELD", 2)
        lists = [[names.index(x) for x in b] for b in baskets.values()]
        batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(len(lists), dtype=np.int32)), pa.array(lists, pa.list_(pa.int32()))], names=["grp", "items"])
        got = Counter()
        for out in run(iter([batch])):
            for _, i, j, c in zip(*(x.to_pylist() for x in out.columns)):
                got[names[i], names[j]] += c
        assert got == pairs


def test_many_items_are_held_as_cells(monkeypatch):
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    lists = [np.unique(rng.integers(0, 50_000, 100)).astype(np.int32) for _ in range(2000)]
    monkeypatch.setattr(cooccurrence, "HELD", 500_000)
    monkeypatch.setattr(cooccurrence, "AT_ONCE", 200_000)
    tracemalloc.start()
    got = 0
    for k in range(0, 2000, 500):
        batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(500, dtype=np.int32)), pa.array([x.tolist() for x in lists[k : k + 500]], pa.list_(pa.int32()))], names=["grp", "items"])
        got += sum(int(np.sum(out.column(3).to_numpy())) for out in cooccurrence._gram(iter([batch])))
    assert got == sum(len(x) * (len(x) - 1) // 2 for x in lists)
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()


def test_no_baskets(spark):
    assert together(spark.createDataFrame([], "grp int, key string, items array<string>")).count() == 0


TAUGHT = [("t", 21, "Wind Energy", True), ("t", 22, "Ceramic Tiles", True), ("t", 23, "Space Launch", True)]
TEACHING = {f"{a}{n}{b}": e for _, e, n, _ in TAUGHT for a, b in (("AI for ", ""), ("", " & similar"))}
REFERENCE = [*TAUGHT, ("f", 1, "Sensor Calibration", True), ("f", 1, "Gauge Trimming", False), ("f", 4, "Privacy Budget Accounting", True), ("f", 4, "PBA", False), ("f", 7, "Forestry", True), ("g", 9, "Forestry", True), ("f", 8, None, False)]
VALUES = {
    "SENSOR CALIBRATION": 1, "Ｓｅｎｓｏｒ Ｃａｌｉｂｒａｔｉｏｎ": 1, "Sensоr Cálibration": 1, "Sen​sor Calibration 🚀": 1, "calibration of sensor": 1, "Calibration, Sensor": 1,
    "SensorCalibration": 1, "sensor_calibration": 1, "Sensor Calibratoin": 1, "1. Sensor Calibration": 1, "AI for Sensor Calibration": 1, "Sensor Calibration & similar": 1, "Sensor Calibrat.": 1,
    "gauge trimmings": 1, "(pba)": 4, "pbb": 0, "Sensor Wrestling": 0, "n/a": 0, "👍": 0, "Forestyr": 7, "Forest Tourism": 0, "x" * 5000: 0,
}


@pytest.mark.parametrize("shard", [100, 1])
def test_mapping(spark, shard):
    reference = spark.createDataFrame(REFERENCE, "field string, entry long, name string, main boolean")
    data = [("r1", "f", v) for v in VALUES] + [("r1", "f", None), ("r1", "f", " \t"), ("r1", "f", "Forestry"), ("r2", "g", "FORESTRY"), ("r2", "h", "Forestry"), (None, "f", "x"), ("r1", "f", "n/a")] + [("r3", "t", v) for v in TEACHING]
    values = spark.createDataFrame(data, "key string, field string, value string").withColumn("entry", F.lit("clash")).withColumn("distance", F.lit(0))
    got = rows(mapped(values, reference, shard=shard, slice_rows=5))
    assert got == sorted([("r1", "f", v, e) for v, e in VALUES.items()] + [("r2", "g", "FORESTRY", 9), ("r2", "h", "Forestry", 0)] + [("r3", "t", v, e) for v, e in TEACHING.items()], key=repr)


def test_qualifiers_are_learnt_from_whole_names(spark):
    reference = spark.createDataFrame([*TAUGHT, *(("t", k, w, True) for k, w in ((31, "Forestry"), (32, "Courseware"), (33, "Scorecards")))], "field string, entry long, name string, main boolean")
    taught = {f"Modern {n} Practice": e for _, e, n, _ in TAUGHT} | {f"Modern {n}": e for _, e, n, _ in TAUGHT} | {f"{n} Practice": e for _, e, n, _ in TAUGHT}
    want = taught | {"modern forestry": 31, "Modern Wnid Energy practice": 21, "Old Wind Energy": 0, "Old Ceramic Tiles": 0}  # two entries teach nothing
    want |= dict.fromkeys(("Forestry Racing", "Courseware Racing", "Scorecards Racing", "Practice Modern"), 0)  # nor do names of one word
    values = spark.createDataFrame([("r", "t", v) for v in want], "key string, field string, value string")
    assert {r["value"]: r["entry"] for r in mapped(values, reference).collect()} == want


def test_whole_and_sharded_agree(spark):
    rng = random.Random(9)
    words = ["vision", "computer", "data", "graph", "energy", "wind", "model", "tile"]
    names = sorted({" ".join(rng.sample(words, rng.randrange(1, 4))) for _ in range(40)}) + ["Vision Computer", "Computer Vision"]
    reference = spark.createDataFrame([("f", k, n, True) for k, n in enumerate(names, 1)], "field string, entry long, name string, main boolean")
    values = {"computer  VISION"} | {"".join(c for c in (rng.choice(["AI ", "", "other "]) + " ".join(rng.sample(words, rng.randrange(1, 4))) + rng.choice(["", ".", " stuff"])) if rng.random() > 0.05) for _ in range(300)}
    df = spark.createDataFrame([("r", "f", v) for v in sorted(values)], "key string, field string, value string")
    assert rows(mapped(df, reference, shard=10, slice_rows=50)) == rows(mapped(df, reference))


@pytest.mark.parametrize("shard", [100, 1])
def test_a_common_word_is_no_typing_error(spark, shard):
    reference = spark.createDataFrame([("f", 5, "Notebook Hosting", True)], "field string, entry long, name string, main boolean")
    junk = [f"{w} Tasting" for w in ("Cactus", "Kite", "Volcano", "Bonsai", "Puppet")]
    data = [("r", "f", v) for v in [*junk, "Notebook Tasting", "Notebook Hostnig", "Notebok Hosting"]]
    values = spark.createDataFrame(data, "key string, field string, value string")
    got = {r["value"]: r["entry"] for r in mapped(values, reference, shard=shard).collect()}
    assert got == dict.fromkeys([*junk, "Notebook Tasting"], 0) | {"Notebook Hostnig": 5, "Notebok Hosting": 5}


@pytest.mark.parametrize("shard", [100, 1])
def test_a_frequent_misspelling_is_a_typing_error(spark, shard):
    names = ["Crawl Pipelines", *(f"Crawl {w}" for w in ("Budget", "Frontier", "Scheduling", "Archive", "Hygiene", "Sitemaps"))]
    reference = spark.createDataFrame([("f", k, n, True) for k, n in enumerate(names, 1)], "field string, entry long, name string, main boolean")
    want = dict.fromkeys(["Carwl Pipelines", "carwl pipelines", "Carwl-Pipelines", "carwl  pipelines", "Carwl Pipelinse", "Advanced Carwl Pipelines"], 1)
    want |= {f"Advanced {n}": k for k, n in enumerate(names, 1)}  # teaches the qualifier
    want |= {n.replace("Crawl", "Carwl"): k for k, n in enumerate(names, 1)} | {"Cactus Carwl": 0, "Crawl Zebra": 0}
    values = spark.createDataFrame([("r", "f", v) for v in want], "key string, field string, value string")
    assert {r["value"]: r["entry"] for r in mapped(values, reference, shard=shard).collect()} == want


@pytest.mark.parametrize("others", [0, 4000])
def test_a_word_stays_one_however_many_values_there_are(spark, others):
    reference = spark.createDataFrame([("f", 5, "Notebook Hosting", True), ("f", 6, "Notebook Posting", True)], "field string, entry long, name string, main boolean")
    want = {f"{w} Tasting": 0 for w in ("Cactus", "Kite", "Volcano", "Bonsai", "Puppet")} | {"Notebook Tasting": 0, "Notebook Hostign": 5, "notebook posting": 6}
    values = spark.createDataFrame([("r", "f", v) for v in [*want, *(f"x{k}" for k in range(others))]], "key string, field string, value string")
    got = {r["value"]: r["entry"] for r in mapped(values, reference).collect()}
    assert {v: got[v] for v in want} == want and len(got) == len(want) + others


def test_empty_reference_and_values(spark):
    reference = spark.createDataFrame(REFERENCE, "field string, entry long, name string, main boolean")
    values = spark.createDataFrame([("r", "f", "x")], "key string, field string, value string")
    assert rows(mapped(values, reference.limit(0))) == [("r", "f", "x", 0)]
    assert mapped(values.limit(0), reference).count() == 0


def test_distances():
    rng = random.Random(4)

    def table(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    words = ["".join(rng.choices("abc", k=rng.randrange(10))) for _ in range(150)]
    for a, b in itertools.combinations(words, 2):
        d = canonical.edit_distance(a, b)
        assert d == table(a, b) and canonical.typing_distance(a, b) <= d <= 2 * canonical.typing_distance(a, b)
    assert canonical.typing_distance("museum", "muusm") == 2 and canonical.typing_distance("ab", "ba") == 1
    tree = canonical.BKTree(words)
    for w in words[:40]:
        assert sorted(tree.within(w, 2)) == sorted(x for x in set(words) if table(w, x) <= 2)
    assert canonical.BKTree([]).within("a", 3) == []
