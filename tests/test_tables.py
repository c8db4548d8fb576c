import datetime
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from harness import compare, rows
from pyspark.sql import functions as F

from quarrylight import storage
from quarrylight.plans import repository
from quarrylight.sinks import versioned
from quarrylight.streaming import changes


def test_versions_and_pointer(spark, tmp_path):
    table = versioned.VersionedTable(str(tmp_path / "edges"))
    assert table.read(spark) is None
    table.write(spark.range(3).toDF("n"))
    table.write(table.read(spark).withColumn("n", F.col("n") + 1))
    table.write(table.read(spark).withColumn("n", F.col("n") + 1))
    assert rows(table.read(spark)) == [(2,), (3,), (4,)]
    table.prune(spark, keep=1)
    assert rows(table.read(spark)) == [(2,), (3,), (4,)] and len(list((tmp_path / "edges").glob("version-*"))) == 1


def test_a_writer_that_died_costs_nothing(spark, tmp_path):
    table = versioned.VersionedTable(str(tmp_path / "t"))
    table.write(spark.range(3))
    _, folder = table.draft(spark)
    spark.range(100, 103).write.parquet(folder)  # and dies before it publishes
    table.write(spark.range(500, 510))
    assert rows(table.read(spark)) == [(n,) for n in range(500, 510)]
    (tmp_path / "t" / "_current-000000000003").touch()  # dies while it publishes
    assert rows(table.read(spark)) == [(n,) for n in range(500, 510)]
    with pytest.raises(RuntimeError):
        table.write(spark.range(1))
    os.utime(tmp_path / "t" / "_current-000000000003", (1, 1))
    table.write(spark.range(1))
    assert rows(table.read(spark)) == [(0,)]
    table.prune(spark, keep=1, abandoned=-10)
    assert len(list((tmp_path / "t").glob("version-*"))) == 1 and rows(table.read(spark)) == [(0,)]


def test_of_two_writers_one_fails(spark, tmp_path):
    table = versioned.VersionedTable(str(tmp_path / "t"))
    table.write(spark.range(1))
    one, other = table.draft(spark), table.draft(spark)
    for (_, folder), n in ((one, 10), (other, 20)):
        spark.range(n, n + 1).write.parquet(folder)
    table.publish(spark, *other)
    with pytest.raises(RuntimeError):
        table.publish(spark, *one)
    assert rows(table.read(spark)) == [(20,)]


def test_snapshot(spark, tmp_path):
    nodes = spark.createDataFrame([("b", 1), ("a", 2)], "z string, a int")
    done = versioned.snapshot(nodes, nodes.limit(1), nodes.limit(0), {"k": "12"}, str(tmp_path / "s"))
    assert [done[k] for k in ("nodes", "similarity_edges", "typed_edges")] == [2, 1, 0] and done["size_bytes"] > 0
    assert versioned.Versions(str(tmp_path / "s")).current(spark) == done["folder"]
    line = spark.read.text(f"{done['folder']}/nodes").first()[0]
    assert list(json.loads(line)) == ["a", "z"]


def test_event_is_capped(spark):
    message = json.loads(versioned.ingested_event(spark.range(300).select(F.format_string("r%03d", "id").alias("name"))).first()[0])
    assert message["upserted"] == 300 and message["repo_names"][:2] == ["r000", "r001"] and len(message["repo_names"]) == 200


def test_report(spark):
    verdict = spark.createDataFrame([("tags", 1, False)], "check string, failed long, passed boolean")
    failed = spark.createDataFrame([("r", "tags", "no tags")], "id string, check string, issue string")
    page = versioned.report_markdown(verdict, failed)
    assert "Overall: failed" in page and "- r: tags: no tags" in page


def test_materialized_tables_are_shared(spark):
    df = storage.materialize(spark.range(5), "five")
    assert df.count() == 5 and storage.shared_folder(spark).removeprefix("file://") in df.inputFiles()[0]


class Session:
    """A session as far as shared_folder() looks."""

    def __init__(self, master, folder=None):
        self.conf, self.sparkContext = {storage.SETTING: folder}, self
        self.master, self.applicationId = master, f"app-{master}"


def test_shared_folder_is_the_setting_or_a_local_one():
    assert storage.shared_folder(Session("spark://x", "hdfs:///shared/")) == "hdfs:///shared"
    own = storage.shared_folder(Session("local[2]"))
    assert own.startswith("file://") and storage.shared_folder(Session("local[2]")) == own
    with pytest.raises(RuntimeError):
        storage.shared_folder(Session("local-cluster[3,2,1000]"))


def test_changes_are_merged_once(spark, tmp_path):
    table = versioned.VersionedTable(str(tmp_path / "cache"))
    source = tmp_path / "in"
    schema = "name string, stamp string, v int"
    for part in ([("a", "1", 1), ("b", "1", 1)], [("a", "1", 99), ("b", "2", 2), ("c", None, 3)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = changes.arriving(spark, str(source), schema)
        changes.upsert_stream(stream, table, "name", "stamp", str(tmp_path / "at"), F.desc_nulls_last("stamp")).awaitTermination()
    assert rows(table.read(spark)) == [("a", "1", 1), ("b", "2", 2), ("c", None, 3)]


def test_recency(spark, tmp_path):
    source = tmp_path / "events"
    data = [(1, "2024-01-01 10:00:00", "x"), (2, "2024-01-02 10:00:00", "x"), (3, "2024-01-20 10:00:00", "y")]
    df = spark.createDataFrame(data, "id int, t string, user string").select("id", F.col("t").cast("timestamp").alias("ts"), "user")
    df.write.parquet(str(source))
    stream = changes.arriving(spark, str(source), "id int, ts timestamp, user string")
    changes.drained(changes.recency(stream, "ts", "user"), str(tmp_path / "out"), str(tmp_path / "at"))
    want = changes.recency(df, "ts", "user").where(F.col("to") <= F.lit("2024-01-18 10:00:00").cast("timestamp"))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(want) and want.count() > 0


@pytest.mark.parametrize("stamp, changed", [("1", False), ("2", True), (None, True)])
def test_changed_only(spark, stamp, changed):
    old = spark.createDataFrame([("a", "1")], "k string, s string")
    assert changes.changed_only(old, spark.createDataFrame([("a", stamp)], "k string, s string"), "k", "s").count() == changed


def test_streamed_recency_of_many_files(spark, tmp_path):
    folder = tmp_path / "events.parquet"
    folder.mkdir()
    days = [datetime.datetime(2025, 3, 20)] * 2000 + [datetime.datetime(2025, 3, 1)]
    for k, day in enumerate(days):  # the oldest row arrives last, in the third thousand
        path = folder / f"{k:05d}.parquet"
        pq.write_table(pa.table({"event_id": [k], "ts": pa.array([day], pa.timestamp("us")), "event_type": ["x"]}), path)
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    query = repository.QUERIES["stream_recency"]
    compare(spark, query, repository.SQL["stream_recency"], str(tmp_path))
    assert any(r["from"] < datetime.datetime(2025, 3, 2) for r in query(spark, str(tmp_path)).collect())
