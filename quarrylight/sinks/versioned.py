"""Tables and snapshots as folders and pointers to the current one, which readers follow; and documents for publication."""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Seconds after which a pointer without content is that of a writer that died while it wrote it.
GRACE = 60


class Versions:
    """Folders of one name each and numbered pointers to them; the pointer of the highest number names the current one.

    A version is written as a whole into a folder that nobody else uses, and then published by creating the next pointer
    with the folder's name in it. Creating fails if the pointer exists, so of two writers that began from one version
    one fails; a writer that dies leaves at most a folder that nothing names. Readers see the old or the new version.
    """

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def _fs(self, spark: SparkSession):
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path
        return path(self.root).getFileSystem(conf), path

    def _content(self, fs, path) -> str:
        stream = fs.open(path)
        try:
            return bytes(stream.readNBytes(4096)).decode()
        finally:
            stream.close()

    def _pointers(self, spark: SparkSession) -> list[tuple[int, str]]:
        """Number and folder of each published version, the newest last."""
        fs, path = self._fs(spark)
        found = fs.globStatus(path(f"{self.root}/_current-*")) or []
        named = [(int(p.getPath().getName().rpartition("-")[2]), self._content(fs, p.getPath())) for p in found]
        return sorted((n, f"{self.root}/{name}") for n, name in named if name)

    def current(self, spark: SparkSession) -> str | None:
        """The folder of the current version."""
        pointers = self._pointers(spark)
        return pointers[-1][1] if pointers else None

    def draft(self, spark: SparkSession) -> tuple[int, str]:
        """The number of the next version, and a folder for it."""
        pointers = self._pointers(spark)
        number = pointers[-1][0] + 1 if pointers else 1
        return number, f"{self.root}/version-{number:012d}-{uuid.uuid4().hex}"

    def publish(self, spark: SparkSession, number: int, folder: str) -> None:
        """Makes the written folder version `number`; fails if there is one, and deletes the folder then."""
        fs, path = self._fs(spark)
        pointer = path(f"{self.root}/_current-{number:012d}")
        if fs.exists(pointer) and not self._content(fs, pointer) and fs.getFileStatus(pointer).getModificationTime() < (time.time() - GRACE) * 1000:
            fs.delete(pointer, False)
        name = folder.rpartition("/")[2].encode()
        try:
            if fs.getUri().getScheme() == "file":  # whose Hadoop client doesn't create exclusively
                with open(pointer.toUri().getPath(), "xb") as out:
                    out.write(name)
            else:
                out = fs.create(pointer, False)
                out.write(name, 0, len(name))
                out.close()
        except (FileExistsError, Py4JJavaError) as error:
            fs.delete(path(folder), True)
            raise RuntimeError(f"version {number} of {self.root} exists: another writer was first") from error

    def prune(self, spark: SparkSession, keep: int = 2, abandoned: int = 86_400) -> None:
        """Deletes all but the newest versions, and folders that nothing names and that are older than so many seconds."""
        fs, path = self._fs(spark)
        pointers = self._pointers(spark)
        for number, folder in pointers[:-keep]:
            fs.delete(path(f"{self.root}/_current-{number:012d}"), False)
            fs.delete(path(folder), True)
        named = {folder.rpartition("/")[2] for _, folder in pointers}
        for found in fs.globStatus(path(f"{self.root}/version-*")) or []:
            if found.getPath().getName() not in named and found.getModificationTime() < (time.time() - abandoned) * 1000:
                fs.delete(found.getPath(), True)


class VersionedTable(Versions):
    """A Parquet table of which each version is a folder."""

    def read(self, spark: SparkSession) -> DataFrame | None:
        folder = self.current(spark)
        return spark.read.parquet(folder) if folder else None

    def write(self, rows: DataFrame, *partition_by: str) -> str:
        """Publishes rows, which may be made of the current version, as the next one. Of two writers one fails."""
        spark = rows.sparkSession
        number, folder = self.draft(spark)
        writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
        writer.parquet(folder)
        self.publish(spark, number, folder)
        return folder


def sorted_json(rows: DataFrame) -> DataFrame:
    """One column json: each row as an object with its keys in order."""
    return rows.select(F.to_json(F.struct(*sorted(rows.columns))).alias("json"))


def snapshot(nodes: DataFrame, similar: DataFrame, typed: DataFrame, parameters: dict[str, str], root: str) -> dict[str, object]:
    """Publishes a graph as the next version under root: three folders of JSON lines and one of its statistics.

    Returns folder, size_bytes and the counts. The parts are written by the executors, which count them as they do; the
    driver sees the counts alone. Readers follow Versions(root).current() and never see parts of two versions.
    """
    spark, versions = nodes.sparkSession, Versions(root)
    number, folder = versions.draft(spark)
    counts: dict[str, object] = {}
    for name, rows in (("nodes", nodes), ("similarity_edges", similar), ("typed_edges", typed)):
        seen = Observation()
        sorted_json(rows).observe(seen, F.count(F.lit(1)).alias("n")).write.text(f"{folder}/{name}")
        counts[name] = seen.get["n"]
    sorted_json(spark.createDataFrame([{**counts, **parameters}])).write.text(f"{folder}/stats")
    versions.publish(spark, number, folder)
    fs, path = versions._fs(spark)
    return {**counts, "folder": folder, "size_bytes": fs.getContentSummary(path(folder)).getLength()}


def ingested_event(names: DataFrame, most: int = 200) -> DataFrame:
    """One JSON message on a run: how many repos, and the first of their names (column name)."""
    first = names.orderBy("name").limit(most).agg(F.array_sort(F.collect_list("name")).alias("repo_names"))
    return sorted_json(names.agg(F.count("*").alias("upserted")).crossJoin(first))  # one row each


def report_markdown(verdict: DataFrame, failed: DataFrame, most: int = 10) -> str:
    """A probe's verdicts and its first failures as a page."""
    rows = verdict.orderBy("check").collect()  # one row a check
    lines = ["# Probe", "", f"Overall: {'passed' if all(r['passed'] for r in rows) else 'failed'}", "", "| check | failed | passed |", "|-|-|-|"]
    lines += [f"| {r['check']} | {r['failed']} | {r['passed']} |" for r in rows]
    shown = failed.orderBy("check", "id").limit(most).collect()
    return "\n".join([*lines, "", *[f"- {r['id']}: {r['check']}: {r['issue']}" for r in shown]]) + "\n"


def report_json(verdict: DataFrame, failed: DataFrame, most: int = 10) -> str:
    """The same as one JSON object: passed, exit_code (0 or 1), checks, and the first failures."""
    rows = verdict.orderBy("check").collect()  # one row a check
    shown = failed.orderBy("check", "id").limit(most).collect()
    passed = all(r["passed"] for r in rows)
    return json.dumps({"checks": [r.asDict() for r in rows], "exit_code": 0 if passed else 1, "failures": [r.asDict() for r in shown], "passed": passed}, sort_keys=True)
