"""Streams: rows that change a table, and counters over recent time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarrylight.operators import merging
from quarrylight.sinks.versioned import VersionedTable


def arriving(spark: SparkSession, path: str, schema: str, files: int | None = 1000) -> DataFrame:
    """A stream of the rows of Parquet files as they arrive in a folder, at most so many files at a time; all that are there if None."""
    reader = spark.readStream.schema(schema)
    return (reader if files is None else reader.option("maxFilesPerTrigger", files)).parquet(path)


def changed_only(old: DataFrame, new: DataFrame, key: str, stamp: str) -> DataFrame:
    """The rows of new whose stamp isn't that of old's row of the same key, or whose key is new. A null stamp equals a null one."""
    known = old.select(key, F.col(stamp).alias("_stamp"), F.lit(True).alias("_known"))
    both = new.join(known, key, "left")
    return both.where(F.col("_known").isNull() | ~F.col(stamp).eqNullSafe(F.col("_stamp"))).drop("_stamp", "_known")


def upsert_stream(rows: DataFrame, into: VersionedTable, key: str, stamp: str, checkpoint: str, *order: Column) -> StreamingQuery:
    """Merges each batch of rows into the table: the first row a key by order, where its stamp changed; stops when nothing is left.

    A batch that is delivered again finds its stamps in the table and changes nothing.
    """

    def merge(batch: DataFrame, number: int) -> None:
        new = merging.latest(batch, [key], *order)
        old = into.read(batch.sparkSession)
        into.write(new if old is None else merging.upsert(old, changed_only(old, new, key, stamp), [key]))

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def recency(events: DataFrame, at: str, key: str, length: str = "7 days", slide: str = "1 day", late: str = "2 days") -> DataFrame:
    """from, to, key, events of each sliding window; rows over `late` older than the newest of an earlier batch are left out of a stream.

    All rows count that come in one batch, so for a result that doesn't depend on the files read all of them in one.
    """
    counted = events.withWatermark(at, late).groupBy(F.window(at, length, slide), key).agg(F.count("*").alias("events"))
    return counted.select(F.col("window.start").alias("from"), F.col("window.end").alias("to"), key, "events")


def drained(rows: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Writes what a stream has by now to Parquet files, and waits for it."""
    rows.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def each_batch(rows: DataFrame, send: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hands each batch to a connector, at least once."""
    return rows.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
