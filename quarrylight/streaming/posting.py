"""Rows handed to a service in batches of bounded size, with a bounded number of attempts."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Statuses after which another attempt can't help.
REFUSED = (401, 403)


def posted(rows: DataFrame, send: Callable[[list[dict]], tuple[int, str]], size: int = 50, attempts: int = 3, pause: float = 1.0) -> DataFrame:
    """upserted, status, attempts, error of each batch of at most `size` rows that the executors handed to send.

    send takes the rows as dicts, posts them and returns a status and a text, or raises; 200 is success. A batch is tried
    `attempts` times, after pauses of pause, 2 * pause ...; of a refusal (401, 403) not again. A batch that failed doesn't
    stop the others. Lost executors send batches again, so the service must upsert. Nothing is sent before an action.
    """

    def batches(records: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
        held: list[dict] = []
        for batch in records:
            held += [json.loads(x) for x in batch.column(0).to_pylist()]
            while len(held) >= size:
                yield held[:size]
                held = held[size:]
        if held:
            yield held

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(records):
            for tried in range(1, attempts + 1):
                try:
                    status, text = send(batch)
                except Exception as error:  # whatever a connector raises counts as a failed attempt
                    status, text = 0, str(error)
                if status == 200 or status in REFUSED or tried == attempts:
                    break
                time.sleep(pause * 2 ** (tried - 1))
            good = status == 200
            yield pa.RecordBatch.from_pydict({"upserted": pa.array([len(batch) if good else 0], pa.int64()), "status": pa.array([status], pa.int32()), "attempts": pa.array([tried], pa.int32()), "error": pa.array([None if good else text], pa.string())})

    return rows.select(F.to_json(F.struct(*rows.columns)).alias("json")).mapInArrow(run, "upserted long, status int, attempts int, error string")


def totals(results: DataFrame) -> DataFrame:
    """One row: upserted, batches, failed of posted()'s result."""
    return results.agg(F.coalesce(F.sum("upserted"), F.lit(0)).alias("upserted"), F.count("*").alias("batches"), F.count_if(F.col("error").isNotNull()).alias("failed"))
