"""How often every term occurs and in how many records: a range-partitioned sort of (term, record) pairs, scanned run by run."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def term_of(text: Column) -> Column:
    """text lower-cased, each run of spaces, tabs and line ends made one space, none left at the ends."""
    return F.lower(F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " ")))


def _changes(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before; the first always does."""
    n = len(column)
    return np.concatenate([[True], pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)]) if n else np.empty(0, dtype=bool)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """grp, term, record, row, times, sorted by the first four, to a row for each run of a term: grp, term, occurrences, records.

    Only the last record's rows are kept for the next batch, so a term may come out in parts; their sums are its counts.
    """
    held: pa.RecordBatch | None = None

    def counted(rows: pa.RecordBatch) -> pa.RecordBatch:
        grp, term, record, row, times = rows.columns
        at_term = _changes(grp) | _changes(term)
        at_record = at_term | _changes(record)
        at_row = at_record | _changes(row)
        per_row = np.add.reduceat(times.to_numpy(), np.flatnonzero(at_row))
        per_record = np.maximum.reduceat(per_row, np.flatnonzero(at_record[at_row]))
        starts = np.flatnonzero(at_term[at_record])
        firsts = pa.array(np.flatnonzero(at_term))
        records = np.diff(np.append(starts, len(per_record)))
        return pa.RecordBatch.from_arrays([grp.take(firsts), term.take(firsts), pa.array(np.add.reduceat(per_record, starts)), pa.array(records.astype(np.int64))], names=["grp", "term", "occurrences", "records"])

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        changed = _changes(batch.column(0)) | _changes(batch.column(1)) | _changes(batch.column(2))
        cut = int(np.flatnonzero(changed)[-1])
        if cut:
            yield counted(batch.slice(0, cut))
        held = batch.slice(cut)
    if held is not None:
        yield counted(held)


def term_counts(entries: DataFrame, least_records: int = 3, least_occurrences: int = 5, common_share: float = 0.3) -> DataFrame:
    """grp, term, occurrences, records and mark of every term.

    entries: grp int, record (any type that can be compared), row long, term string, times long. times is how often the
    entry counts; entries with null or less than 1, a null or empty term or a null record don't count. Entries of one
    term, record and row add up; of the rows of one record (rows delivered again) the one with the most counts. mark is
    `rare` of terms in fewer than least_records records or with fewer than least_occurrences occurrences, else `common`
    of those in more than common_share of the records that hold any counted term of the grp, else null. No entries, no rows.
    """
    pairs = entries.select("grp", "term", "record", "row", F.col("times").cast("long").alias("times")).where("term <> '' and record is not null and times >= 1")
    keys = ["grp", "term", "record", "row"]
    in_order = pairs.repartitionByRange("grp", "term", "record").sortWithinPartitions(*keys)
    runs = in_order.mapInArrow(_scan, f"grp {dict(entries.dtypes)['grp']}, term string, occurrences long, records long")
    counts = runs.groupBy("grp", "term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
    totals = pairs.groupBy("grp").agg(F.count_distinct("record").alias("all"))
    rare = (F.col("records") < least_records) | (F.col("occurrences") < least_occurrences)
    mark = F.when(rare, "rare").when(F.col("records") > common_share * F.col("all"), "common")
    return counts.join(F.broadcast(totals), "grp").select("grp", "term", "occurrences", "records", mark.alias("mark"))  # totals: one row a grp, of which callers have a fixed few
