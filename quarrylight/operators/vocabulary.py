"""Raw tags to a canonical vocabulary: equal but for case, else the closest by matching blocks."""

from __future__ import annotations

import difflib
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylight.functions.sets import stripped


def canonical_tags(raw: DataFrame, vocabulary: list[str], cutoff: float = 0.82) -> DataFrame:
    """tag, canonical of each distinct raw tag (column tag); null where none is close enough.

    The ratio of matching blocks of the lower-cased texts counts, which no SQL engine has; it is computed once for each
    distinct tag that isn't found as it stands, with the entries of the vocabulary whose length and letters allow it. Of
    equally close entries the last by name counts. The vocabulary is a parameter of fixed size.
    """
    known = raw.sparkSession.createDataFrame([(t.lower(), t) for t in dict.fromkeys(vocabulary)], "low string, exact string").dropDuplicates(["low"])
    distinct = raw.select("tag").where("tag is not null").distinct().withColumn("low", F.lower(stripped(F.col("tag"))))
    joined = distinct.join(F.broadcast(known), "low", "left")
    lowered = {t.lower(): t for t in reversed(vocabulary)}

    names = sorted(lowered)

    def closest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_length = defaultdict(list)
        for name in names:
            by_length[len(name)].append((name, Counter(name)))

        def best(low: str) -> str | None:
            found, letters, matcher = (cutoff, ""), Counter(low), difflib.SequenceMatcher(None, "", low)
            for n in range(math.ceil(cutoff * len(low) / (2 - cutoff) - 1e-9), math.floor(len(low) * (2 - cutoff) / cutoff + 1e-9) + 1):  # others can't reach the cutoff
                for name, own in by_length.get(n, ()):
                    if 2.0 * (letters & own).total() / (n + len(low)) >= found[0]:  # nor those with too few letters in common
                        matcher.set_seq1(name)
                        found = max(found, (matcher.ratio(), name))
            return lowered[found[1]] if found[1] else None

        for rows in batches:
            yield pd.DataFrame({"tag": rows["tag"], "canonical": [best(t) if t else None for t in rows["low"]]})

    left = joined.where("exact is null").select("tag", "low").mapInPandas(closest, "tag string, canonical string")
    return joined.where("exact is not null").select("tag", F.col("exact").alias("canonical")).unionByName(left)
