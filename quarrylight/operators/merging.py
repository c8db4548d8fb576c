"""How rows that arrive meet the rows of a table: each returns the table's next version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row a key, the first by order; give an order without ties for a defined result."""
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new's rows, and those of old whose key isn't among them. Keys are unique in new and not null."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*old.columns))


def fill(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """old with those columns replaced where new has a value for the key that is neither null nor an empty text or array."""
    kinds = dict(new.dtypes)

    def given(name: str) -> Column:
        c = F.col(f"_n_{name}")
        return F.when(F.size(c) > 0, c) if kinds[name].startswith(("array", "map")) else F.nullif(c, F.lit("")) if kinds[name] == "string" else c

    both = old.join(new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in columns]), keys, "left")
    return both.select(*[F.coalesce(given(c), F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns])


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """old, and the first row of new by order for each key that old lacks."""
    return old.unionByName(latest(new, keys, *order).join(old.select(*keys), keys, "left_anti").select(*old.columns))


def replace_groups(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of new, and those of old whose key doesn't occur in new."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new.select(*old.columns))


def versions(rows: DataFrame, key: str, at: str, *ties: Column) -> DataFrame:
    """rows with is_current: true of the newest of each key. Nothing is overwritten."""
    first = F.row_number().over(Window.partitionBy(key).orderBy(F.desc_nulls_last(at), *ties)) == 1
    return rows.withColumn("is_current", first)


def expire(rows: DataFrame, at: Column, before: Column) -> DataFrame:
    """rows but those whose time is known and earlier than before."""
    return rows.where(~F.coalesce(at < before, F.lit(False)))


def swap(live: DataFrame, staged: DataFrame, managed: list[str], run: int, now: Column) -> tuple[DataFrame, DataFrame]:
    """The edges after staged replaced those of the managed types, and the history rows of what was replaced.

    live: source, target, edge_type, weight, confidence, created_at, and more; staged has live's columns. Edges of other
    types stay. History has live's columns, valid_from, valid_until and run.
    """
    ours = F.coalesce(F.col("edge_type").isin(managed), F.lit(False))
    history = live.where(ours).select("*", F.col("created_at").alias("valid_from"), now.alias("valid_until"), F.lit(run).alias("run"))
    return live.where(~ours).unionByName(staged.select(*live.columns)), history
