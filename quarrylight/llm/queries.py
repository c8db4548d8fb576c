"""The registered queries of the llm operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.functions.sets import clean_items
from quarrylight.llm.bpe import encoded
from quarrylight.llm.canonical import mapped
from quarrylight.llm.cooccurrence import together
from quarrylight.llm.leaks import leaks
from quarrylight.llm.near_duplicates import near_duplicates
from quarrylight.llm.set_join import gathered, similar_sets
from quarrylight.llm.shared_spans import shared_spans
from quarrylight.llm.term_counts import term_counts, term_of
from quarrylight.sources.tables import table


def _named(grp: str, names: list[str]):
    return F.element_at(F.array(*map(F.lit, names)), F.col(grp) + 1)


def _readable(spark: SparkSession, folder: str) -> DataFrame:
    content = table(spark, folder, "repo_cache").select(F.lit(0).alias("grp"), F.col("name").alias("key"), F.col("readme_content").alias("text"))
    summary = table(spark, folder, "enrichment_result").select(F.lit(1).alias("grp"), F.col("repo_id").alias("key"), F.col("readme_summary").alias("text"))
    return content.unionByName(summary)


def _near(spark: SparkSession, folder: str):
    return near_duplicates(_readable(spark, folder), width=3, threshold=0.6, least_words=20)


def p1_classes(spark: SparkSession, folder: str) -> DataFrame:
    """field_name, key, class_id, links: one row a repo, with its text's class (copies share it) and how many other texts are near."""
    return _near(spark, folder).classes().select(_named("grp", ["readme_content", "readme_summary"]).alias("field_name"), "key", F.col("rid").alias("class_id"), "links")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """field_name, key_a, key_b: repos whose texts of at least 20 words share 0.6 of their three-word sequences."""
    pairs = _near(spark, folder).key_pairs()
    return pairs.select(_named("grp", ["readme_content", "readme_summary"]).alias("field_name"), "key_a", "key_b")


def _entries(spark: SparkSession, folder: str) -> DataFrame:
    snapshots = table(spark, folder, "trend_snapshot").withColumn("row", F.monotonically_increasing_id())
    parts = [snapshots.select(F.lit(name).alias("grp"), F.col("snapshot_id").cast("string").alias("record"), "row", F.explode(name).alias("term", "times")) for name in ("tag_counts", "category_counts")]
    results = table(spark, folder, "enrichment_result").withColumn("row", F.monotonically_increasing_id())
    parts.append(results.select(F.lit("use_cases").alias("grp"), F.col("repo_id").alias("record"), "row", F.explode("use_cases").alias("term"), F.lit(1).cast("long").alias("times")))
    return reduce(DataFrame.unionByName, parts).withColumn("term", term_of(F.col("term")))


def p2_terms(spark: SparkSession, folder: str) -> DataFrame:
    """field_name, term, occurrences, records, mark of every term."""
    return term_counts(_entries(spark, folder)).withColumnRenamed("grp", "field_name")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """field_name, term, mark of the terms too rare or too common."""
    return p2_terms(spark, folder).where("mark is not null").select("field_name", "term", "mark")


def _tag_sets(spark: SparkSession, folder: str) -> DataFrame:
    hashed = F.transform(clean_items(F.col("items")), lambda x: F.xxhash64(x)).alias("tokens")
    repos = table(spark, folder, "enrichment_result").select(F.lit(0).alias("side"), F.lower("repo_id").alias("key"), F.col("integration_tags").alias("items"))
    hubs = table(spark, folder, "hub_repos").select(F.lit(1).alias("side"), F.lower("id").alias("key"), F.from_json("integration_tags", "array<string>").alias("items"))
    return repos.unionByName(hubs).select(F.lit(0).alias("grp"), "side", "key", hashed)


def _edge_sets(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame | None]:
    edges = table(spark, folder, "repo_edges").select(F.lower("source_repo_id").alias("key"), F.lower("target_repo_id").alias("to"))
    return gathered(edges.where("key <> to").select(F.lit(1).alias("grp"), F.lit(0).alias("side"), "key", F.xxhash64("to").alias("token")))


def _similar(spark: SparkSession, folder: str):
    targets, large = _edge_sets(spark, folder)
    return similar_sets(_tag_sets(spark, folder).unionByName(targets), 3, 4, least_size=6, large=large)


def p3_classes(spark: SparkSession, folder: str) -> DataFrame:
    """kind, side (1: of hub_repos), key, class_id, links: one row a set, with its class (equal sets share it) and to how many other sets it is similar."""
    classes = _similar(spark, folder).classes()
    return classes.select(F.when(F.col("grp") == 1, "edges").otherwise("tags").alias("kind"), "side", "key", F.col("rid").alias("class_id"), "links")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """kind, key_a, key_b: pairs of sets of at least 6 values that overlap by 3/4."""
    pairs = _similar(spark, folder).key_pairs()
    kind = F.when(F.col("grp") == 1, "edges").when(F.col("side") == 1, "tags_hub").otherwise("tags")
    return pairs.select(kind.alias("kind"), "key_a", "key_b")


FREE_FIELDS = ("skill_areas", "industries", "categories")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """repo_id, field_name, raw_value, entry_id of every value that isn't an entry as it stands; 0: it stands for none."""
    results = table(spark, folder, "enrichment_result")
    values = reduce(DataFrame.unionByName, [results.select(F.col("repo_id").alias("key"), F.lit(name).alias("field"), F.explode(name).alias("value")) for name in FREE_FIELDS])
    canonical = table(spark, folder, "canonical_values").select(F.col("field_name").alias("field"), F.col("entry_id").alias("entry"), F.col("entry").alias("own"), "other_names")
    names = canonical.select("field", "entry", F.col("own").alias("name"), F.lit(True).alias("main"))
    names = names.unionByName(canonical.select("field", "entry", F.explode("other_names").alias("name"), F.lit(False).alias("main")))
    found = mapped(values, names)
    return found.select(F.col("key").alias("repo_id"), F.col("field").alias("field_name"), F.col("value").alias("raw_value"), F.col("entry").alias("entry_id"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """field_name, item_a, item_b of the tags that share repos much more often than chance."""
    tags = table(spark, folder, "enrichment_result").select(F.lit(0).alias("grp"), F.col("repo_id").alias("key"), clean_items(F.col("integration_tags")).alias("items"))
    topics = table(spark, folder, "github_repo").select(F.lit(1).alias("grp"), F.col("full_name").alias("key"), clean_items(F.col("topics")).alias("items"))
    return together(tags.unionByName(topics)).select(_named("grp", ["integration_tags", "topics"]).alias("field_name"), "item_a", "item_b")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").alias("doc"), "text")


VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def p6_ids(spark: SparkSession, folder: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ids of every document."""
    return encoded(_documents(spark, folder), vocabulary).withColumnRenamed("doc", "doc_id")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, item_id: the document holds 12 consecutive words of the item, or all of a shorter one."""
    items = table(spark, folder, "eval_items").select(F.col("item_id").alias("item"), "text")
    return leaks(_documents(spark, folder), items).withColumnsRenamed({"doc": "doc_id", "item": "item_id"})


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, span_start, span_end: the maximal runs of characters shared in stretches of at least 300."""
    return shared_spans(_documents(spark, folder)).withColumnsRenamed({"doc": "doc_id", "from": "span_start", "to": "span_end"})


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (p1_found, p1_classes, p2_found, p2_terms, p3_found, p3_classes, p4_found, p5_found, p6_ids, p7_found, p8_found)
    return {f.__name__: f for f in found}
