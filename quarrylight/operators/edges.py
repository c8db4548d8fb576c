"""Builders of typed edges between repositories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylight.functions.scores import quality_overall, stars_log
from quarrylight.functions.text import or_null, owner_part, package_key, repo_part
from quarrylight.operators.incidence import BLOCK, MASKED, NEAREST, nearest_lists, packed_block
from quarrylight.storage import materialize

#: Lists that are held against a block in one task, and nodes of one list that are named in one row.
ASKED, MEMBERS = 131_072, 1_000
#: Nodes whose ids may be broadcast, at some 72 bytes each; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def _numbered(rows: DataFrame, by: str) -> tuple[DataFrame, int]:
    """rows, stored, with number: from 0 on in the order of the column by, and their count."""
    stored = materialize(rows.orderBy(by).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)
    sizes = {r["part"]: r["n"] for r in stored.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}  # one row a partition
    before = [sum(n for p, n in sizes.items() if p < k) for k in range(max(sizes, default=0) + 1)]
    number = F.get(F.lit(before), part.cast("int")) + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return stored.withColumn("number", number.cast("int")).drop("_at"), sum(sizes.values())


def _nearest(nodes: DataFrame, n: int, least: int, most: int, block: int) -> DataFrame:
    """incidence.NEAREST of the distinct lists among n nodes (number, codes): up to `most` + 1 nodes, as a member may be one of them."""
    by_list = Window.partitionBy("codes").orderBy("number")
    ranked = nodes.select("number", "codes", (F.row_number().over(by_list) - 1).alias("rank"))
    parts = max(1, -(-n // block))
    asked = max(nodes.sparkSession.sparkContext.defaultParallelism, -(-n // ASKED))
    queries = ranked.groupBy("codes", F.floor(F.col("rank") / MEMBERS).alias("_")).agg(F.collect_list("number").alias("members")).drop("_")
    queries = queries.select(F.pmod(F.xxhash64("codes", F.element_at("members", 1)), F.lit(asked)).cast("int").alias("own"), "codes", "members")
    held = ranked.where(F.col("rank") <= most).select(F.pmod("number", F.lit(parts)).cast("int").alias("part"), "number", "codes")
    blocks = held.repartitionById(parts, F.col("part")).mapInArrow(packed_block, BLOCK)
    cell = lambda own, part: (part * asked + own).cast("int").alias("cell")
    met = blocks.withColumn("own", F.explode(F.sequence(F.lit(0), F.lit(asked - 1)))).select(cell(F.col("own"), F.col("part")), "block", F.lit(None).cast("array<long>").alias("codes"), F.lit(None).cast("array<int>").alias("members"))
    met = met.unionByName(queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(cell(F.col("own"), F.col("part")), F.lit(None).cast("binary").alias("block"), "codes", "members"))
    found = met.repartitionById(parts * asked, F.col("cell")).mapInArrow(nearest_lists(least, most + 1), NEAREST)
    found = found.select("members", F.arrays_zip("near", "shared", "longer", "mine", "theirs").alias("l"))
    if parts > 1:
        ordered = F.array_sort(F.transform(F.flatten(F.collect_list("l")), lambda x: F.struct((-x["shared"] / x["longer"]).alias("w"), x["near"].alias("near"), x.alias("x"))))
        found = found.groupBy("members").agg(F.transform(F.slice(ordered, 1, most + 1), lambda y: y["x"]).alias("l"))
    return found


def compatible_edges(tagged: DataFrame, least: int = 2, most: int = 30, block: int = 500_000) -> DataFrame:
    """source < target, shared_tags, shared_count, weight, confidence of repos that share at least `least` tags.

    tagged: id string, tags array<string>, one row an id; null, blank and repeated tags don't count, nor their case.
    weight is the share of the longer list; a pair stays if it is among the `most` heaviest of either end (ties: by ids).

    Ids are numbered in their order. Each distinct list is held against all repos (`most` + 1 of an equal list at most),
    `block` of them at once, and only its nearest leave the task, as numbers with masks of the tags they share: nothing
    that grows with the pairs of a tag is ever written. Ids and names are fetched for the pairs that stay.
    Runs jobs and writes to the shared folder when called.
    """
    tags = F.array_sort(F.array_distinct(F.filter(F.transform("tags", lambda t: F.lower(t)), lambda t: F.trim(t) != "")))
    listed = tagged.where(F.col("id").isNotNull()).select("id", tags.alias("tags")).where(F.size("tags") >= least)
    nodes, n = _numbered(listed, "id")
    widest = nodes.agg(F.max(F.size("tags")).alias("n")).first()["n"] or 0
    found = _nearest(nodes.select("number", F.transform("tags", lambda t: F.xxhash64(t)).alias("codes")), n, least, most, block)
    others = F.slice(F.filter("l", lambda x: x["near"] != F.col("number")), 1, most)
    pairs = found.select(F.explode("members").alias("number"), "l").select("number", F.explode(others).alias("x")).select("number", "x.*")
    mask = F.when(F.col("number") < F.col("near"), F.col("mine")).otherwise(F.col("theirs")) if widest <= MASKED else F.lit(0)
    pairs = pairs.select(F.least("number", "near").alias("a"), F.greatest("number", "near").alias("b"), F.col("shared").alias("shared_count"), "longer", mask.alias("mask"))
    pairs = pairs.repartition("a").distinct()
    two = nodes.select(F.col("number").alias("b"), F.col("id").alias("target"), *([] if widest <= MASKED else [F.col("tags").alias("others")]))
    both = pairs.join(nodes.select(F.col("number").alias("a"), F.col("id").alias("source"), "tags"), "a")
    names = F.filter("tags", lambda _, k: F.getbit(F.col("mask"), k) == 1) if widest <= MASKED else F.array_intersect("tags", "others")
    both = both.join(F.broadcast(two) if n <= BROADCAST_IDS and widest <= MASKED else two, "b")
    weight, confidence = F.col("shared_count") / F.col("longer"), F.least(F.lit(0.85), F.col("shared_count") / 5)
    return both.select("source", "target", names.alias("shared_tags"), F.col("shared_count").cast("long").alias("shared_count"), weight.alias("weight"), confidence.alias("confidence"))


def _first_ids(grouped: DataFrame, group: str, most: int) -> DataFrame:
    """The `most` smallest ids of each group; partitions hand on no more than that of each, so a large group isn't gathered."""
    ranked = grouped.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy("id")))
    return ranked.where(F.col("_rank") <= most)


def alternative_edges(categorised: DataFrame, most: int = 30) -> DataFrame:
    """source < target, category, weight 1, confidence 0.7 of repos of one category: those that the first `most` ids of it begin.

    categorised: id, category, one row an id; null ids and categories are left out. Were each id to keep its first
    `most` pairs by id, and a pair to stay that either end keeps, the same would remain.
    """
    nodes = categorised.where("id is not null and category is not null").select("id", "category")
    first = _first_ids(nodes, "category", most).select("category", F.col("id").alias("source"))
    pairs = nodes.select("category", F.col("id").alias("target")).join(first, "category").where("source < target")
    return pairs.select("source", "target", "category", F.lit(1.0).alias("weight"), F.lit(0.7).alias("confidence"))


def keyword_group(text: Column, groups: dict[str, list[str]]) -> Column:
    """The first group one of whose keywords the text contains anywhere, in any case; null if none."""
    lowered, out = F.lower(text), F
    for name, keywords in groups.items():
        hit = F.lit(False)
        for k in keywords:
            hit = hit | F.contains(lowered, F.lit(k.lower()))
        out = out.when(hit, name)
    return out.otherwise(F.lit(None).cast("string"))


def keyword_alternatives(described: DataFrame, groups: dict[str, list[str]], most: int | None = None) -> DataFrame:
    """As alternative_edges, weight 0.7, confidence 0.4, by keyword_group of the column problem: all pairs of a group, unless most is given.

    The pairs grow with the square of a group; keyword_classes() holds the same edges in linear size.
    """
    nodes = described.select("id", keyword_group(F.col("problem"), groups).alias("category")).where("id is not null and category is not null")
    if most is None:
        pairs = nodes.select("category", F.col("id").alias("source")).join(nodes.select("category", F.col("id").alias("target")), "category").where("source < target").select("source", "target", "category")
    else:
        pairs = alternative_edges(nodes, most).drop("weight", "confidence")
    return pairs.select("*", F.lit(0.7).alias("weight"), F.lit(0.4).alias("confidence"))


def keyword_classes(described: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """id, category, links, weight 0.7, confidence 0.4: all pairs of keyword_alternatives with most None, one row an id.

    Two ids of one category are an edge, so an id has links (the others of its category) of them; one alone has no row.
    """
    nodes = described.select("id", keyword_group(F.col("problem"), groups).alias("category")).where("id is not null and category is not null")
    sizes = nodes.groupBy("category").agg(F.count("*").alias("n")).where("n > 1")
    kept = nodes.join(F.broadcast(sizes), "category")  # one row a group
    return kept.select("id", "category", (F.col("n") - 1).alias("links"), F.lit(0.7).alias("weight"), F.lit(0.4).alias("confidence"))


def depends_on_edges(dependencies: DataFrame, repos: DataFrame) -> DataFrame:
    """source, target, package, ecosystem, weight 1, confidence 0.95: a repo declares a package that another repo is.

    dependencies: id, package, ecosystem, is_direct; repos: id, name, and may have forked_from. A repo provides what its upstream repo
    is called, or else its own name. Names are compared without case, hyphens and underscores; of repos of one name the
    greatest id is meant. Indirect rows, `__none__` and self-links are left out; of several packages for one pair the
    first by name stays.
    """
    name = repo_part(F.coalesce(or_null(F.col("forked_from")), F.col("name")) if "forked_from" in repos.columns else F.col("name"))
    index = repos.groupBy(package_key(name).alias("key")).agg(F.max("id").alias("target")).where("key <> ''")
    wanted = dependencies.where("is_direct and package <> '__none__'").select(F.col("id").alias("source"), "package", "ecosystem", package_key(F.col("package")).alias("key"))
    pairs = wanted.join(index, "key").where("source <> target").groupBy("source", "target").agg(F.min(F.struct("package", "ecosystem")).alias("first"))
    return pairs.select("source", "target", "first.package", "first.ecosystem", F.lit(1.0).alias("weight"), F.lit(0.95).alias("confidence"))


def extends_edges(forks: DataFrame, smallest: int = 2, largest: int = 30, most: int = 20) -> DataFrame:
    """source < target, owner, weight 1 / (n - 1), confidence 0.6 of repos forked from one owner, of groups of smallest to largest.

    forks: id, forked_from (owner/name). A pair stays if it is among the first `most` of either end by ids.
    """
    nodes = forks.select("id", owner_part(F.col("forked_from")).alias("owner")).where("id is not null and owner is not null")
    sizes = nodes.groupBy("owner").agg(F.count("*").alias("n")).where(F.col("n").between(smallest, largest))  # larger groups never meet
    kept = nodes.join(sizes, "owner")
    first = _first_ids(kept, "owner", most).select("owner", F.col("id").alias("source"))
    pairs = kept.select("owner", "n", F.col("id").alias("target")).join(first, "owner").where("source < target")
    return pairs.select("source", "target", "owner", (1.0 / (F.col("n") - 1)).alias("weight"), F.lit(0.6).alias("confidence"))


# Fixed value: the order in which typed edges are listed.
EDGE_PRIORITY = ("DEPENDS_ON", "EXTENDS", "COMPATIBLE_WITH", "ALTERNATIVE_TO")


def edge_priority(edge_type: Column) -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, EDGE_PRIORITY)), edge_type), F.lit(0)), F.lit(len(EDGE_PRIORITY) + 1)).cast("int")


def typed_edges(edges: DataFrame, public: DataFrame) -> DataFrame:
    """priority, edge_type, source, target, weight, confidence of edges between public ids, by priority, weight (null last), type, source, target.

    edges: source, target, edge_type, weight, confidence; public: id. A null weight sorts as such and is given as 0.5.
    """
    ids = public.select("id").distinct()
    own = edges.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi")
    ordered = own.withColumn("priority", edge_priority(F.col("edge_type"))).orderBy("priority", F.desc_nulls_last("weight"), "edge_type", "source", "target")
    return ordered.select("priority", "edge_type", "source", "target", F.coalesce("weight", F.lit(0.5)).alias("weight"), "confidence")


def edge_counts(edges: DataFrame) -> DataFrame:
    """edge_type and edges, with a row of null type for the total."""
    return edges.rollup("edge_type").agg(F.count("*").alias("edges"))


def regression_gate(before: DataFrame, after: DataFrame, abort: float = 0.5, warn: float = 0.2, large: int = 100) -> DataFrame:
    """One row: before, after, lost (share of the total), vanished (types of at least `large` edges that have none now), verdict pass, warn or abort.

    before and after: edge_type, edges. Without edges before, it passes.
    """
    old, new = before.where("edge_type is not null").withColumnRenamed("edges", "b"), after.where("edge_type is not null").withColumnRenamed("edges", "a")
    both = old.join(new, "edge_type", "full")
    gone = F.when((F.col("b") >= large) & (F.coalesce("a", F.lit(0)) == 0), F.col("edge_type"))
    one = both.agg(F.coalesce(F.sum("b"), F.lit(0)).alias("before"), F.coalesce(F.sum("a"), F.lit(0)).alias("after"), F.array_join(F.array_sort(F.collect_set(gone)), ",").alias("vanished"))
    lost = F.when(F.col("before") > 0, (F.col("before") - F.col("after")) / F.col("before")).otherwise(F.lit(0.0))
    one = one.withColumn("lost", F.greatest(lost, F.lit(0.0)))
    verdict = F.when(F.col("before") == 0, "pass").when((F.col("lost") > abort) | (F.col("vanished") != ""), "abort").when(F.col("lost") > warn, "warn").otherwise("pass")
    return one.select("before", "after", F.round("lost", 6).alias("lost"), "vanished", verdict.alias("verdict"))


def public_nodes(repos: DataFrame) -> DataFrame:
    """repo_id, name, owner, description, primary_category, stars, stars_log, quality, updated_at of public repos, by owner and name.

    repos: id, the columns of those names, is_private, quality_signals (JSON). Unknown stars are 0; a time is ISO text.
    """
    public = repos.where(~F.coalesce("is_private", F.lit(False)))
    return public.orderBy("owner", "name", "id").select(
        F.col("id").alias("repo_id"), "name", "owner", "description", "primary_category", F.coalesce("stars", F.lit(0)).cast("long").alias("stars"), stars_log(F.col("stars")).alias("stars_log"),
        quality_overall(F.col("quality_signals")).alias("quality"), F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("updated_at"),
    )
