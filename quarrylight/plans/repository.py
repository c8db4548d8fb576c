"""Queries of the engine's operators over the tables of a folder, each with the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight import storage
from quarrylight.functions import scores, text
from quarrylight.functions.sets import clean_items, stripped
from quarrylight.operators import edges, knn, manifests, merging, quality, tagging, trends, vocabulary
from quarrylight.sources import landing
from quarrylight.sources.tables import table
from quarrylight.streaming import changes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

AS_OF = "2026-01-01 00:00:00"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# What stands in the ends of a text that strip() takes away, for the SQL.
_WS = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x0b]"
_STRIP = rf"'^{_WS}+|{_WS}+$', '', 'g'"

_REPOS_SQL = """
repos AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY full_name ORDER BY updated_at DESC NULLS LAST, stars DESC NULLS LAST, forks_count DESC NULLS LAST, open_issues_count DESC NULLS LAST, pushed_at DESC NULLS LAST) AS rn
        FROM github_repo
    ) WHERE rn = 1
)"""
_RESULTS_SQL = f"""
flat AS (SELECT repo_id, unnest(integration_tags) AS t FROM enrichment_result),
tagged AS (
    SELECT repo_id AS id, list_sort(list(DISTINCT lower(regexp_replace(t, {_STRIP})))) AS tags FROM flat WHERE regexp_replace(t, {_STRIP}) <> '' GROUP BY repo_id
)"""


def repos(spark: SparkSession, folder: str) -> DataFrame:
    """The newest row of each full_name."""
    order = [F.desc_nulls_last(c) for c in ("updated_at", "stars", "forks_count", "open_issues_count", "pushed_at")]
    return merging.latest(table(spark, folder, "github_repo"), ["full_name"], *order)


def tagged(spark: SparkSession, folder: str) -> DataFrame:
    """id, tags of each enriched repo: the clean tags of all its rows."""
    rows = table(spark, folder, "enrichment_result").select(F.col("repo_id").alias("id"), F.explode(clean_items(F.col("integration_tags"))).alias("t"))
    return rows.groupBy("id").agg(F.array_sort(F.collect_set("t")).alias("tags"))


# --- nearest neighbours -------------------------------------------------------------------------------------------

_SIM_SQL = """
pairs AS (
    SELECT a.vec_id AS source, b.vec_id AS target, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id {where}
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY s DESC, target) AS rank FROM pairs)
"""


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))


@register(f"WITH {_SIM_SQL.format(where='')} SELECT source, target, round(s, 4) AS similarity, rank FROM ranked WHERE rank <= 12 AND (s >= 0.4 OR rank = 1)")
def knn_similarity_edges(spark: SparkSession, folder: str) -> DataFrame:
    return knn.similarity_edges(_vectors(spark, folder))


@register(f"WITH {_SIM_SQL.format(where='WHERE a.vec_id % 20 = 0')} SELECT source, target, round(s, 4) AS similarity, rank FROM ranked WHERE rank <= 5")
def semantic_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _vectors(spark, folder)
    found = knn.neighbours(vectors.where("id % 20 = 0"), vectors, 5)
    return found.select("source", "target", F.round("similarity", 4).alias("similarity"), F.col("rank").cast("long").alias("rank"))


# --- typed edges --------------------------------------------------------------------------------------------------


@register(f"""
WITH {_RESULTS_SQL},
pairs AS (
    SELECT a.id AS source, b.id AS target, list_sort(list_intersect(a.tags, b.tags)) AS shared, greatest(len(a.tags), len(b.tags)) AS longer
    FROM tagged a JOIN tagged b ON a.id < b.id AND len(list_intersect(a.tags, b.tags)) >= 2
),
weighted AS (SELECT source, target, array_to_string(shared, ',') AS shared_tags, len(shared) AS shared_count, CAST(len(shared) AS DOUBLE) / longer AS weight FROM pairs),
ends AS (SELECT *, unnest([source, target]) AS e FROM weighted),
ranked AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY weight DESC, source, target) AS rn FROM ends)
SELECT DISTINCT source, target, shared_tags, shared_count, round(weight, 6) AS weight, round(least(0.85, shared_count / 5.0), 6) AS confidence FROM ranked WHERE rn <= 30
""")
def compatible_with_edges(spark: SparkSession, folder: str) -> DataFrame:
    found = edges.compatible_edges(tagged(spark, folder))
    return found.select("source", "target", F.array_join("shared_tags", ",").alias("shared_tags"), "shared_count", F.round("weight", 6).alias("weight"), F.round("confidence", 6).alias("confidence"))


_PRIMARY_SQL = f"""
firsts AS (
    SELECT repo_id AS id, min(lower(regexp_replace(categories[1], {_STRIP}))) AS category FROM enrichment_result WHERE regexp_replace(categories[1], {_STRIP}) <> '' GROUP BY repo_id
)"""


def _primary(spark: SparkSession, folder: str) -> DataFrame:
    first = F.lower(stripped(F.get("categories", F.lit(0))))
    rows = table(spark, folder, "enrichment_result").select(F.col("repo_id").alias("id"), first.alias("category")).where("category <> ''")
    return rows.groupBy("id").agg(F.min("category").alias("category"))


@register(f"""
WITH {_PRIMARY_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY id) AS rn FROM firsts)
SELECT a.id AS source, b.id AS target, a.category, CAST(1.0 AS DOUBLE) AS weight, CAST(0.7 AS DOUBLE) AS confidence FROM ranked a JOIN firsts b ON a.category = b.category AND a.rn <= 30 AND a.id < b.id
""")
def alternative_to_edges(spark: SparkSession, folder: str) -> DataFrame:
    return edges.alternative_edges(_primary(spark, folder))


GROUPS = {"query": ["queries", "query"], "label": ["label"], "commit": ["commit", "branch"], "queue": ["queue", "replica", "shard"]}


def _problems(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "enrichment_result").groupBy(F.col("repo_id").alias("id")).agg(F.min("problem_solved").alias("problem"))


@register("""
WITH problems AS (SELECT repo_id AS id, min(problem_solved) AS problem FROM enrichment_result GROUP BY repo_id),
grouped AS (
    SELECT id, CASE WHEN contains(lower(problem), 'queries') OR contains(lower(problem), 'query') THEN 'query' WHEN contains(lower(problem), 'label') THEN 'label'
        WHEN contains(lower(problem), 'commit') OR contains(lower(problem), 'branch') THEN 'commit'
        WHEN contains(lower(problem), 'queue') OR contains(lower(problem), 'replica') OR contains(lower(problem), 'shard') THEN 'queue' END AS category
    FROM problems
),
pairs AS (SELECT a.id, a.category, b.id AS other FROM grouped a JOIN grouped b ON a.category = b.category AND a.id <> b.id)
SELECT id, category, count(*) AS links, CAST(0.7 AS DOUBLE) AS weight, CAST(0.4 AS DOUBLE) AS confidence FROM pairs GROUP BY id, category
""")
def alternative_keyword_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair of a group, without a cap, as the class each id is in: two ids of one category are an edge."""
    return edges.keyword_classes(_problems(spark, folder), GROUPS)


@register("""
WITH hubs AS (SELECT id, replace(replace(lower(CASE WHEN contains(coalesce(nullif(forked_from, ''), name), '/') THEN split_part(coalesce(nullif(forked_from, ''), name), '/', 2) ELSE coalesce(nullif(forked_from, ''), name) END), '-', ''), '_', '') AS k FROM hub_repos),
idx AS (SELECT k, max(id) AS target FROM hubs WHERE k <> '' GROUP BY k),
deps AS (
    SELECT DISTINCT lower(e.source_repo_id) AS source, h.name AS package FROM repo_edges e JOIN hub_repos h ON h.id = lower(e.target_repo_id)
    WHERE e.edge_type = 'DEPENDS_ON' AND coalesce(e.confidence, 1) >= 0.5
)
SELECT source, target, min(package) AS package, 'pypi' AS ecosystem, CAST(1.0 AS DOUBLE) AS weight, CAST(0.95 AS DOUBLE) AS confidence
FROM deps JOIN idx ON k = replace(replace(lower(package), '-', ''), '_', '') WHERE source <> target GROUP BY source, target
""")
def depends_on_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Declared packages are the names of the hubs that an edge says a repo depends on; doubtful ones count as indirect, and hubs declare nothing."""
    hubs = table(spark, folder, "hub_repos").select("id", "name", "forked_from")
    links = table(spark, folder, "repo_edges").where("edge_type = 'DEPENDS_ON'").select(F.lower("source_repo_id").alias("id"), F.lower("target_repo_id").alias("to"), "confidence")
    names = links.join(hubs.select(F.col("id").alias("to"), F.col("name").alias("package")), "to")
    wanted = names.select("id", "package", F.lit("pypi").alias("ecosystem"), (F.coalesce("confidence", F.lit(1)) >= 0.5).alias("is_direct")).distinct()
    none = hubs.select("id", F.lit("__none__").alias("package"), F.lit("__sentinel__").alias("ecosystem"), F.lit(True).alias("is_direct"))
    return edges.depends_on_edges(wanted.unionByName(none), hubs)


@register(f"""
WITH {_REPOS_SQL},
nodes AS (SELECT full_name AS id, nullif(lower(regexp_replace(split_part(forked_from, '/', 1), {_STRIP})), '') AS owner FROM repos WHERE contains(forked_from, '/')),
sized AS (SELECT *, count(*) OVER (PARTITION BY owner) AS n, row_number() OVER (PARTITION BY owner ORDER BY id) AS rn FROM nodes WHERE owner IS NOT NULL)
SELECT a.id AS source, b.id AS target, a.owner, round(1.0 / (a.n - 1), 6) AS weight, CAST(0.6 AS DOUBLE) AS confidence
FROM sized a JOIN sized b ON a.owner = b.owner AND a.id < b.id AND a.rn <= 20 WHERE a.n BETWEEN 2 AND 30
""")
def extends_edges(spark: SparkSession, folder: str) -> DataFrame:
    found = edges.extends_edges(repos(spark, folder).select(F.col("full_name").alias("id"), "forked_from"))
    return found.withColumn("weight", F.round("weight", 6))


_EDGES_SQL = """
one AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT lower(source_repo_id) AS source, lower(target_repo_id) AS target, edge_type, weight, confidence, created_at,
            row_number() OVER (PARTITION BY lower(source_repo_id), lower(target_repo_id), edge_type ORDER BY updated_at DESC, id) AS rn
        FROM repo_edges
    ) WHERE rn = 1
)"""


def current_edges(spark: SparkSession, folder: str) -> DataFrame:
    """The newest row of each source, target and type, whatever its case."""
    rows = table(spark, folder, "repo_edges").select(F.lower("source_repo_id").alias("source"), F.lower("target_repo_id").alias("target"), "edge_type", "weight", "confidence", "created_at", "updated_at", "id")
    return merging.latest(rows, ["source", "target", "edge_type"], F.desc("updated_at"), F.col("id")).drop("updated_at", "id")


@register(f"WITH {_EDGES_SQL} SELECT source, target, edge_type, weight, confidence, created_at FROM one")
def edge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return current_edges(spark, folder)


@register(f"""
WITH {_EDGES_SQL}, public AS (SELECT DISTINCT lower(repo_id) AS id FROM enrichment_result UNION SELECT lower(id) FROM hub_repos WHERE NOT is_private)
SELECT CASE edge_type WHEN 'DEPENDS_ON' THEN 1 WHEN 'EXTENDS' THEN 2 WHEN 'COMPATIBLE_WITH' THEN 3 WHEN 'ALTERNATIVE_TO' THEN 4 ELSE 5 END AS priority, edge_type, source, target, coalesce(weight, 0.5) AS weight, confidence
FROM one WHERE source IN (SELECT id FROM public) AND target IN (SELECT id FROM public)
""")
def typed_edges_ordered(spark: SparkSession, folder: str) -> DataFrame:
    own = table(spark, folder, "enrichment_result").select(F.lower("repo_id").alias("id"))
    hubs = table(spark, folder, "hub_repos").where("not is_private").select(F.lower("id").alias("id"))
    return edges.typed_edges(current_edges(spark, folder), own.unionByName(hubs))


@register("SELECT edge_type, count(*) AS edges FROM repo_edges GROUP BY ROLLUP (edge_type)")
def edge_counts(spark: SparkSession, folder: str) -> DataFrame:
    return edges.edge_counts(table(spark, folder, "repo_edges"))


@register("""
WITH b AS (SELECT edge_type, count(*) AS n FROM repo_edges GROUP BY 1), a AS (SELECT edge_type, count(*) AS n FROM repo_edges WHERE created_at >= TIMESTAMP '2025-07-01' GROUP BY 1),
t AS (SELECT CAST(sum(b.n) AS BIGINT) AS before, CAST(coalesce(sum(a.n), 0) AS BIGINT) AS after, coalesce(string_agg(CASE WHEN b.n >= 100 AND coalesce(a.n, 0) = 0 THEN b.edge_type END, ',' ORDER BY b.edge_type), '') AS vanished FROM b LEFT JOIN a USING (edge_type))
SELECT before, after, round((before - after) / CAST(before AS DOUBLE), 6) AS lost, vanished,
    CASE WHEN (before - after) / CAST(before AS DOUBLE) > 0.5 OR vanished <> '' THEN 'abort' WHEN (before - after) / CAST(before AS DOUBLE) > 0.2 THEN 'warn' ELSE 'pass' END AS verdict FROM t
""")
def edge_regression_gate(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "repo_edges")
    return edges.regression_gate(edges.edge_counts(rows), edges.edge_counts(rows.where("created_at >= timestamp_ntz'2025-07-01'")))


_SWAP_SQL = f"WITH {_EDGES_SQL}, old AS (SELECT * FROM one WHERE created_at < TIMESTAMP '2025-07-01'), staged AS (SELECT * FROM one WHERE created_at >= TIMESTAMP '2025-07-01' AND edge_type IN ('DEPENDS_ON', 'EXTENDS'))"


def _swapped(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = current_edges(spark, folder)
    new = F.col("created_at") >= F.lit("2025-07-01").cast("timestamp_ntz")
    return merging.swap(rows.where(~new), rows.where(new & F.col("edge_type").isin("DEPENDS_ON", "EXTENDS")), ["DEPENDS_ON", "EXTENDS"], 7, as_of())


@register(_SWAP_SQL + " SELECT * FROM old WHERE edge_type NOT IN ('DEPENDS_ON', 'EXTENDS') UNION ALL SELECT * FROM staged")
def graph_swap_live(spark: SparkSession, folder: str) -> DataFrame:
    return _swapped(spark, folder)[0]


@register(_SWAP_SQL + f" SELECT *, created_at AS valid_from, TIMESTAMP '{AS_OF}' AS valid_until, 7 AS run FROM old WHERE edge_type IN ('DEPENDS_ON', 'EXTENDS')")
def graph_swap_history(spark: SparkSession, folder: str) -> DataFrame:
    return _swapped(spark, folder)[1]


@register("""
SELECT (SELECT count(DISTINCT lower(repo_id)) FROM enrichment_result) AS nodes, (SELECT count(*) FROM repo_edges) AS typed_edges, (SELECT count(DISTINCT lower(source_repo_id)) FROM repo_edges) AS sources
""")
def snapshot_stats(spark: SparkSession, folder: str) -> DataFrame:
    nodes = table(spark, folder, "enrichment_result").agg(F.count_distinct(F.lower("repo_id")).alias("nodes"))
    typed = table(spark, folder, "repo_edges").agg(F.count("*").alias("typed_edges"), F.count_distinct(F.lower("source_repo_id")).alias("sources"))
    return nodes.crossJoin(typed)  # one row each


# --- tags and categories ------------------------------------------------------------------------------------------

RULES = {"Install": ["install", "pip"], "Layout": ["layout"], "Licence": ["licence", "license"], "FAQ": ["faq"], "Limits": ["limit", "limits"]}
TOPICS = {"sparse-models": "Models", "graph-labels": "Labels", "sparse-testing": "Testing", "fork-alerts": "Alerts", "graph-viewer": "Viewers"}


def _word_sql(words: list[str]) -> str:
    return "'(?i)(^|[^a-zA-Z0-9])(" + "|".join(words) + ")($|[^a-zA-Z0-9])'"


_TEXTS_SQL = "texts AS (SELECT name AS id, max(readme_content) AS readme FROM repo_cache GROUP BY name)"
_README_SQL = ", ".join(f"CASE WHEN regexp_matches(readme, {_word_sql(w)}) THEN '{t}' END" for t, w in RULES.items())
_LANGS_SQL = " ".join(f"WHEN '{k}' THEN [{', '.join(repr(x) for x in v)}]" for k, v in tagging.LANGUAGE_TAGS.items())
_TOPICS_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TOPICS.items())
_ISO_SQL = r"CASE WHEN regexp_matches({0}, '^\d{{4}}-\d{{2}}-\d{{2}}([T ]|$)') THEN CAST(replace(replace({0}, 'Z', ''), 'T', ' ') AS TIMESTAMP) END"


def _days_sql(column: str) -> str:
    return f"CAST(floor((epoch(TIMESTAMP '{AS_OF}') - epoch(date_trunc('second', {_ISO_SQL.format(column)}))) / 86400.0) AS BIGINT)"


_META_SQL = f"""
dated AS (SELECT *, {_days_sql('updated_at')} AS days FROM repos),
meta AS (
    SELECT full_name AS id, list_sort(list_distinct(list_filter(list_concat(
        CASE primary_language {_LANGS_SQL} ELSE [] END,
        list_transform(coalesce(topics, []), lambda t: CASE replace(lower(t), ' ', '-') {_TOPICS_SQL} END),
        [CASE WHEN stars > 1000 THEN 'Popular' END, CASE WHEN days < 30 THEN 'Active' WHEN days > 365 THEN 'Inactive' END, CASE WHEN is_fork THEN 'Forked' ELSE 'Built by Me' END, CASE WHEN is_archived THEN 'Archived' END]
    ), lambda x: x IS NOT NULL))) AS tags FROM dated
)"""


def _readmes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "repo_cache").groupBy(F.col("name").alias("id")).agg(F.max("readme_content").alias("readme"))


@register(f"WITH {_TEXTS_SQL} SELECT id, array_to_string(list_filter([{_README_SQL}], lambda x: x IS NOT NULL), ',') AS tags FROM texts")
def readme_tags(spark: SparkSession, folder: str) -> DataFrame:
    return _readmes(spark, folder).select("id", F.array_join(tagging.text_tags(F.col("readme"), RULES), ",").alias("tags"))


def _meta(spark: SparkSession, folder: str) -> DataFrame:
    rows = repos(spark, folder)
    tags = tagging.meta_tags(F.col("stars"), F.col("updated_at"), F.col("primary_language"), F.col("topics"), F.col("is_fork"), F.col("is_archived"), as_of(), TOPICS)
    return rows.select(F.col("full_name").alias("id"), "name", tags.alias("tags"))


@register(f"WITH {_REPOS_SQL}, {_META_SQL} SELECT id, array_to_string(tags, ',') AS tags FROM meta")
def meta_tags(spark: SparkSession, folder: str) -> DataFrame:
    return _meta(spark, folder).select("id", F.array_join("tags", ",").alias("tags"))


@register(f"""
WITH {_REPOS_SQL}, {_META_SQL}, {_TEXTS_SQL}
SELECT m.id, array_to_string(list_sort(list_distinct(list_concat(m.tags, list_filter([{_README_SQL}], lambda x: x IS NOT NULL)))), ',') AS tags FROM meta m LEFT JOIN texts t ON t.id = split_part(m.id, '/', 2)
""")
def enriched_tags(spark: SparkSession, folder: str) -> DataFrame:
    readme = _readmes(spark, folder).select(F.col("id").alias("name"), tagging.text_tags(F.col("readme"), RULES).alias("of_text"))
    both = _meta(spark, folder).withColumn("name", F.split_part("id", F.lit("/"), F.lit(2))).join(readme, "name", "left")
    return both.select("id", F.array_join(tagging.enriched_tags(F.col("tags"), F.col("of_text")), ",").alias("tags"))


CATEGORIES = [(1, "Serving", "Backend"), (1, "Serving", "Systems"), (2, "Interfaces", "Frontend"), (2, "Interfaces", "Viewers"), (3, "Quality", "Testing"), (3, "Quality", "Labels"), (4, "Languages", "Python"), (4, "Languages", "Rust"), (4, "Languages", "Go")]
_VOCAB_SQL = "vocab(ord, category, tag) AS (VALUES " + ", ".join(map(str, CATEGORIES)) + ")"
_MATCH_SQL = f"WITH {_REPOS_SQL}, {_META_SQL}, {_VOCAB_SQL}, tags AS (SELECT id, unnest(tags) AS tag FROM meta), matches AS (SELECT id, ord, category, count(*) AS n FROM tags JOIN vocab USING (tag) GROUP BY ALL)"


def _vocabulary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORIES, "ord int, category string, tag string")


@register(_MATCH_SQL + ", best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, ord) AS rn FROM matches) SELECT m.id, coalesce(b.category, '') AS category FROM meta m LEFT JOIN best b ON b.id = m.id AND b.rn = 1")
def primary_category(spark: SparkSession, folder: str) -> DataFrame:
    return tagging.primary_category(_meta(spark, folder), _vocabulary(spark))


@register(_MATCH_SQL + ", lists AS (SELECT id, string_agg(category, ',' ORDER BY ord) AS c FROM matches GROUP BY id) SELECT m.id, coalesce(l.c, '') AS categories FROM meta m LEFT JOIN lists l USING (id)")
def all_categories(spark: SparkSession, folder: str) -> DataFrame:
    return tagging.all_categories(_meta(spark, folder), _vocabulary(spark)).select("id", F.array_join("categories", ",").alias("categories"))


@register(f"""
WITH {_REPOS_SQL}, orgs AS (SELECT DISTINCT lower(owner) AS login, 'hub' AS org_category, upper(owner) AS display_name FROM hub_repos),
named AS (SELECT full_name AS id, coalesce(CASE WHEN is_fork AND contains(forked_from, '/') THEN split_part(forked_from, '/', 1) END, owner) AS login FROM repos)
SELECT id, n.login, coalesce(display_name, n.login) AS display_name, coalesce(org_category, 'individual') AS org_category, o.login IS NOT NULL AS is_known FROM named n LEFT JOIN orgs o ON o.login = lower(n.login)
""")
def builder_dim(spark: SparkSession, folder: str) -> DataFrame:
    organisations = table(spark, folder, "hub_repos").select(F.lower("owner").alias("login"), F.lit("hub").alias("org_category"), F.upper("owner").alias("display_name")).distinct()
    return tagging.builders(repos(spark, folder).select(F.col("full_name").alias("id"), "owner", "is_fork", "forked_from"), organisations)


@register("WITH names AS (SELECT DISTINCT unnest(categories) AS name FROM enrichment_result) SELECT name, replace(replace(replace(lower(name), ' ', '-'), '&', 'and'), ':', '') AS slug FROM names WHERE name IS NOT NULL")
def category_slugs(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "enrichment_result").select(F.explode("categories").alias("name")).where("name is not null").distinct()
    return names.select("name", text.slug(F.col("name")).alias("slug"))


@register()
def canonical_tags(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "github_repo").select(F.explode("topics").alias("tag"))
    return vocabulary.canonical_tags(raw, ["sparse-models", "sparse-testing", "graph-labels", "graph-viewer", "fork-alerts", "audit-ui"])


# --- activity -----------------------------------------------------------------------------------------------------

_COMMITS_SQL = f"""
listed AS (SELECT name AS id, max(recent_commits) AS commits FROM repo_cache GROUP BY name),
commit_days AS (
    SELECT id, list_transform(coalesce(json_extract_string(commits, '$[*].committed_at'), []), lambda c: {_days_sql('c')}) AS days FROM listed
),
windows AS (
    SELECT id, len(list_filter(days, lambda d: d = 0)) AS today, len(list_filter(days, lambda d: d < 7)) AS last7, len(list_filter(days, lambda d: d < 30)) AS last30, len(list_filter(days, lambda d: d < 90)) AS last90 FROM commit_days
)"""


def _commit_windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "repo_cache").groupBy(F.col("name").alias("id")).agg(F.max("recent_commits").alias("c"))
    dates = F.coalesce(F.from_json("c", landing.COMMITS), F.array().cast(landing.COMMITS))
    rows = rows.select("id", dates.alias("c"))
    return rows.select("id", *[c.alias(n) for n, c in scores.commit_windows(F.col("c.committed_at"), as_of()).items()])


@register(f"WITH {_COMMITS_SQL} SELECT * FROM windows")
def commit_windows(spark: SparkSession, folder: str) -> DataFrame:
    return _commit_windows(spark, folder)


@register(f"""
WITH {_REPOS_SQL}, {_COMMITS_SQL},
parts AS (SELECT full_name AS id, coalesce(is_archived, false) AS archived, coalesce(stars, 0) AS s, coalesce(forks_count, 0) AS f, coalesce(last7, 0) AS d7, coalesce(last30, 0) AS d30, coalesce(last90, 0) AS d90 FROM repos r LEFT JOIN windows w ON w.id = r.name)
SELECT id, CAST(CASE WHEN archived THEN least(10, floor(log2(s + 1) * 1.5)) ELSE least(100, least(60, d30 * 3 + d7 * 5) + least(15, floor(log2(s + 1) * 2)) + least(15, floor(log2(f + 1) * 3)) + CASE WHEN d90 > 0 THEN 10 ELSE 0 END) END AS BIGINT) AS score,
    CASE WHEN s > 0 THEN round(log10(s + 1), 4) ELSE 0.0 END AS stars_log FROM parts
""")
def activity_score(spark: SparkSession, folder: str) -> DataFrame:
    both = repos(spark, folder).join(_commit_windows(spark, folder).withColumnRenamed("id", "name"), "name", "left")
    score = scores.activity_score(F.col("stars"), F.col("forks_count"), F.col("last7"), F.col("last30"), F.col("last90"), F.col("is_archived"))
    return both.select(F.col("full_name").alias("id"), score.alias("score"), scores.stars_log(F.col("stars")).alias("stars_log"))


@register("""
WITH weekly AS (SELECT user_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 7 AS w, count(*) AS n FROM events GROUP BY ALL),
arrays AS (SELECT user_id, list(n ORDER BY w) AS weeks FROM weekly GROUP BY user_id)
SELECT user_id, weeks[-1] AS last7, CASE WHEN len(weeks) >= 4 THEN CAST(list_sum(weeks[-4:]) AS BIGINT) ELSE 0 END AS last30, CASE WHEN len(weeks) >= 13 THEN CAST(list_sum(weeks[-13:]) AS BIGINT) ELSE 0 END AS last90 FROM arrays
""")
def weekly_windows(spark: SparkSession, folder: str) -> DataFrame:
    week = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 7)
    weekly = table(spark, folder, "events").groupBy("user_id", week.alias("w")).agg(F.count("*").alias("n"))
    arrays = weekly.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("w", "n"))).alias("s")).select("user_id", F.col("s.n").alias("weeks"))
    return arrays.select("user_id", *[c.alias(n) for n, c in scores.week_windows(F.col("weeks")).items()])


@register("""
WITH one AS (SELECT name AS id, max(language_breakdown) AS b FROM repo_cache GROUP BY name), keys AS (SELECT id, b, unnest(json_keys(b)) AS language FROM one WHERE b IS NOT NULL),
counts AS (SELECT id, language, CAST(json_extract_string(b, '$."' || language || '"') AS BIGINT) AS n FROM keys), total AS (SELECT id, sum(n) AS t FROM counts GROUP BY id)
SELECT id, language, round(n / CAST(t AS DOUBLE) * 100, 1) AS percent FROM counts JOIN total USING (id) WHERE t > 0
""")
def language_percentages(spark: SparkSession, folder: str) -> DataFrame:
    one = table(spark, folder, "repo_cache").groupBy(F.col("name").alias("id")).agg(F.max("language_breakdown").alias("b"))
    return one.select("id", F.explode(scores.shares(F.from_json("b", "map<string,bigint>"))).alias("language", "percent"))


# --- trends, gaps and checks --------------------------------------------------------------------------------------

_FREQ_SQL = f"WITH {_RESULTS_SQL}, counts AS (SELECT tag AS item, count(*) AS repos FROM (SELECT unnest(tags) AS tag FROM tagged) GROUP BY 1)"


@register(_FREQ_SQL + " SELECT * FROM counts")
def tag_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    return trends.frequencies(tagged(spark, folder), "tags")


@register(_FREQ_SQL + " SELECT * FROM counts ORDER BY repos DESC, item LIMIT 20")
def trend_top_tags(spark: SparkSession, folder: str) -> DataFrame:
    return trends.top(tag_frequencies(spark, folder), 20)


@register(f"""
WITH {_REPOS_SQL}, {_META_SQL} SELECT count(*) AS total, count(*) FILTER (list_contains(m.tags, 'Active')) AS active,
    count(*) FILTER ({_ISO_SQL.format('r.updated_at')} > TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY) AS new_last_30d FROM repos r JOIN meta m ON m.id = r.full_name
""")
def trend_summary(spark: SparkSession, folder: str) -> DataFrame:
    dates = repos(spark, folder).select(F.col("full_name").alias("id"), text.instant(F.col("updated_at")).alias("updated"))
    return trends.summary(_meta(spark, folder).join(dates, "id"), as_of())


EXPECTED = [(1, "schema tooling", 100), (2, "crawl pipelines", 60), (3, "voice interfaces", 80), (4, "edge runtimes", 500), (5, "quantum kitchens", 3)]


@register(f"""
WITH {_PRIMARY_SQL}, expected(ord, category, expected) AS (VALUES {', '.join(map(str, EXPECTED))}), counts AS (SELECT category, count(*) AS n FROM firsts GROUP BY 1),
short AS (SELECT e.*, coalesce(n, 0) AS n, expected - coalesce(n, 0) AS d FROM expected e LEFT JOIN counts USING (category) WHERE coalesce(n, 0) < expected)
SELECT category, CASE WHEN d >= expected * 0.75 THEN 'high' WHEN d >= expected * 0.4 THEN 'medium' ELSE 'low' END AS severity, n AS repo_count,
    'Only ' || n || ' repos in ' || category || ' (expected ' || expected || '+)' AS description, 'Add ' || d || ' more repos covering ' || category AS suggestion FROM short
""")
def coverage_gaps(spark: SparkSession, folder: str) -> DataFrame:
    counts = _primary(spark, folder).groupBy(F.col("category").alias("item")).agg(F.count("*").alias("repos"))
    return trends.gaps(counts, spark.createDataFrame(EXPECTED, "ord int, category string, expected int"))


_MARKERS_SQL = " ".join("WHEN contains(lower(summary), '{0}') THEN '{1}'".format(m.lower().replace("'", "''"), m.replace("'", "''")) for m in quality.FAILURE_MARKERS)
_PROBE_SQL = f"""
rows AS (
    SELECT repo_id AS id, min(categories[1]) AS category, max_by(integration_tags, CAST(integration_tags AS VARCHAR)) AS tags, min(readme_summary) AS summary FROM enrichment_result GROUP BY repo_id
),
allowed AS (SELECT entry FROM canonical_values WHERE field_name = 'categories'),
failed AS (
    SELECT id, 'category' AS "check", 'unknown category ' || category AS issue FROM rows WHERE category IS NOT NULL AND category NOT IN (SELECT entry FROM allowed)
    UNION ALL SELECT id, 'tags', CASE WHEN coalesce(len(tags), 0) < 1 THEN 'no tags' ELSE 'tag too long' END FROM rows WHERE coalesce(len(tags), 0) < 1 OR len(list_filter(tags, lambda t: length(t) > 50)) > 0
    UNION ALL SELECT id, 'summary', CASE WHEN summary IS NULL THEN 'no summary' WHEN length(summary) < 50 THEN 'too short' ELSE 'too long' END FROM rows WHERE summary IS NULL OR length(summary) < 50 OR length(summary) > 2000
    UNION ALL SELECT id, 'refusal', marker FROM (SELECT id, CASE {_MARKERS_SQL} END AS marker FROM rows) WHERE marker IS NOT NULL
)"""


def _probed(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "enrichment_result").groupBy(F.col("repo_id").alias("id"))
    return rows.agg(F.min(F.get("categories", F.lit(0))).alias("category"), F.max("integration_tags").alias("tags"), F.min("readme_summary").alias("summary"))


def _failures(spark: SparkSession, folder: str) -> DataFrame:
    allowed = table(spark, folder, "canonical_values").where("field_name = 'categories'").select(F.col("entry").alias("category"))
    return quality.failures(_probed(spark, folder), allowed)


@register(f"WITH {_PROBE_SQL} SELECT * FROM failed")
def probe_failures(spark: SparkSession, folder: str) -> DataFrame:
    return _failures(spark, folder)


@register(f"""
WITH {_PROBE_SQL}, names("check") AS (VALUES ('category'), ('tags'), ('summary'), ('refusal')), counts AS (SELECT "check", count(*) AS n FROM failed GROUP BY 1),
verdicts AS (
    SELECT "check", coalesce(n, 0) AS failed FROM names LEFT JOIN counts USING ("check")
    UNION ALL SELECT 'tag_total', CAST(greatest(100 - sum(coalesce(len(tags), 0)), 0) AS BIGINT) FROM rows
    UNION ALL SELECT 'enriched_total', CAST(greatest(1500 - count(*) FILTER (coalesce(len(tags) > 0, false) OR coalesce(summary <> '', false) OR coalesce(category <> '', false)), 0) AS BIGINT) FROM rows
)
SELECT "check", failed, failed = 0 AS passed FROM verdicts
""")
def probe_verdict(spark: SparkSession, folder: str) -> DataFrame:
    rows = _probed(spark, folder).withColumn("is_enriched", quality.enriched(F.col("tags"), F.col("summary"), F.col("category")))
    return quality.verdict(rows, _failures(spark, folder))


@register(f"WITH {_REPOS_SQL} SELECT full_name AS id, {_ISO_SQL.format('updated_at')} AS updated, {_ISO_SQL.format('updated_at')} >= TIMESTAMP '{AS_OF}' AS is_fresh FROM repos ORDER BY updated DESC NULLS LAST, id LIMIT 20")
def probe_sample(spark: SparkSession, folder: str) -> DataFrame:
    return quality.fresh_sample(repos(spark, folder).select(F.col("full_name").alias("id"), text.instant(F.col("updated_at")).alias("updated")), 20, as_of())


# --- scans --------------------------------------------------------------------------------------------------------


@register(f"WITH {_REPOS_SQL} SELECT full_name, name, owner, nullif(license_spdx, 'NOASSERTION') AS license_spdx, coalesce(pushed_at, updated_at) AS pushed_at, CASE WHEN is_fork THEN created_at END AS forked_at, stars, is_fork FROM repos WHERE NOT is_private")
def repo_listing(spark: SparkSession, folder: str) -> DataFrame:
    return landing.listing(repos(spark, folder)).select("full_name", "name", "owner", "license_spdx", "pushed_at", "forked_at", "stars", "is_fork")


@register("""
WITH one AS (SELECT name AS id, max(ahead_by) AS ahead, max(behind_by) AS behind FROM repo_cache GROUP BY name)
SELECT id, CASE WHEN ahead IS NULL OR behind IS NULL THEN 'unknown' WHEN ahead > 0 AND behind > 0 THEN 'diverged' WHEN behind > 0 THEN 'behind' WHEN ahead > 0 THEN 'ahead' ELSE 'up-to-date' END AS state FROM one
""")
def fork_sync(spark: SparkSession, folder: str) -> DataFrame:
    one = table(spark, folder, "repo_cache").groupBy(F.col("name").alias("id")).agg(F.max("ahead_by").alias("a"), F.max("behind_by").alias("b"))
    return one.select("id", scores.sync_state(F.col("a"), F.col("b")).alias("state"))


@register("""
WITH one AS (SELECT name AS id, max(recent_commits) AS c FROM repo_cache GROUP BY name), items AS (SELECT id, unnest(CAST(c AS JSON[])) AS j FROM one WHERE c IS NOT NULL)
SELECT id, left(json_extract_string(j, '$.sha'), 8) AS sha, left(split_part(json_extract_string(j, '$.message'), chr(10), 1), 100) AS message, json_extract_string(j, '$.committed_at') AS committed_at FROM items
""")
def recent_commits(spark: SparkSession, folder: str) -> DataFrame:
    one = table(spark, folder, "repo_cache").groupBy(F.col("name").alias("id")).agg(F.max("recent_commits").alias("c"))
    return landing.commits(one, "id", "c")


@register("SELECT name AS id, max(json_extract_string(latest_release, '$.tag_name')) AS tag_name FROM repo_cache WHERE latest_release IS NOT NULL GROUP BY name")
def latest_release(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "repo_cache").where("latest_release is not null")
    return rows.groupBy(F.col("name").alias("id")).agg(F.max(F.get_json_object("latest_release", "$.tag_name")).alias("tag_name"))


# --- joins and counts ---------------------------------------------------------------------------------------------


@register("SELECT DISTINCT name FROM github_repo WHERE name NOT IN (SELECT repo_name FROM enrichment_result WHERE repo_name IS NOT NULL AND error IS NULL)")
def unscanned_repos(spark: SparkSession, folder: str) -> DataFrame:
    done = table(spark, folder, "enrichment_result").where("error is null").select(F.col("repo_name").alias("name"))
    return table(spark, folder, "github_repo").select("name").distinct().join(done, "name", "left_anti")


@register("""
SELECT count(*) AS rows, count(*) FILTER (readme_summary IS NULL) AS no_summary, count(*) FILTER (coalesce(len(integration_tags), 0) = 0) AS no_tags, count(*) FILTER (coalesce(len(categories), 0) = 0) AS no_categories,
    count(*) FILTER (error IS NOT NULL) AS errors, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, round(sum(input_tokens) / 1e6 * 3 + sum(output_tokens) / 1e6 * 15, 6) AS cost FROM enrichment_result
""")
def coverage_counts(spark: SparkSession, folder: str) -> DataFrame:
    empty = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    cost = F.sum("input_tokens") / 1e6 * 3 + F.sum("output_tokens") / 1e6 * 15
    return table(spark, folder, "enrichment_result").agg(
        F.count("*").alias("rows"), F.count_if(F.col("readme_summary").isNull()).alias("no_summary"), F.count_if(empty("integration_tags")).alias("no_tags"), F.count_if(empty("categories")).alias("no_categories"),
        F.count_if(F.col("error").isNotNull()).alias("errors"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.round(cost, 6).alias("cost"),
    )


@register("SELECT owner, count(DISTINCT full_name) AS repos FROM github_repo GROUP BY owner HAVING count(DISTINCT full_name) > 1")
def owner_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "github_repo").groupBy("owner").agg(F.count_distinct("full_name").alias("repos")).where("repos > 1")


@register(f"WITH {_REPOS_SQL} SELECT full_name FROM repos WHERE is_fork AND coalesce(len(topics), 0) = 0")
def untagged_forks(spark: SparkSession, folder: str) -> DataFrame:
    rows = repos(spark, folder).where("is_fork")
    has = rows.select("full_name", F.explode("topics").alias("topic")).select("full_name")
    return rows.select("full_name").join(has, "full_name", "left_anti")


@register("WITH hubs AS (SELECT DISTINCT lower(owner || '/' || name) AS k, id FROM hub_repos) SELECT DISTINCT g.full_name, h.id AS parent_id FROM github_repo g JOIN hubs h ON h.k = lower(g.forked_from)")
def fork_parents(spark: SparkSession, folder: str) -> DataFrame:
    hubs = table(spark, folder, "hub_repos").select(F.lower(F.concat_ws("/", "owner", "name")).alias("k"), F.col("id").alias("parent_id"))
    forks = table(spark, folder, "github_repo").where("forked_from is not null").select("full_name", F.lower("forked_from").alias("k")).distinct()
    return forks.join(hubs, "k").select("full_name", "parent_id").distinct()


# --- text ---------------------------------------------------------------------------------------------------------


@register(rf"""
WITH {_TEXTS_SQL}, parts AS (
    SELECT id, list_filter(list_transform(string_split(replace(readme, chr(13) || chr(10), chr(10)), chr(10) || chr(10)), lambda p: regexp_replace(regexp_replace(regexp_replace(p, {_STRIP}), '^#+', ''), {_STRIP})), lambda p: NOT starts_with(p, '!') AND length(p) >= 50) AS ps FROM texts
)
SELECT id, left(ps[1], 500) AS summary FROM parts
""")
def fallback_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _readmes(spark, folder).select("id", text.first_paragraph(F.col("readme")).alias("summary"))


@register("""
WITH one AS (SELECT DISTINCT repo_id, repo_name, readme_summary, problem_solved, integration_tags FROM enrichment_result)
SELECT repo_id, left(concat_ws(' ', nullif(repo_name, ''), nullif(readme_summary, ''), nullif(problem_solved, ''), 'integrations: ' || nullif(array_to_string(integration_tags, ' '), '')), 2048) AS text FROM one
""")
def embedding_text(spark: SparkSession, folder: str) -> DataFrame:
    one = table(spark, folder, "enrichment_result").select("repo_id", "repo_name", "readme_summary", "problem_solved", "integration_tags").distinct()
    parts = [("", F.col("repo_name")), ("", F.col("readme_summary")), ("", F.col("problem_solved")), ("integrations: ", F.array_join("integration_tags", " "))]
    return one.select("repo_id", text.embedding_text(*parts).alias("text"))


@register("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def event_props(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@register(r"""
WITH items AS (SELECT id, unnest(CAST(CAST(integration_tags AS JSON) AS VARCHAR[])) AS t FROM hub_repos),
names AS (SELECT id, lower(regexp_extract(regexp_replace(t, '^\s+|\s+$', '', 'g'), '^([a-zA-Z0-9_-]+)', 1)) AS package FROM items WHERE t IS NOT NULL)
SELECT id, package, count(*) AS times FROM names WHERE package <> '' GROUP BY ALL
""")
def manifest_packages(spark: SparkSession, folder: str) -> DataFrame:
    tags = F.array_join(F.transform(text.string_items(F.col("integration_tags")), lambda t: F.concat(t, F.lit(">=1.0"))), "\n")
    files = table(spark, folder, "hub_repos").select("id", F.lit("requirements.txt").alias("file"), tags.alias("content"))
    return manifests.packages(files).select("id", F.explode("packages").alias("package")).groupBy("id", "package").agg(F.count("*").alias("times"))


@register(rf"""
WITH {_REPOS_SQL}, parts AS (SELECT full_name, regexp_replace(split_part(description, '.', 1), {_STRIP}) AS s FROM repos)
SELECT full_name, CASE WHEN length(s) > 10 THEN left(s || '.', 255) END AS sentence FROM parts
""")
def first_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return repos(spark, folder).select("full_name", text.first_sentence(F.col("description")).alias("sentence"))


@register(rf"""
WITH one AS (SELECT DISTINCT repo_id, quality_assessment AS q, maturity_level AS m FROM enrichment_result), clean AS (SELECT repo_id, lower(regexp_replace(q, {_STRIP})) AS q, lower(regexp_replace(m, {_STRIP})) AS m FROM one)
SELECT DISTINCT repo_id, CASE WHEN q IN ('high', 'medium', 'low') THEN q ELSE 'medium' END AS quality, CASE WHEN m IN ('research', 'prototype', 'beta', 'production') THEN m END AS maturity FROM clean
""")
def clamped_levels(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "enrichment_result")
    quality_level = text.one_of(F.col("quality_assessment"), ["high", "medium", "low"], "medium")
    return rows.select("repo_id", quality_level.alias("quality"), text.one_of(F.col("maturity_level"), ["research", "prototype", "beta", "production"]).alias("maturity")).distinct()


@register("""
WITH one AS (SELECT DISTINCT repo_id, repo_name, problem_solved, integration_tags FROM enrichment_result)
SELECT repo_id, concat_ws(chr(10), 'name: ' || nullif(repo_name, ''), 'problem: ' || nullif(problem_solved, ''), 'dependencies: ' || nullif(array_to_string(integration_tags[1:20], ', '), '')) AS context FROM one
""")
def prompt_context(spark: SparkSession, folder: str) -> DataFrame:
    one = table(spark, folder, "enrichment_result").select("repo_id", "repo_name", "problem_solved", "integration_tags").distinct()
    listed = F.array_join(F.slice("integration_tags", 1, 20), ", ")
    return one.select("repo_id", text.labelled(("name", F.col("repo_name")), ("problem", F.col("problem_solved")), ("dependencies", listed)).alias("context"))


@register(rf"""
WITH {_REPOS_SQL}, {_META_SQL}, {_TEXTS_SQL}, {_COMMITS_SQL}, {_VOCAB_SQL},
tags AS (SELECT id, unnest(tags) AS tag FROM meta), matches AS (SELECT id, ord, category, count(*) AS n FROM tags JOIN vocab USING (tag) GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, ord) AS rn FROM matches),
paras AS (SELECT id, list_filter(list_transform(string_split(replace(readme, chr(13) || chr(10), chr(10)), chr(10) || chr(10)), lambda p: regexp_replace(regexp_replace(regexp_replace(p, {_STRIP}), '^#+', ''), {_STRIP})), lambda p: NOT starts_with(p, '!') AND length(p) >= 50) AS ps FROM texts)
SELECT r.full_name, r.owner, nullif(r.license_spdx, 'NOASSERTION') AS license, CASE WHEN r.is_fork THEN r.created_at END AS forked_at, array_to_string(m.tags, ',') AS tags, b.category,
    lower(b.category) AS category_id, left(p.ps[1], 500) AS summary, coalesce(w.last7, 0) AS last7, coalesce(w.last30, 0) AS last30, coalesce(w.last90, 0) AS last90
FROM repos r JOIN meta m ON m.id = r.full_name LEFT JOIN best b ON b.id = r.full_name AND b.rn = 1 LEFT JOIN paras p ON p.id = r.name LEFT JOIN windows w ON w.id = r.name WHERE NOT r.is_private
""")
def ingest_payload(spark: SparkSession, folder: str) -> DataFrame:
    """One row a public repo with all that is derived from its metadata, README and commits."""
    meta = _meta(spark, folder)
    category = tagging.primary_category(meta, _vocabulary(spark)).select(F.col("id").alias("full_name"), text.or_null(F.col("category")).alias("category"))
    base = landing.listing(repos(spark, folder)).join(meta.select(F.col("id").alias("full_name"), "tags"), "full_name").join(category, "full_name")
    readme = _readmes(spark, folder).select(F.col("id").alias("name"), text.first_paragraph(F.col("readme")).alias("summary"))
    both = base.join(readme, "name", "left").join(_commit_windows(spark, folder).withColumnRenamed("id", "name"), "name", "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("last7", "last30", "last90")]
    return both.select("full_name", "owner", F.col("license_spdx").alias("license"), "forked_at", F.array_join("tags", ",").alias("tags"), "category", text.slug(F.col("category")).alias("category_id"), "summary", *counts)


@register("""
WITH days AS (SELECT ts, event_type, unnest(generate_series(0, 6)) AS back FROM events), windows AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) - to_days(CAST(back AS INTEGER)) AS "from", event_type FROM days)
SELECT "from", "from" + INTERVAL 7 DAY AS "to", event_type, count(*) AS events FROM windows WHERE "from" + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL 2 DAY FROM events) GROUP BY ALL
""")
def stream_recency(spark: SparkSession, folder: str) -> DataFrame:
    """The sliding windows that a stream of the events has closed, as it writes them."""
    source = f"{folder}/events.parquet*"  # a pattern, as it may be one file
    stream = changes.arriving(spark, source, "event_id long, ts timestamp_ntz, event_type string", files=None).withColumn("ts", F.col("ts").cast("timestamp"))
    out = f"{storage.shared_folder(spark)}/recency-{uuid.uuid4().hex}"
    changes.drained(changes.recency(stream, "ts", "event_type"), f"{out}/rows", f"{out}/at")
    rows = spark.read.schema("from timestamp, to timestamp, event_type string, events long").parquet(f"{out}/rows")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("from", "to")})


# --- versions of a table ------------------------------------------------------------------------------------------

_LATE = "daily_fetched_at >= '2025-10-01'"
_CACHE_SQL = f"""
base AS (SELECT DISTINCT name, github_updated_at, daily_fetched_at, fork_sync_state FROM repo_cache),
old AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY daily_fetched_at DESC NULLS LAST, github_updated_at DESC NULLS LAST) AS rn FROM base WHERE NOT coalesce({_LATE}, false)) WHERE rn = 1),
new AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY daily_fetched_at DESC NULLS LAST, github_updated_at DESC NULLS LAST) AS rn FROM base WHERE coalesce({_LATE}, false)) WHERE rn = 1)"""


def _cache(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, folder, "repo_cache").select("name", "github_updated_at", "daily_fetched_at", "fork_sync_state").distinct()
    late = F.coalesce(F.expr(_LATE), F.lit(False))
    order = [F.desc_nulls_last("daily_fetched_at"), F.desc_nulls_last("github_updated_at")]
    return merging.latest(rows.where(~late), ["name"], *order), merging.latest(rows.where(late), ["name"], *order)


@register(f"WITH {_CACHE_SQL} SELECT * FROM old WHERE name NOT IN (SELECT name FROM new) UNION ALL SELECT * FROM new")
def cache_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return merging.upsert(*_cache(spark, folder), ["name"])


@register(f"WITH {_CACHE_SQL} SELECT o.name, o.github_updated_at, o.daily_fetched_at, coalesce(nullif(n.fork_sync_state, ''), o.fork_sync_state) AS fork_sync_state FROM old o LEFT JOIN new n USING (name)")
def cache_fill(spark: SparkSession, folder: str) -> DataFrame:
    return merging.fill(*_cache(spark, folder), ["name"], ["fork_sync_state"])


@register(f"WITH {_CACHE_SQL} SELECT * FROM old UNION ALL SELECT * FROM new WHERE name NOT IN (SELECT name FROM old)")
def cache_insert_missing(spark: SparkSession, folder: str) -> DataFrame:
    return merging.insert_missing(*_cache(spark, folder), ["name"], F.desc_nulls_last("daily_fetched_at"))


@register("SELECT name, daily_fetched_at, count(*) AS copies FROM repo_cache WHERE NOT coalesce(daily_fetched_at < '2025-06-01', false) GROUP BY ALL")
def cache_expire(spark: SparkSession, folder: str) -> DataFrame:
    kept = merging.expire(table(spark, folder, "repo_cache").select("name", "daily_fetched_at"), F.col("daily_fetched_at"), F.lit("2025-06-01"))
    return kept.groupBy("name", "daily_fetched_at").agg(F.count("*").alias("copies"))


@register("SELECT DISTINCT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1 AS is_current FROM events")
def current_versions(spark: SparkSession, folder: str) -> DataFrame:
    return merging.versions(table(spark, folder, "events").select("event_id", "user_id", "ts"), "user_id", "ts", F.col("event_id"))


@register(f"""
WITH one AS (SELECT DISTINCT name, github_updated_at, weekly_fetched_at, permanent_fetched_at FROM repo_cache)
SELECT name, github_updated_at, weekly_fetched_at, permanent_fetched_at IS NULL AS permanent, coalesce({_days_sql('weekly_fetched_at')} >= 7, true) AS weekly FROM one
""")
def cache_tiers(spark: SparkSession, folder: str) -> DataFrame:
    one = table(spark, folder, "repo_cache").select("name", "github_updated_at", "weekly_fetched_at", "permanent_fetched_at").distinct()
    old = text.whole_days(text.instant(F.col("weekly_fetched_at")), as_of()) >= 7
    return one.select("name", "github_updated_at", "weekly_fetched_at", F.col("permanent_fetched_at").isNull().alias("permanent"), F.coalesce(old, F.lit(True)).alias("weekly"))
