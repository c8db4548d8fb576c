"""More registered queries: what lands, what is merged, what a run reports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight import storage
from quarrylight.functions import budget, scores, text
from quarrylight.functions.sets import stripped
from quarrylight.operators import edges, manifests, merging, quality, runs, tagging, trends
from quarrylight.plans import repository as base
from quarrylight.plans.repository import _STRIP, QUERIES, as_of, register, repos
from quarrylight.sinks import versioned
from quarrylight.sources import landing
from quarrylight.sources.tables import table
from quarrylight.streaming import changes, posting

__all__ = ["QUERIES"]
_REPOS_SQL, _CACHE_SQL = base._REPOS_SQL, base._CACHE_SQL


def _one_cache(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """name and the greatest value of each column of its rows."""
    return table(spark, folder, "repo_cache").groupBy("name").agg(*[F.max(c).alias(c) for c in columns])


# --- what lands ---------------------------------------------------------------------------------------------------


@register(f"""
WITH {_REPOS_SQL}, known AS (SELECT name, max(forked_from) AS parent FROM repo_cache GROUP BY name)
SELECT full_name, coalesce(CASE WHEN full_name < 'm' THEN r.forked_from END, CASE WHEN is_fork THEN parent END) AS forked_from FROM repos r LEFT JOIN known k USING (name)
""")
def parents_hydrated(spark: SparkSession, folder: str) -> DataFrame:
    """The listing's parents, which are missing in a part of it, looked up in the cache."""
    listed = repos(spark, folder).select("full_name", "name", "is_fork", F.when(F.col("full_name") < "m", F.col("forked_from")).alias("forked_from"))
    parents = listed.select("name", "full_name").join(_one_cache(spark, folder, "forked_from"), "name").select("full_name", "forked_from")
    return landing.with_parents(listed, parents).select("full_name", "forked_from")


@register(f"""
WITH {_REPOS_SQL}, c AS (SELECT name, max(upstream_created_at) AS created, max(parent_stars) AS s, max(parent_forks) AS f, max(parent_archived) AS a FROM repo_cache GROUP BY name)
SELECT full_name, coalesce(nullif(split_part(forked_from, '/', 1), ''), 'unknown') AS upstream_owner, coalesce(nullif(split_part(forked_from, '/', 2), ''), 'unknown') AS upstream_repo,
    coalesce(created, '') AS upstream_created_at, coalesce(s, 0) AS parent_stars, coalesce(f, 0) AS parent_forks, coalesce(a > 0, false) AS parent_archived FROM repos r LEFT JOIN c USING (name) WHERE is_fork
""")
def fork_infos(spark: SparkSession, folder: str) -> DataFrame:
    cache = _one_cache(spark, folder, "upstream_created_at", "parent_stars", "parent_forks", "parent_archived")
    both = repos(spark, folder).join(cache, "name", "left")
    info = landing.fork_info(F.col("is_fork"), F.col("forked_from"), F.col("upstream_created_at"), F.col("parent_stars"), F.col("parent_forks"), F.col("parent_archived") > 0)
    return both.select("full_name", info.alias("i")).where("i is not null").select("full_name", "i.*")


@register("SELECT name AS id, max(readme_content) AS readme FROM repo_cache GROUP BY name")
def decoded_readmes(spark: SparkSession, folder: str) -> DataFrame:
    """READMEs as the interface delivers them, in base64 with line ends, and back."""
    one = _one_cache(spark, folder, "readme_content")
    sent = F.concat(F.regexp_replace(F.base64(F.encode("readme_content", "UTF-8")), "(.{60})", "$1\n"), F.lit("\n"))
    return one.select(F.col("name").alias("id"), landing.decoded_file(sent).alias("readme"))


@register("""
WITH one AS (SELECT name AS id, max(recent_commits) AS c FROM repo_cache GROUP BY name), items AS (SELECT id, unnest(CAST(c AS JSON[])) AS j FROM one WHERE c IS NOT NULL),
parts AS (SELECT id, json_extract_string(j, '$.sha') AS sha, json_extract_string(j, '$.message') AS message, json_extract_string(j, '$.committed_at') AS committed FROM items)
SELECT id, left(sha, 8) AS sha, left(split_part(message, chr(10), 1), 100) AS message, CASE WHEN sha < '4' THEN 'an author' WHEN sha < '8' THEN 'unknown' ELSE 'a committer' END AS author,
    coalesce(committed, '') AS committed_at, CASE WHEN sha < '6' THEN 'https://' || sha ELSE '' END AS url FROM parts
""")
def commit_authors(spark: SparkSession, folder: str) -> DataFrame:
    """Commits as the interface nests them: some without an author, some whose author has no name, some without a url."""
    flat = _one_cache(spark, folder, "recent_commits").select("name", F.explode(F.from_json("recent_commits", landing.COMMITS)).alias("c"))
    sha = F.col("c.sha")
    author = F.when(sha < "8", F.struct(F.when(sha < "4", "an author").alias("name")))
    committer = F.struct(F.lit("a committer").alias("name"), F.col("c.committed_at").alias("date"))
    commit = F.struct(sha.alias("sha"), F.when(sha < "6", F.concat(F.lit("https://"), sha)).alias("html_url"), F.struct(F.col("c.message").alias("message"), author.alias("author"), committer.alias("committer")).alias("commit"))
    delivered = flat.groupBy(F.col("name").alias("id")).agg(F.to_json(F.collect_list(commit)).alias("raw"))
    return landing.raw_commits(delivered, "id", "raw")


@register("SELECT name AS id, coalesce(json_extract_string(r, '$.tag_name'), '') AS tag_name, json_extract_string(r, '$.name') AS title, coalesce(json_extract_string(r, '$.published_at'), '') AS published_at FROM (SELECT name, max(latest_release) AS r FROM repo_cache GROUP BY name) WHERE r IS NOT NULL")
def releases(spark: SparkSession, folder: str) -> DataFrame:
    one = _one_cache(spark, folder, "latest_release").select(F.col("name").alias("id"), landing.release(F.col("latest_release")).alias("r")).where("r is not null")
    return one.select("id", "r.tag_name", F.col("r.name").alias("title"), "r.published_at")


@register(f"""
WITH {_REPOS_SQL} SELECT full_name, stars % 2 = 0 OR stars % 5 = 0 AS has_tests, coalesce(forks_count % 3 = 0, false) AS has_ci FROM repos
""")
def root_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Root paths that counts stand for: tests of several spellings, build files in the right case and the wrong one."""
    paths = F.array(F.lit("README.md"), F.when(F.col("stars") % 2 == 0, "Tests"), F.when(F.col("stars") % 5 == 0, "test_all.py"), F.when(F.col("forks_count") % 3 == 0, ".github"), F.lit("jenkinsfile"), F.lit("testing"))
    listed = repos(spark, folder).select("full_name", F.array_compact(paths).alias("paths"))
    return listed.select("full_name", text.has_tests(F.col("paths")).alias("has_tests"), text.has_ci(F.col("paths")).alias("has_ci"))


@register("""
WITH flat AS (SELECT full_name, stars, list_sort(list_distinct(list_filter(topics, lambda t: t IS NOT NULL))) AS topics FROM github_repo)
SELECT DISTINCT full_name, stars, unnest(topics) AS topic FROM flat
""")
def library_items(spark: SparkSession, folder: str) -> DataFrame:
    """A nested file as the interface delivers it, one document a hundredth, written when called, and read back."""
    item = F.struct("full_name", "stars", F.array_sort(F.array_distinct(F.array_compact("topics"))).alias("topics"))
    documents = table(spark, folder, "github_repo").groupBy(F.pmod(F.xxhash64("full_name"), F.lit(100)).alias("n")).agg(F.collect_list(item).alias("l"))  # a hundredth stands for a page of the interface
    out = f"{storage.shared_folder(spark)}/library-{uuid.uuid4().hex}"
    documents.select(F.when(F.col("n") % 2 == 0, F.col("l")).alias("repos"), F.when(F.col("n") % 2 == 1, F.col("l")).alias("items")).write.json(out)
    rows = "array<struct<full_name:string,stars:int,topics:array<string>>>"
    return landing.nested(landing.json_files(spark, out, f"repos {rows}, items {rows}"), "repos", "items").select("full_name", "stars", F.explode("topics").alias("topic")).distinct()


_FORK_DATES_SQL = f"{_REPOS_SQL}, d AS (SELECT name, max(upstream_created_at) AS u, max(permanent_fetched_at) AS p FROM repo_cache GROUP BY name)"


@register(f"WITH {_FORK_DATES_SQL} SELECT full_name FROM repos LEFT JOIN d USING (name) WHERE is_fork AND (u IS NULL OR p IS NULL OR pushed_at IS NULL)")
def forks_missing_dates(spark: SparkSession, folder: str) -> DataFrame:
    both = repos(spark, folder).join(_one_cache(spark, folder, "upstream_created_at", "permanent_fetched_at"), "name", "left")
    return quality.missing_dates(both, "upstream_created_at", "permanent_fetched_at", "pushed_at").select("full_name")


@register(f"WITH {_REPOS_SQL} SELECT full_name FROM repos WHERE primary_language IN ('Python', 'Go', 'Rust')")
def named_repos(spark: SparkSession, folder: str) -> DataFrame:
    """A list of names as a command line gives it, with commas and spaces."""
    wanted = spark.createDataFrame([("Python, Go", ), ("  Rust,,",)], "names string").select(F.explode(text.listed_names(F.col("names"))).alias("primary_language")).distinct()
    return repos(spark, folder).join(F.broadcast(wanted), "primary_language", "left_semi").select("full_name")


_TAGS_SQL = f"flat AS (SELECT id, is_fork, parent_stars, unnest(CAST(CAST(integration_tags AS JSON) AS VARCHAR[])) AS t FROM hub_repos), items AS (SELECT id, is_fork, parent_stars, regexp_replace(t, {_STRIP}) AS t FROM flat WHERE regexp_replace(t, {_STRIP}) <> '')"


def _manifest_texts(items: Column) -> dict[str, Column]:
    """What a project with these dependencies writes into each kind of manifest."""
    lines = lambda before, after, sep="\n": F.array_join(F.transform(items, lambda t: F.concat(F.lit(before), t, F.lit(after))), sep)
    halves = F.floor(F.size(items) / 2).cast("int")
    quoted = lambda part: F.array_join(F.transform(part, lambda t: F.concat(F.lit('"'), t, F.lit('": "^1.2.0"'))), ", ")
    return {
        "requirements.txt": F.concat(F.lit("# pinned\n-r base.txt\n\n"), lines("", ">=1.2,<2  # why\r\n", "")),
        "pyproject.toml": F.concat(F.lit('[project]\nname = "p"\ndependencies = [\n'), lines('    "', '>=1.2",\n', ""), F.lit(']\n[tool.black]\nline-length = 88\n')),
        "package.json": F.concat(F.lit('{"name": "p", "dependencies": {'), quoted(F.slice(items, F.lit(1), halves)), F.lit('}, "devDependencies": {'), quoted(F.slice(items, halves + 1, F.size(items))), F.lit("}}")),
        "setup.py": F.concat(F.lit("from setuptools import setup\nsetup(name='p', install_requires=[\n"), lines("    '", ">=1.2',\n", ""), F.lit("])\n")),
        "go.mod": F.concat(F.lit("module code.example/p\n\ngo 1.22\n\nrequire (\n"), lines("\tcode.example/", " v1.2.0 // indirect\n", ""), F.lit(")\n\nrequire code.example/Single v0.1.0\n")),
        "Cargo.toml": F.concat(F.lit('[package]\nname = "p"\n\n[dependencies]\n# pinned\n'), lines("", ' = "1.2"\n', ""), F.lit('\n[profile.release]\nlto = true\n')),
    }


def _hub_items(spark: SparkSession, folder: str) -> DataFrame:
    items = F.filter(F.transform(text.string_items(F.col("integration_tags")), stripped), lambda t: t != "")
    return table(spark, folder, "hub_repos").select("id", "is_fork", "parent_stars", items.alias("items"))


@register(rf"""
WITH {_TAGS_SQL}, heads AS (SELECT id, lower(regexp_extract(t, '^([a-zA-Z0-9_-]+)', 1)) AS package FROM items),
found AS (
    SELECT id, f AS file, package FROM heads, (VALUES ('requirements.txt'), ('pyproject.toml'), ('setup.py')) v(f) WHERE package <> ''
    UNION ALL SELECT DISTINCT id, 'package.json', t FROM items
    UNION ALL SELECT id, 'go.mod', 'code.example/' || t FROM items UNION ALL SELECT id, 'go.mod', 'code.example/Single' FROM hub_repos
    UNION ALL SELECT id, 'Cargo.toml', t FROM items
)
SELECT id, file, package, count(*) AS times FROM found GROUP BY ALL
""")
def manifest_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """Every kind of manifest, as it is written with comments, sections and pins, parsed."""
    texts = F.array(*[F.struct(F.lit(name).alias("file"), content.alias("content")) for name, content in _manifest_texts(F.col("items")).items()])
    files = _hub_items(spark, folder).select("id", F.explode(texts).alias("f")).select("id", "f.file", "f.content")
    return manifests.packages(files).select("id", "file", F.explode("packages").alias("package")).groupBy("id", "file", "package").agg(F.count("*").alias("times"))


_CHOSEN_SQL = rf"""{_TAGS_SQL}, heads AS (SELECT id, is_fork, parent_stars, lower(regexp_extract(t, '^([a-zA-Z0-9_-]+)', 1)) AS package, t FROM items),
found AS (
    SELECT DISTINCT id, t AS package, 'npm' AS ecosystem, 'package.json' AS source_file, true AS is_direct FROM heads WHERE is_fork
    UNION ALL SELECT DISTINCT id, package, 'pypi', 'requirements.txt', true FROM heads WHERE NOT is_fork AND parent_stars IS NULL AND package <> ''
),
chosen AS (SELECT * FROM found UNION ALL SELECT id, '__none__', '__sentinel__', NULL, false FROM hub_repos WHERE id NOT IN (SELECT id FROM found))"""


def _chosen(spark: SparkSession, folder: str) -> DataFrame:
    items = _hub_items(spark, folder)
    texts = _manifest_texts(F.col("items"))
    own = items.select("id", F.lit(False).alias("upstream"), F.lit("requirements.txt").alias("file"), F.when(F.col("parent_stars").isNull(), texts["requirements.txt"]).otherwise(F.lit("# none\n")).alias("content"))
    theirs = items.where("is_fork").select("id", F.lit(True).alias("upstream"), F.lit("package.json").alias("file"), texts["package.json"].alias("content"))
    return manifests.chosen_packages(own.unionByName(theirs))


@register(f"WITH {_CHOSEN_SQL} SELECT * FROM chosen")
def manifest_chosen(spark: SparkSession, folder: str) -> DataFrame:
    """Of several manifests the one that counts; `__none__` where none declares anything."""
    return _chosen(spark, folder)


@register(f"WITH {_CHOSEN_SQL}, per AS (SELECT id, count(*) FILTER (is_direct) AS n FROM chosen GROUP BY id) SELECT count(*) AS total, count(*) FILTER (n > 0) AS with_deps, count(*) FILTER (n = 0) AS no_deps, CAST(sum(n) AS BIGINT) AS packages FROM per")
def dependency_counts(spark: SparkSession, folder: str) -> DataFrame:
    return manifests.dependency_counts(_chosen(spark, folder))


@register(f"WITH {_CHOSEN_SQL} SELECT DISTINCT id, CASE source_file WHEN 'package.json' THEN 'npm' WHEN 'requirements.txt' THEN 'pypi' ELSE 'none' END AS ecosystem FROM chosen")
def file_ecosystems(spark: SparkSession, folder: str) -> DataFrame:
    """The ecosystem of a file in a folder, by its name; a default where there is no file."""
    one = _chosen(spark, folder).select("id", F.concat(F.lit("sub/"), "source_file").alias("path")).distinct()
    return one.select("id", text.filled(F.lit(None).cast("string"), text.file_name(F.col("path")), manifests.ECOSYSTEMS, "none").alias("ecosystem"))


# --- merges -------------------------------------------------------------------------------------------------------


@register(f"WITH {_CACHE_SQL} SELECT n.name, n.github_updated_at FROM new n LEFT JOIN old o USING (name) WHERE o.name IS NULL OR n.github_updated_at IS DISTINCT FROM o.github_updated_at")
def changed_rows(spark: SparkSession, folder: str) -> DataFrame:
    old, new = base._cache(spark, folder)
    return changes.changed_only(old, new, "name", "github_updated_at").select("name", "github_updated_at")


_GROUPS_SQL = """
cat AS (SELECT repo_id, error, unnest(categories) AS category FROM enrichment_result),
old AS (SELECT repo_id, category FROM cat WHERE error IS NULL), new AS (SELECT repo_id, category FROM cat WHERE error IS NOT NULL)"""


@register(f"WITH {_GROUPS_SQL}, kept AS (SELECT * FROM old WHERE repo_id NOT IN (SELECT repo_id FROM new) UNION ALL SELECT * FROM new) SELECT repo_id, category, count(*) AS n FROM kept GROUP BY ALL")
def groups_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """All categories of a repo give way to those delivered again."""
    rows = table(spark, folder, "enrichment_result").select("repo_id", "error", F.explode("categories").alias("category"))
    kept = merging.replace_groups(rows.where("error is null").drop("error"), rows.where("error is not null").drop("error"), ["repo_id"])
    return kept.groupBy("repo_id", "category").agg(F.count("*").alias("n"))


@register("SELECT count(*) FILTER (NOT coalesce(daily_fetched_at < '2025-06-01', false)) AS kept, count(*) FILTER (coalesce(daily_fetched_at < '2025-06-01', false)) AS deleted FROM repo_cache")
def cache_expired(spark: SparkSession, folder: str) -> DataFrame:
    return runs.expired(table(spark, folder, "repo_cache"), F.col("daily_fetched_at"), F.lit("2025-06-01"))


@register(f"""
WITH {_REPOS_SQL}, w AS (SELECT user_id, CAST(count(*) AS INTEGER) AS n FROM events GROUP BY user_id)
SELECT full_name, CASE WHEN stars % 3 = 0 THEN open_issues_count ELSE coalesce(n, open_issues_count) END AS open_issues_count FROM repos LEFT JOIN w ON user_id = stars % 200
""")
def weekly_null_keeps(spark: SparkSession, folder: str) -> DataFrame:
    """Counts that a scan delivered take the place of old ones; where it delivered null, the old ones stay."""
    old = repos(spark, folder).select("full_name", "open_issues_count", "stars")
    counts = table(spark, folder, "events").groupBy("user_id").agg(F.count("*").cast("int").alias("n"))
    new = old.join(counts, F.col("user_id") == F.col("stars") % 200).select("full_name", F.when(F.col("stars") % 3 != 0, F.col("n")).alias("open_issues_count"))
    return merging.fill(old.drop("stars"), new, ["full_name"], ["open_issues_count"])


# --- joins and counts ---------------------------------------------------------------------------------------------


@register(f"""
WITH {base._EDGES_SQL}, ids AS (SELECT lower(repo_id) AS id FROM enrichment_result UNION SELECT id FROM hub_repos)
SELECT source, target, edge_type FROM one WHERE NOT EXISTS (SELECT 1 FROM ids WHERE ids.id = source) OR NOT EXISTS (SELECT 1 FROM ids WHERE ids.id = target)
""")
def orphan_edges(spark: SparkSession, folder: str) -> DataFrame:
    ids = table(spark, folder, "enrichment_result").select(F.lower("repo_id").alias("id")).unionByName(table(spark, folder, "hub_repos").select("id"))
    return quality.orphans(base.current_edges(spark, folder), ids).select("source", "target", "edge_type")


_HAS = {"categories": "categories", "tags": "integration_tags", "skills": "skill_areas", "industries": "industries", "cases": "use_cases"}
_UNCOVERED_SQL = ", ".join(f"(SELECT count(*) FROM ids WHERE name NOT IN (SELECT repo_name FROM enrichment_result WHERE len({c}) > 0)) AS no_{n}" for n, c in _HAS.items())


@register(f"WITH ids AS (SELECT DISTINCT name FROM github_repo) SELECT (SELECT count(*) FROM ids) AS repos, {_UNCOVERED_SQL}")
def uncovered_repos(spark: SparkSession, folder: str) -> DataFrame:
    results = table(spark, folder, "enrichment_result")
    parts = {n: results.where(F.size(c) > 0).select(F.col("repo_name").alias("id")) for n, c in _HAS.items()}
    return quality.uncovered(table(spark, folder, "github_repo").select(F.col("name").alias("id")).distinct(), **parts)


@register("SELECT (SELECT count(*) FROM repo_cache) AS total_repos, (SELECT count(permanent_fetched_at) FROM repo_cache) AS permanent_cached, (SELECT count(daily_fetched_at) FROM repo_cache) AS daily_cached, (SELECT count(DISTINCT snapshot_id) FROM trend_snapshot) AS total_runs, (SELECT count(*) FROM events) AS total_api_calls_logged")
def cache_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """The cache, its runs (one left a snapshot each) and its log of calls (the events)."""
    return runs.statistics(table(spark, folder, "repo_cache"), table(spark, folder, "trend_snapshot").select("snapshot_id").distinct(), table(spark, folder, "events"))


@register("""
WITH ranked AS (
    SELECT a.vec_id AS source, b.vec_id AS target, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
),
best AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY s DESC, target) AS rank FROM ranked)
SELECT best.source, target, rank, repo_full_name, lang FROM best LEFT JOIN documents ON doc_id = target WHERE rank <= 5
""")
def semantic_hits(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest vectors with what their documents say of themselves."""
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("target"), "repo_full_name", "lang")
    return base.semantic_topk(spark, folder).select("source", "target", "rank").join(documents, "target", "left")


@register("SELECT id AS repo_id, name, owner, description, primary_category, coalesce(stargazers_count, 0)::BIGINT AS stars, CASE WHEN stargazers_count > 0 THEN round(log10(stargazers_count + 1), 4) ELSE 0.0 END AS stars_log, round(parent_stars / 1000.0, 4) AS quality, strftime(updated_at, '%Y-%m-%dT%H:%M:%S+00:00') AS updated_at FROM hub_repos WHERE NOT is_private")
def graph_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """The public nodes of the graph; signals of quality come as JSON."""
    signals = F.to_json(F.struct((F.col("parent_stars") / 1000).alias("overall"), F.lit("x").alias("other")))
    return edges.public_nodes(table(spark, folder, "hub_repos").withColumn("quality_signals", signals).withColumnRenamed("stargazers_count", "stars"))


@register("""
WITH typed AS (SELECT count(*) AS n FROM repo_edges), public AS (SELECT count(*) AS n FROM hub_repos WHERE NOT is_private)
SELECT public.n AS nodes, 0::BIGINT AS similarity_edges, typed.n AS typed_edges, true AS published FROM typed, public
""")
def graph_published(spark: SparkSession, folder: str) -> DataFrame:
    """A snapshot, published when called and read back through its pointer: how many lines each part has."""
    root = f"{storage.shared_folder(spark)}/snapshot-{uuid.uuid4().hex}"
    typed = table(spark, folder, "repo_edges").select("source_repo_id", "target_repo_id", "edge_type", "weight")
    done = versioned.snapshot(graph_nodes(spark, folder), typed.where("1 = 0"), typed, {"least": "0.4"}, root)
    current = versioned.Versions(root).current(spark)
    lines = [spark.read.text(f"{current}/{part}").agg(F.count("*").alias(part)) for part in ("nodes", "similarity_edges", "typed_edges")]
    return lines[0].crossJoin(lines[1]).crossJoin(lines[2]).withColumn("published", F.lit(current == done["folder"] and done["size_bytes"] > 0))  # one row each


# --- reports ------------------------------------------------------------------------------------------------------

_CATEGORY_SQL = base._MATCH_SQL + ", lists AS (SELECT id, list(category ORDER BY ord) AS c FROM matches GROUP BY id)"


def _categorised(spark: SparkSession, folder: str) -> DataFrame:
    meta = base._meta(spark, folder)
    dates = repos(spark, folder).select(F.col("full_name").alias("id"), text.instant(F.col("updated_at")).alias("updated"))
    return meta.select("id", "tags").join(tagging.all_categories(meta, base._vocabulary(spark)), "id").join(dates, "id")


@register(_CATEGORY_SQL + f""",
t AS (SELECT tag, count(*) AS n FROM tags GROUP BY tag), k AS (SELECT category, count(*) AS n FROM (SELECT unnest(c) AS category FROM lists) GROUP BY category)
SELECT TIMESTAMP '{base.AS_OF}' AS captured_at, (SELECT count(*) FROM meta) AS total_repos, (SELECT count(*) FROM meta WHERE list_contains(tags, 'Active')) AS active_repos,
    (SELECT count(*) FROM repos WHERE {base._ISO_SQL.format('updated_at')} > TIMESTAMP '{base.AS_OF}' - INTERVAL 30 DAY) AS new_repos_last_30d,
    (SELECT string_agg(tag, ',' ORDER BY n DESC, tag) FROM (SELECT * FROM t ORDER BY n DESC, tag LIMIT 20)) AS top_tags,
    (SELECT string_agg(category, ',' ORDER BY n DESC, category) FROM (SELECT * FROM k ORDER BY n DESC, category LIMIT 10)) AS top_categories,
    (SELECT string_agg(tag || '=' || n, ',' ORDER BY tag) FROM t) AS tag_counts, (SELECT string_agg(category || '=' || n, ',' ORDER BY category) FROM k) AS category_counts
""")
def trend_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshot of a day as one row; its maps as text, so that rows can be compared."""
    one = trends.snapshot(_categorised(spark, folder), as_of())
    shown = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return one.withColumns({"top_tags": F.array_join("top_tags", ","), "top_categories": F.array_join("top_categories", ","), "tag_counts": shown("tag_counts"), "category_counts": shown("category_counts")})


@register(f"WITH {base._PRIMARY_SQL} SELECT category AS item, count(*) AS repos FROM firsts GROUP BY category ORDER BY repos DESC, item LIMIT 10")
def trend_top_categories(spark: SparkSession, folder: str) -> DataFrame:
    counts = base._primary(spark, folder).groupBy(F.col("category").alias("item")).agg(F.count("*").alias("repos"))
    return trends.top(counts, 10)


@register(base.SQL["probe_verdict"].replace('SELECT "check", failed, failed = 0 AS passed FROM verdicts', "SELECT bool_and(failed = 0) AS passed, CASE WHEN bool_and(failed = 0) THEN 0 ELSE 1 END AS exit_code FROM verdicts"))
def probe_overall(spark: SparkSession, folder: str) -> DataFrame:
    return quality.overall(base.probe_verdict(spark, folder))


@register("WITH names AS (SELECT DISTINCT name FROM github_repo), few AS (SELECT name FROM names ORDER BY name LIMIT 200) SELECT (SELECT count(*) FROM names) AS upserted, string_agg(name, ',' ORDER BY name) AS repo_names FROM few")
def ingested_message(spark: SparkSession, folder: str) -> DataFrame:
    """The message on a run, as its reader sees it."""
    sent = versioned.ingested_event(table(spark, folder, "github_repo").select("name").distinct())
    read = sent.select(F.from_json("json", "upserted long, repo_names array<string>").alias("m"))
    return read.select("m.upserted", F.array_join("m.repo_names", ",").alias("repo_names"))


def _accepting(rows: list[dict]) -> tuple[int, str]:
    return (401, "refused") if len(rows) > 50 else (200, "")


@register("SELECT CAST(count(*) AS BIGINT) AS upserted, false AS any_failed FROM trend_snapshot")
def snapshots_posted(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots handed on in batches of at most 50, to a stand-in that refuses more."""
    sent = posting.totals(posting.posted(table(spark, folder, "trend_snapshot").select("snapshot_id", "captured_at", "total_repos", "tag_counts"), _accepting, pause=0.0))
    return sent.select("upserted", (F.col("failed") > 0).alias("any_failed"))


# --- runs ---------------------------------------------------------------------------------------------------------

_RUNS_SQL = """
one AS (SELECT snapshot_id AS run, min(captured_at) AS at, max(active_repos) AS n FROM trend_snapshot GROUP BY snapshot_id),
runs AS (SELECT run, CASE WHEN run % 7 = 0 THEN 'running' WHEN run % 5 = 0 THEN 'failed' ELSE 'success' END AS status, CASE WHEN run % 7 = 0 OR run % 5 = 0 AND run % 2 = 0 THEN 'at-' || run END AS checkpoint,
    CASE WHEN run % 7 <> 0 AND run % 5 = 0 THEN 'lost' END AS error, CASE WHEN run % 7 <> 0 AND run % 5 <> 0 THEN coalesce(n, 0) END AS edges FROM one)"""


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    """The log of runs that the snapshots stand for: all start, some write checkpoints, most end."""
    one = table(spark, folder, "trend_snapshot").groupBy(F.col("snapshot_id").alias("run")).agg(F.min("captured_at").alias("at"), F.max("active_repos").alias("n"))
    empty = {"checkpoint": F.lit(None).cast("string"), "counts": F.lit(None).cast("map<string,bigint>"), "error": F.lit(None).cast("string")}

    def change(rows: DataFrame, seq: int, status: str, **set_: Column) -> DataFrame:
        at = F.timestamp_micros(F.col("run") * 3_600_000_000 + F.lit(seq)).cast("timestamp_ntz")
        return rows.select("run", F.lit(seq).cast("long").alias("seq"), F.lit(status).alias("status"), at.alias("at"), *[(set_.get(k, v)).alias(k) for k, v in empty.items()])

    running, failed = F.col("run") % 7 == 0, (F.col("run") % 7 != 0) & (F.col("run") % 5 == 0)
    log = change(one, 1, "running").unionByName(change(one.where(running | (F.col("run") % 2 == 0)), 2, "running", checkpoint=F.concat(F.lit("at-"), F.col("run").cast("string"))))
    log = log.unionByName(change(one.where(failed), 3, "failed", error=F.lit("lost")))
    log = log.unionByName(change(one.where(~running & ~failed), 3, "success", counts=F.create_map(F.lit("EXTENDS"), F.coalesce("n", F.lit(0)).cast("long"))))
    return runs.current(log)


@register(f"WITH {_RUNS_SQL} SELECT run, status, checkpoint, error, edges::BIGINT AS edges FROM runs")
def run_states(spark: SparkSession, folder: str) -> DataFrame:
    return _runs(spark, folder).select("run", "status", "checkpoint", "error", F.element_at("counts", "EXTENDS").alias("edges"))


@register(f"WITH {_RUNS_SQL} SELECT run, checkpoint FROM runs WHERE status = 'running' ORDER BY run DESC LIMIT 1")
def crashed_run(spark: SparkSession, folder: str) -> DataFrame:
    return runs.crashed(_runs(spark, folder))


@register(f"WITH {_RUNS_SQL} SELECT 'EXTENDS' AS edge_type, edges::BIGINT AS edges FROM runs WHERE status = 'success' ORDER BY run DESC LIMIT 1")
def prior_edge_counts(spark: SparkSession, folder: str) -> DataFrame:
    return runs.prior_counts(_runs(spark, folder))


@register("SELECT DISTINCT name FROM github_repo WHERE name NOT IN (SELECT repo_name FROM enrichment_result WHERE error IS NULL)")
def resumed_names(spark: SparkSession, folder: str) -> DataFrame:
    """What a run that goes on has still to do: all but what is marked as done."""
    progress = table(spark, folder, "enrichment_result").select(F.col("repo_name").alias("name"), F.when(F.col("error").isNull(), "done").otherwise("failed").alias("status"))
    return runs.pending(table(spark, folder, "github_repo"), progress, "name")


@register("""
WITH m(mode) AS (VALUES ('quick'), ('weekly'), ('full'), ('fix')), n AS (SELECT snapshot_id, max(total_repos) AS r, max(active_repos) AS a FROM trend_snapshot GROUP BY snapshot_id),
c AS (SELECT snapshot_id, mode, a, CASE mode WHEN 'quick' THEN 7 + greatest(1, r // 10) * 3 WHEN 'weekly' THEN 7 + greatest(1, r // 10) * 3 + r * 2 + greatest(1, r // 3) WHEN 'full' THEN 7 + r * 5 ELSE 7 END AS calls FROM n, m)
SELECT snapshot_id, mode, calls::BIGINT AS calls, CASE WHEN a IS NULL OR a >= calls + 100 THEN 'ok' WHEN a < 100 THEN 'wait' ELSE 'warn' END AS decision FROM c
""")
def call_budgets(spark: SparkSession, folder: str) -> DataFrame:
    """What each mode costs at a snapshot's size, against a budget of as many calls as repos were active."""
    one = table(spark, folder, "trend_snapshot").groupBy("snapshot_id").agg(F.max("total_repos").alias("r"), F.max("active_repos").alias("a"))
    rows = one.select("*", F.explode(F.array(*map(F.lit, ("quick", "weekly", "full", "fix")))).alias("mode"))
    rows = rows.withColumn("calls", budget.estimated_calls(F.col("mode"), F.col("r")))
    return rows.select("snapshot_id", "mode", "calls", budget.decision(F.col("a"), F.col("calls")).alias("decision"))


# --- models -------------------------------------------------------------------------------------------------------


@register(f"""
WITH one AS (SELECT DISTINCT repo_id, problem_solved, quality_assessment AS q, maturity_level AS m, use_cases FROM enrichment_result)
SELECT repo_id, problem_solved, CASE WHEN lower(regexp_replace(q, {_STRIP})) IN ('high', 'medium', 'low') THEN lower(regexp_replace(q, {_STRIP})) ELSE 'medium' END AS quality,
    CASE WHEN lower(regexp_replace(m, {_STRIP})) IN ('research', 'prototype', 'beta', 'production') THEN lower(regexp_replace(m, {_STRIP})) END AS maturity,
    array_to_string(list_filter(list_transform(coalesce(use_cases, []), lambda x: regexp_replace(x, {_STRIP})), lambda x: x <> ''), '|') AS cases FROM one
""")
def model_replies(spark: SparkSession, folder: str) -> DataFrame:
    """A model's fenced JSON replies, parsed and held to what their fields allow. Repeats in a list stay here, so that SQL can follow."""
    one = table(spark, folder, "enrichment_result").select("repo_id", "problem_solved", "quality_assessment", "maturity_level", "use_cases").distinct()
    reply = F.concat(F.lit("```json\n"), F.to_json(F.struct("problem_solved", "quality_assessment", "maturity_level", "use_cases")), F.lit("\n```"))
    parsed = one.select("repo_id", text.model_reply(reply, "problem_solved string, quality_assessment string, maturity_level string, use_cases array<string>").alias("r"))
    cases = F.filter(F.transform(F.coalesce("r.use_cases", F.array().cast("array<string>")), stripped), lambda x: x != "")
    return parsed.select("repo_id", "r.problem_solved", text.one_of(F.col("r.quality_assessment"), ["high", "medium", "low"], "medium").alias("quality"), text.one_of(F.col("r.maturity_level"), ["research", "prototype", "beta", "production"]).alias("maturity"), F.array_join(cases, "|").alias("cases"))


DEFAULTS = {"crawl pipelines": "Data Platform", "schema tooling": "Developer Platform", "vector stores": "Search"}


@register(f"""
WITH {base._PRIMARY_SQL}, s AS (SELECT repo_id AS id, min(skill_areas[1]) AS skill FROM enrichment_result GROUP BY repo_id)
SELECT s.id, coalesce(nullif(skill, ''), CASE category {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in DEFAULTS.items())} END, 'Other') AS skill FROM s LEFT JOIN firsts f USING (id)
""")
def default_skills(spark: SparkSession, folder: str) -> DataFrame:
    """A missing skill is filled by the category's default."""
    skills = table(spark, folder, "enrichment_result").groupBy(F.col("repo_id").alias("id")).agg(F.min(F.get("skill_areas", F.lit(0))).alias("skill"))
    both = skills.join(base._primary(spark, folder), "id", "left")
    return both.select("id", text.filled(F.col("skill"), F.col("category"), DEFAULTS, "Other").alias("skill"))


@register("SELECT event_id, round(CAST(json_extract_string(props, '$.k') AS DOUBLE) / 7, 4) AS quality FROM events")
def quality_signals(spark: SparkSession, folder: str) -> DataFrame:
    signals = F.to_json(F.struct((F.get_json_object("props", "$.k").cast("double") / 7).alias("overall")))
    return table(spark, folder, "events").select("event_id", scores.quality_overall(signals).alias("quality"))
