"""What a repository host's interfaces deliver, from JSON landed in files to typed rows. Fetching it is left to a connector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "array<struct<sha:string,message:string,committed_at:string>>"
#: Commits as the interface gives them.
RAW_COMMITS = "array<struct<sha:string,html_url:string,commit:struct<message:string,author:struct<name:string>,committer:struct<name:string,date:string>>>>"
RELEASE = "struct<tag_name:string,name:string,published_at:string,html_url:string>"


def json_files(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """JSON files of a given schema; nothing is inferred."""
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def nested(documents: DataFrame, *names: str) -> DataFrame:
    """The rows of the first array of these names that a document has, as columns."""
    return documents.select(F.explode(F.coalesce(*[F.col(n) for n in names])).alias("row")).select("row.*")


def listing(repos: DataFrame) -> DataFrame:
    """Public repos; a licence that asserts nothing is null, a push date that is missing is the update's, and a fork's creation is its forking."""
    return (
        repos.where(~F.coalesce("is_private", F.lit(False)))
        .withColumn("license_spdx", F.nullif("license_spdx", F.lit("NOASSERTION")))
        .withColumn("pushed_at", F.coalesce("pushed_at", "updated_at"))
        .withColumn("forked_at", F.when(F.col("is_fork"), F.col("created_at")))
    )


def with_parents(repos: DataFrame, parents: DataFrame) -> DataFrame:
    """repos with forked_from of forks that lack it taken from parents (full_name, forked_from)."""
    known = parents.groupBy("full_name").agg(F.min("forked_from").alias("_parent"))
    return repos.join(known, "full_name", "left").withColumn("forked_from", F.coalesce("forked_from", F.when(F.col("is_fork"), F.col("_parent")))).drop("_parent")


def decoded_file(content: Column) -> Column:
    """The text of a file delivered in base64 with line ends; bytes that aren't UTF-8 become U+FFFD."""
    return F.decode(F.unbase64(F.regexp_replace(content, r"\s", "")), "UTF-8")


def commits(rows: DataFrame, key: str, column: str, most: int = 30) -> DataFrame:
    """key, sha (8 characters), message (its first line, 100 characters), committed_at of the first `most` commits of a JSON list."""
    flat = rows.select(key, F.explode(F.slice(F.from_json(column, COMMITS), 1, most)).alias("c"))
    return flat.select(key, F.substring("c.sha", 1, 8).alias("sha"), F.substring(F.substring_index("c.message", "\n", 1), 1, 100).alias("message"), F.col("c.committed_at").alias("committed_at"))


def raw_commits(rows: DataFrame, key: str, column: str, most: int = 30) -> DataFrame:
    """key, sha, message, author, committed_at, url of the first `most` commits as the interface gives them.

    The committer stands for an author who is missing, `unknown` for one without a name; a missing date or url is empty.
    """
    flat = rows.select(key, F.explode(F.slice(F.from_json(column, RAW_COMMITS), 1, most)).alias("c"))
    author = F.when(F.col("c.commit.author").isNotNull(), F.col("c.commit.author.name")).otherwise(F.col("c.commit.committer.name"))
    message = F.substring(F.substring_index(F.coalesce("c.commit.message", F.lit("")), "\n", 1), 1, 100)
    text = lambda c: F.coalesce(c, F.lit(""))
    return flat.select(key, F.substring("c.sha", 1, 8).alias("sha"), message.alias("message"), F.coalesce(author, F.lit("unknown")).alias("author"), text("c.commit.committer.date").alias("committed_at"), text("c.html_url").alias("url"))


def release(column: Column) -> Column:
    """tag_name, name, published_at, url of a release in JSON; null where there is none. Only the name may be null."""
    r = F.from_json(column, RELEASE)
    text = lambda c: F.coalesce(c, F.lit(""))
    return F.when(r.isNotNull(), F.struct(text(r["tag_name"]).alias("tag_name"), r["name"].alias("name"), text(r["published_at"]).alias("published_at"), text(r["html_url"]).alias("url")))


def fork_info(is_fork: Column, parent: Column, created_at: Column, stars: Column, forks: Column, archived: Column) -> Column:
    """What is known of a fork's parent (owner/name), unknown, empty, 0 or false where nothing is; null of repos that aren't forks."""
    part = lambda n: F.coalesce(F.nullif(F.split_part(parent, F.lit("/"), F.lit(n)), F.lit("")), F.lit("unknown"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    known = F.struct(part(1).alias("upstream_owner"), part(2).alias("upstream_repo"), F.coalesce(created_at, F.lit("")).alias("upstream_created_at"), zero(stars).alias("parent_stars"), zero(forks).alias("parent_forks"), F.coalesce(archived, F.lit(False)).alias("parent_archived"))
    return F.when(F.coalesce(is_fork, F.lit(False)), known)
