"""Tags, categories and builders of repositories by vocabularies given as parameters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylight.functions.text import instant, keyword_pattern, whole_days

# The tags of a programming language.
LANGUAGE_TAGS = {
    "Python": ["Python", "Backend"], "TypeScript": ["TypeScript", "Frontend"], "JavaScript": ["JavaScript", "Full Stack"], "Rust": ["Rust", "Systems"],
    "Go": ["Go", "Backend"], "Java": ["Java", "Backend"], "C++": ["C++", "Systems"], "C": ["C", "Systems"], "C#": ["C#", "Backend"], "Shell": ["Shell", "DevOps"],
    "Bash": ["Bash", "DevOps"], "Ruby": ["Ruby", "Backend"], "PHP": ["PHP", "Backend"], "Swift": ["Swift", "Mobile"], "Kotlin": ["Kotlin", "Mobile"],
    "Dart": ["Dart", "Mobile"], "Scala": ["Scala", "Backend"], "Elixir": ["Elixir", "Backend"], "Haskell": ["Haskell", "Systems"], "R": ["R", "Data Science"], "MDX": ["Docs"],
}


def _lookup(values: Mapping[str, Iterable[str]]) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]) if values else F.create_map().cast("map<string,array<string>>")


def text_tags(text: Column, rules: Mapping[str, Iterable[str]]) -> Column:
    """The tags any of whose keywords the text holds as a whole word, in any case; a null text has none."""
    hits = [F.when(text.rlike(keyword_pattern(keywords)), F.lit(tag)) for tag, keywords in rules.items()]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def meta_tags(stars: Column, updated: Column, language: Column, topics: Column, is_fork: Column, archived: Column, as_of: Column, topic_tags: Mapping[str, str], popular: int = 1000) -> Column:
    """Tags of a repo's metadata: of its language and topics, Popular above `popular` stars, Active under 30 whole days and Inactive over 365, Forked or Built by Me, Archived.

    Topics are looked up in lower case with hyphens for spaces. What is null or unreadable gives no tag, but a repo that
    isn't known to be a fork is Built by Me.
    """
    days = whole_days(instant(updated), as_of)
    names = F.transform(F.coalesce(topics, F.array().cast("array<string>")), lambda t: F.replace(F.lower(t), F.lit(" "), F.lit("-")))
    known = F.create_map(*[F.lit(x) for kv in topic_tags.items() for x in kv]) if topic_tags else F.create_map().cast("map<string,string>")
    single = F.array_compact(
        F.array(
            F.when(stars > popular, "Popular"),
            F.when(days < 30, "Active").when(days > 365, "Inactive"),
            F.when(F.coalesce(is_fork, F.lit(False)), "Forked").otherwise("Built by Me"),
            F.when(archived, "Archived"),
        )
    )
    of_topics = F.array_compact(F.transform(F.filter(names, lambda t: t.isNotNull()), lambda t: F.element_at(known, t)))
    of_language = F.coalesce(F.when(language.isNotNull(), F.element_at(_lookup(LANGUAGE_TAGS), language)), F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.concat(of_language, of_topics, single)))


def enriched_tags(meta: Column, of_text: Column) -> Column:
    """Both lists as one, sorted, without repeats; null lists count as empty."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_union(F.coalesce(meta, empty), F.coalesce(of_text, empty)))


def category_matches(tagged: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """id, ord, category, matches: how many of an id's tags each category lists.

    tagged: id, tags (repeats count once); vocabulary: ord int, category, tag, a table of fixed size.
    """
    flat = tagged.select("id", F.explode(F.array_distinct("tags")).alias("tag"))
    return flat.join(F.broadcast(vocabulary), "tag").groupBy("id", "ord", "category").agg(F.count("*").alias("matches"))


def primary_category(tagged: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """id, category with the most matches, the first in order of several; empty where nothing matches."""
    best = category_matches(tagged, vocabulary).groupBy("id").agg(F.max(F.struct("matches", -F.col("ord"), "category")).alias("m"))
    return tagged.select("id").join(best, "id", "left").select("id", F.coalesce("m.category", F.lit("")).alias("category"))


def all_categories(tagged: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """id, categories that list any of its tags, in the vocabulary's order; an empty array where none does."""
    sets = category_matches(tagged, vocabulary).groupBy("id").agg(F.array_sort(F.collect_set(F.struct("ord", "category"))).alias("c"))
    return tagged.select("id").join(sets, "id", "left").select("id", F.coalesce(F.col("c.category"), F.array().cast("array<string>")).alias("categories"))


def builders(repos: DataFrame, organisations: DataFrame) -> DataFrame:
    """id, login, display_name, org_category, is_known of a repo's upstream owner, or of its own where it isn't a fork of a known parent.

    repos: id, owner, is_fork, forked_from; organisations: login (lower case), org_category, display_name, a table of
    fixed size. Logins that aren't listed stand for themselves, as `individual`.
    """
    upstream = F.when(F.col("is_fork") & F.contains("forked_from", F.lit("/")), F.split_part("forked_from", F.lit("/"), F.lit(1)))
    named = repos.select("id", F.coalesce(upstream, "owner").alias("login"))
    known = F.broadcast(organisations.select(F.col("login").alias("key"), "org_category", "display_name"))
    both = named.join(known, F.lower("login") == F.col("key"), "left")
    return both.select("id", "login", F.coalesce("display_name", "login").alias("display_name"), F.coalesce("org_category", F.lit("individual")).alias("org_category"), F.col("key").isNotNull().alias("is_known"))
