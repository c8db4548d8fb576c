"""Scalar column functions over text."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrylight.functions.sets import stripped


def or_null(text: Column) -> Column:
    """text, or null where it is empty."""
    return F.nullif(text, F.lit(""))


def slug(name: Column) -> Column:
    """An id of a category name: lower case, hyphens for spaces, `and` for &, no colon."""
    return F.replace(F.replace(F.replace(F.lower(name), F.lit(" "), F.lit("-")), F.lit("&"), F.lit("and")), F.lit(":"), F.lit(""))


def package_key(name: Column) -> Column:
    """A package or repo name without case, hyphens and underscores."""
    return F.translate(F.lower(name), "-_", "")


def repo_part(full_name: Column) -> Column:
    """What follows the first slash; the whole name if there is none."""
    return F.when(F.contains(full_name, F.lit("/")), F.split_part(full_name, F.lit("/"), F.lit(2))).otherwise(full_name)


def owner_part(full_name: Column) -> Column:
    """The lower-cased owner before the first slash; null if there is none or no slash."""
    return F.when(F.contains(full_name, F.lit("/")), or_null(F.lower(stripped(F.substring_index(full_name, "/", 1)))))


def instant(text: Column) -> Column:
    """An ISO 8601 text as a zone-less UTC timestamp; null if it isn't one."""
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]|$)"), text)
    return F.try_to_timestamp(iso).cast("timestamp_ntz")


def whole_days(earlier: Column, later: Column) -> Column:
    """Days between two zone-less timestamps, rounded down."""
    seconds = F.timestamp_diff("SECOND", earlier, later)
    return F.floor(seconds / 86400).cast("long")


def keyword_pattern(keywords: Iterable[str]) -> str:
    """One pattern for any of the keywords, without letters or digits of ASCII next to it, in any case."""
    return r"(?iu)(?<![a-zA-Z0-9])(?:" + "|".join(re.escape(k) for k in keywords) + r")(?![a-zA-Z0-9])"


def first_paragraph(text: Column, least: int = 50, most: int = 500, separator: str = "\n\n") -> Column:
    """The first paragraph of at least `least` characters that doesn't begin with `!`, without leading # signs, cut to `most`; null if none."""
    parts = F.transform(F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), separator), lambda p: stripped(F.regexp_replace(stripped(p), "^#+", "")))
    fit = F.filter(parts, lambda p: ~p.startswith("!") & (F.length(p) >= least))
    return F.substring(F.get(fit, F.lit(0)), 1, most)


def first_sentence(text: Column, least: int = 10, most: int = 255) -> Column:
    """What precedes the first full stop, with one, cut to `most`; null unless it has more than `least` characters."""
    sentence = stripped(F.substring_index(text, ".", 1))
    return F.when(F.length(sentence) > least, F.substring(F.concat(sentence, F.lit(".")), 1, most))


def labelled(*parts: tuple[str, Column]) -> Column:
    """A line `label: value` for each part that is neither null nor empty, for a model's prompt. Give lists joined and cut."""
    return F.concat_ws("\n", *[F.concat(F.lit(f"{label}: "), or_null(part)) for label, part in parts])


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def has_path(paths: Column, names: list[str], prefix: str | None = None, any_case: bool = False) -> Column:
    """Whether a list of root paths holds one of the names, or one that begins with prefix; null paths hold none."""
    match = lambda p: p.isin(names) | (p.startswith(prefix) if prefix else F.lit(False))
    return F.coalesce(F.exists(paths, lambda p: match(F.lower(p) if any_case else p)), F.lit(False))


def one_of(text: Column, allowed: list[str], otherwise: str | None = None) -> Column:
    """text in lower case without white space at its ends if it is allowed, else what stands for the rest."""
    clean = F.lower(stripped(text))
    return F.when(clean.isin(allowed), clean).otherwise(F.lit(otherwise).cast("string"))


def filled(value: Column, by: Column, defaults: dict[str, str], otherwise: str) -> Column:
    """value, or where it is null or empty the default of `by`."""
    known = F.create_map(*[F.lit(x) for kv in defaults.items() for x in kv]) if defaults else F.create_map().cast("map<string,string>")
    return F.coalesce(or_null(value), F.when(by.isNotNull(), F.element_at(known, by)), F.lit(otherwise))


def embedding_text(*parts: tuple[str, Column], most: int = 2048) -> Column:
    """The parts that are neither null nor empty, each after its prefix, with a space between, cut to `most`."""
    return F.substring(F.concat_ws(" ", *[F.concat(F.lit(prefix), or_null(part)) for prefix, part in parts]), 1, most)


def string_items(json: Column) -> Column:
    """The strings of a JSON array; other items are dropped, and what isn't an array gives an empty one."""
    items = F.from_json(json, "array<variant>")
    texts = F.transform(F.filter(items, lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))
    return F.coalesce(texts, F.array().cast("array<string>"))


def clean_list(items: Column) -> Column:
    """Items without white space at the ends, in order of first appearance; nulls and blanks are dropped."""
    return F.array_distinct(F.filter(F.transform(items, stripped), lambda x: x.isNotNull() & (x != "")))


def model_reply(text: Column, schema: str) -> Column:
    """A model's JSON reply, with or without a fence of three backticks around it, as a struct; null if it can't be read."""
    return F.from_json(F.regexp_replace(text, r"^\s*```(?:json)?\s*|\s*```\s*$", ""), schema)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays, as doubles; null where one has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


# What in a repo's root tells of tests, in any case, and of a build service.
TEST_PATHS, CI_PATHS = ["test", "tests", "spec", "specs", "__tests__", "test_", "pytest.ini", "jest.config.js", "jest.config.ts"], [".github", ".circleci", ".travis.yml", "Jenkinsfile", ".gitlab-ci.yml", "azure-pipelines.yml"]


def has_tests(paths: Column) -> Column:
    return has_path(paths, TEST_PATHS, "test_", any_case=True)


def has_ci(paths: Column) -> Column:
    return has_path(paths, CI_PATHS)


def listed_names(text: Column) -> Column:
    """The names of a list separated by commas or white space; null and blank lists have none."""
    return F.coalesce(F.filter(F.split(text, r"(?U)[,\s]+"), lambda n: n != ""), F.array().cast("array<string>"))
