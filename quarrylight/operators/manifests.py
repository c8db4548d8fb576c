"""Package names declared in dependency manifests, one row a package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylight.functions.sets import stripped

# The files in order of preference, and the ecosystem of each.
ECOSYSTEMS = {"requirements.txt": "pypi", "pyproject.toml": "pypi", "package.json": "npm", "setup.py": "pypi", "go.mod": "go", "Cargo.toml": "cargo"}

# Fixed value: what of a requirement is its name.
_NAME = "^([a-zA-Z0-9_-]+)"
_STATE = "struct<inside:boolean,out:array<string>>"


def _lines(content: Column) -> Column:
    return F.transform(F.split(content, "\r\n|\n|\r"), stripped)


def _names(items: Column) -> Column:
    """The leading name of each item, lower-cased; items without one are dropped."""
    return F.filter(F.transform(items, lambda x: F.lower(F.regexp_extract(x, _NAME, 1))), lambda n: n != "")


def _unquoted(item: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(item, "^\"+|\"+$", ""), "^'+|'+$", "")


def _collected(lines: Column, step) -> Column:
    """Folds the lines with step(inside, line) -> (inside, items to add)."""

    def merge(state: Column, line: Column) -> Column:
        inside, found = step(state["inside"], line)
        return F.struct(inside.alias("inside"), F.concat(state["out"], found).alias("out")).cast(_STATE)

    start = F.struct(F.lit(False).alias("inside"), F.array().cast("array<string>").alias("out")).cast(_STATE)
    return F.aggregate(lines, start, merge, lambda s: s["out"])


def _nothing() -> Column:
    return F.array().cast("array<string>")


def _requirements(content: Column) -> Column:
    return _names(F.filter(_lines(content), lambda x: (x != "") & ~x.startswith("#") & ~x.startswith("-")))


def _pyproject(content: Column) -> Column:
    opening = "dependencies = ["

    def step(inside: Column, line: Column) -> tuple[Column, Column]:
        opens, inline = line.startswith(opening), line.contains("]")
        listed = F.transform(F.split(F.regexp_extract(line, r"^[^\[]*\[(.*)\]", 1), ","), lambda x: _unquoted(stripped(x)))
        item = F.array(_unquoted(F.regexp_replace(line, "^,+|,+$", "")))
        now = F.when(opens, ~inline).when(line == "]", False).otherwise(inside)
        return now, F.when(opens & inline, _names(listed)).when(~opens & inside & (line != "]"), _names(item)).otherwise(_nothing())

    return _collected(_lines(content), step)


def _package_json(content: Column) -> Column:
    sections = [F.map_keys(F.from_json(F.get_json_object(content, f"$.{s}"), "map<string,string>")) for s in ("dependencies", "devDependencies", "peerDependencies")]
    return F.array_sort(F.array_distinct(F.flatten(F.array(*[F.coalesce(s, _nothing()) for s in sections]))))


def _setup_py(content: Column) -> Column:
    items = F.split(F.regexp_extract(content, r"(?s)install_requires\s*=\s*\[(.*?)\]", 1), ",")
    return _names(F.transform(items, lambda x: _unquoted(stripped(x))))


def _go_mod(content: Column) -> Column:
    def step(inside: Column, line: Column) -> tuple[Column, Column]:
        opens, single = line.startswith("require ("), ~inside & line.startswith("require ")
        word = F.regexp_extract(F.when(single, F.substring(line, 9, 1 << 30)).otherwise(line), r"^\s*(\S+)", 1)
        takes = ~opens & (word != "") & (single | inside & (line != ")") & ~word.startswith("//"))
        return F.when(opens, True).when(inside & (line == ")"), False).otherwise(inside), F.when(takes, F.array(word)).otherwise(_nothing())

    return _collected(_lines(content), step)


def _cargo(content: Column) -> Column:
    def step(inside: Column, line: Column) -> tuple[Column, Column]:
        header = line.startswith("[")
        name = stripped(F.substring_index(line, "=", 1))
        takes = ~header & inside & line.contains("=") & ~line.startswith("#") & (name != "")
        return F.when(header, line.isin("[dependencies]", "[dev-dependencies]", "[build-dependencies]")).otherwise(inside), F.when(takes, F.array(name)).otherwise(_nothing())

    return _collected(_lines(content), step)


PARSERS = {"requirements.txt": _requirements, "pyproject.toml": _pyproject, "package.json": _package_json, "setup.py": _setup_py, "go.mod": _go_mod, "Cargo.toml": _cargo}


def packages(files: DataFrame, parsers: dict | None = None) -> DataFrame:
    """The columns of files (id, file, content, ...) and packages: the names its manifest declares, in its order.

    file may have folders before it. Files without a parser and null contents declare nothing. parsers maps a file name
    to a function of the content's column, for manifests of other kinds.
    """
    name, found = F.element_at(F.split("file", "/"), -1), F
    for file, parse in (parsers or PARSERS).items():
        found = found.when(name == file, parse(F.col("content")))
    return files.withColumn("packages", F.coalesce(found.otherwise(_nothing()), _nothing()))


def chosen_packages(files: DataFrame) -> DataFrame:
    """id, package, ecosystem, source_file of the first manifest of each id that declares anything; `__none__`, not direct, where none does.

    files: id, upstream boolean, file, content. A file of the upstream repo comes before the fork's own, then the order
    of ECOSYSTEMS counts. is_direct is false of `__none__` alone.
    """
    order = F.array(*map(F.lit, ECOSYSTEMS))
    base = F.element_at(F.split("file", "/"), -1)
    ranked = packages(files).where(F.size("packages") > 0).withColumn("_at", F.array_position(order, base))
    ranked = ranked.withColumn("_rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("upstream"), "_at", "file"))).where("_rank = 1")
    kinds = F.create_map(*[F.lit(x) for kv in ECOSYSTEMS.items() for x in kv])
    found = ranked.select("id", F.explode(F.array_distinct("packages")).alias("package"), F.element_at(kinds, base).alias("ecosystem"), F.col("file").alias("source_file"), F.lit(True).alias("is_direct"))
    none = files.select("id").distinct().join(ranked, "id", "left_anti").select("id", F.lit("__none__").alias("package"), F.lit("__sentinel__").alias("ecosystem"), F.lit(None).cast("string").alias("source_file"), F.lit(False).alias("is_direct"))
    return found.unionByName(none)


def dependency_counts(chosen: DataFrame) -> DataFrame:
    """One row of chosen_packages()'s result: total repos, with_deps, no_deps, packages."""
    per = chosen.groupBy("id").agg(F.count_if("is_direct").alias("n"))
    return per.agg(F.count("*").alias("total"), F.count_if(F.col("n") > 0).alias("with_deps"), F.count_if(F.col("n") == 0).alias("no_deps"), F.coalesce(F.sum("n"), F.lit(0)).alias("packages"))
