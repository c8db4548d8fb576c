"""Free-entered values mapped to a reference list: BK-trees over its names under the edit distance, broadcast or sharded.

Words that people put before or after a name without changing what it stands for are learnt: a phrase that stands next
to the whole names of several entries, each of two words or more, qualifies names. A name of one word teaches nothing,
since sharing that word with a name isn't enough.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylight.llm.hashing import WORD
from quarrylight.storage import materialize

#: Names of the reference list that every task holds as one tree; more are split into shards of about so many.
SHARD = 20_000
#: Distinct values matched in one task, against one shard in one task where there are shards, and mappings that may be broadcast.
TASK, SLICE, BROADCAST_MAPPINGS = 1000, 50_000, 500_000

# Letters of other scripts that look like a Latin letter.
LOOKALIKES = str.maketrans({
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
})

# Words that join a name's words and may come or go when it is turned round.
WITHIN = ("of", "and", "the")
#: Entries next to whose names a phrase must stand to be a qualifier, and words it has at most.
TAUGHT, PHRASE = 3, 2


def folded(text: str) -> str:
    """text without case, accents, compatibility forms, invisible characters and letters that only look Latin."""
    text = unicodedata.normalize("NFKD", text)
    text = "".join(c for c in text if unicodedata.category(c) not in ("Mn", "Me", "Cf", "Cc") or c in "\t\n\r")
    return text.casefold().translate(LOOKALIKES)


def words_of(text: str) -> list[str]:
    """The words of a value, without a number that leads a list."""
    words = WORD.findall(folded(text).replace("_", " "))
    return words[1:] if len(words) > 1 and words[0].isdigit() and len(words[0]) < 3 else words


def plain_forms(words: list[str], qualifiers: frozenset[str] | set[str]) -> list[list[str]]:
    """The words, and what is left of them as one qualifier after another goes; a qualifier goes from either end."""
    forms, now = [words], words
    while True:
        for n in range(min(PHRASE, len(now) - 1), 0, -1):
            if " ".join(now[:n]) in qualifiers:
                now = now[n:]
                break
            if " ".join(now[-n:]) in qualifiers:
                now = now[:-n]
                break
        else:
            return forms
        forms.append(now)


def _in_any_order(words: list[str]) -> str:
    return " ".join(sorted(w for w in words if w not in WITHIN))


def edit_distance(a: str, b: str) -> int:
    """Levenshtein's distance, a metric; of one column of the table at once, as bits."""
    if not a or not b:
        return len(a) + len(b)
    at: dict[str, int] = defaultdict(int)
    for k, c in enumerate(a):
        at[c] |= 1 << k
    full, top, up, down, distance = (1 << len(a)) - 1, 1 << (len(a) - 1), (1 << len(a)) - 1, 0, len(a)
    for c in b:
        same = at.get(c, 0)
        x = same | down
        same |= ((same & up) + up) ^ up
        plus, minus = down | ~(same | up) & full, up & same
        distance += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 | 1, minus << 1
        up, down = (minus | ~(x | plus)) & full, plus & x & full
    return distance


def typing_distance(a: str, b: str) -> int:
    """As edit_distance, but two letters that changed places are one edit, with what came or went between them."""
    far = len(a) + len(b)
    rows = [[far] * (len(b) + 2), [far, *range(len(b) + 1)]]
    seen: dict[str, int] = {}
    for i, x in enumerate(a, 1):
        row, matched = [far, i] + [0] * len(b), 0
        rows.append(row)
        for j, y in enumerate(b, 1):
            up, left = seen.get(y, 0), matched
            if x == y:
                matched = j
            swapped = rows[up][left] + (i - up - 1) + 1 + (j - left - 1)
            row[j + 1] = min(rows[i][j] + (x != y), rows[i][j + 1] + 1, row[j] + 1, swapped)
        seen[x] = i
    return rows[-1][-1]


class BKTree:
    """Names under edit_distance: a child's distance from its node labels its edge."""

    def __init__(self, names: list[str]):
        self.root: tuple[str, dict] | None = None
        for name in names:
            self.add(name)

    def add(self, name: str) -> None:
        if self.root is None:
            self.root = (name, {})
            return
        node = self.root
        while d := edit_distance(name, node[0]):
            if d not in node[1]:
                node[1][d] = (name, {})
                return
            node = node[1][d]

    def within(self, name: str, radius: int) -> list[str]:
        """Every name at most radius from name; by the triangle inequality only edges so near to a node's distance can lead there."""
        found, left = [], [self.root] if self.root else []
        while left:
            node, edges = left.pop()
            d = edit_distance(name, node)
            if d <= radius:
                found.append(node)
            left += [child for edge, child in edges.items() if d - radius <= edge <= d + radius]
        return found


def edits_allowed(length: int) -> int:
    """Typing errors that a name of so many letters and digits may have."""
    return 0 if length < 5 else 1 if length < 8 else 2


class Matcher:
    """The names of one field, and what a value stands for. own: words that are no typing errors of other words."""

    def __init__(self, names: list[tuple[int, str]], own: frozenset[str] = frozenset()):
        self.own = own
        self.words: dict[str, set[str]] = defaultdict(set)
        self.entry: tuple[dict[str, int], ...] = ({}, {}, {})  # of names as they are, in any order, and cut short
        for entry, name in sorted(names):
            words = words_of(name)
            if not words:
                continue
            key = "".join(words)
            self.entry[0].setdefault(key, entry)
            self.words[key] |= set(words)
            self.entry[1].setdefault(_in_any_order(words), entry)
            for n in range(2 if len(words) > 1 else 4, len(words[-1])):
                self.entry[2].setdefault("".join([*words[:-1], words[-1][:n]]), entry)
        self.trees = tuple(BKTree(sorted(x)) for x in self.entry)

    def __call__(self, value: str, qualifiers: frozenset[str] | set[str] = frozenset()) -> tuple[int, int, list[str]] | None:
        """(distance, entry, lacking) of the nearest entry, the smaller entry of several; None if none is near enough.

        A value whose words are a name's is at 0, in another order at 1, and 2 more for each qualifier (6 at most); one
        cut short before a full stop at 8; one with typing errors at 10 and their number (plus 20 with qualifiers), and
        lacking are its words that the name lacks. An own word that the name lacks isn't taken for a typing error. The
        distance carries all preferences, so of several parts of the names the least answer is that of the whole.
        """
        forms = plain_forms(words_of(value), qualifiers)
        for k, words in enumerate(forms):
            for turned, key in enumerate(("".join(words), _in_any_order(words))):
                for name in self.trees[turned].within(key, 0):
                    return 2 * min(k, 3) + turned, self.entry[turned][name], []
        if value.rstrip().endswith((".", "…")):
            for name in self.trees[2].within("".join(forms[0]), 0):
                return 8, self.entry[2][name], []
        best = None
        for k, words in enumerate(forms):
            key = "".join(words)
            allowed = edits_allowed(len(key))
            for name in self.trees[0].within(key, 2 * allowed) if allowed else ():  # a swap is two of the metric's edits
                d = typing_distance(key, name)
                lacking = sorted(set(words) - self.words[name])
                if not self.own.isdisjoint(lacking):
                    continue
                if d <= min(allowed, edits_allowed(len(name))):
                    found = (10 + d + 20 * (k > 0), self.entry[0][name], lacking)
                    best = min(best, found) if best else found
        return best


def _matchers(rows: list[tuple[str, int, str]], own: dict[str, frozenset[str]]) -> dict[str, Matcher]:
    names = defaultdict(list)
    for field, entry, name in rows:
        names[field].append((entry, name))
    return {field: Matcher(x, own.get(field, frozenset())) for field, x in names.items()}


def _table(fields: list[str], values: list[str], peels: list[list[str]], matchers: dict[str, Matcher]) -> pa.Table:
    found = [(m(v, set(q or ())) if (m := matchers.get(f)) else None) or (None, None, None) for f, v, q in zip(fields, values, peels)]
    columns = {"field": pa.array(fields, pa.string()), "value": pa.array(values, pa.string()), "peels": pa.array(peels, pa.list_(pa.string()))}
    return pa.table(columns | {"distance": pa.array([d for d, _, _ in found], pa.int32()), "entry": pa.array([e for _, e, _ in found], pa.int64()), "lacking": pa.array([x for _, _, x in found], pa.list_(pa.string()))})


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """field, value to phrases at its ends: field, value, phrase, and rest, the key of two words or more that stands next to it."""
    for batch in batches:
        flat = set()
        for field, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_of(value)
            for n in range(1, PHRASE + 1):
                for at in range(min(len(words) - n, 2 * PHRASE)):
                    rest = words[n:] if not at and len(words) - n > 1 else None
                    flat.add((field, value, " ".join(words[at : at + n]), rest and "".join(rest)))
                    end = len(words) - at
                    rest = words[:-n] if not at and len(words) - n > 1 else None
                    flat.add((field, value, " ".join(words[end - n : end]), rest and "".join(rest)))
        rows = zip(*flat) if flat else ([],) * 4
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in rows], names=["field", "value", "phrase", "rest"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """field, entry, name to the key of each name of two words or more: field, entry, rest."""
    for batch in batches:
        rows = [(f, e, "".join(w)) for f, e, n in zip(*(c.to_pylist() for c in batch.columns)) if len(w := words_of(n)) > 1]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else ([],) * 3, (pa.string(), pa.int64(), pa.string()))], names=["field", "entry", "rest"])


def with_qualifiers(distinct: DataFrame, names: DataFrame) -> DataFrame:
    """distinct (field, value) with peels: those of the qualifiers that all values teach which stand near the value's ends.

    A phrase of one or two words is a qualifier if values put it right before or right after whole names of at least
    TAUGHT entries of any fields; it then counts at either end. It is joined to the values that hold it, so no list of them is sent anywhere.
    """
    phrases = materialize(distinct.mapInArrow(_phrases, "field string, value string, phrase string, rest string"), "phrases")
    keys = names.select("field", "entry", "name").mapInArrow(_keys, "field string, entry long, rest string").distinct()
    beside = phrases.where("rest is not null").join(keys, ["field", "rest"]).select("phrase", "field", "entry").distinct()
    learnt = beside.groupBy("phrase").agg(F.count("*").alias("n")).where(F.col("n") >= TAUGHT).select("phrase")
    held = phrases.select("field", "value", "phrase").distinct().join(learnt, "phrase").groupBy("field", "value").agg(F.collect_set("phrase").alias("peels"))  # of one value: some 4 * PHRASE ** 2 at most
    return distinct.join(held, ["field", "value"], "left")


#: Distinct companions in values that stand for no name from which on a word is one of its own.
COMPANIONS = 5


def _uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """field, value, peels, distance to the distinct words of each value, with the other words it has there, and whether the value was taken for a name with typing errors."""
    for batch in batches:
        flat = []
        for field, value, peels, distance in zip(*(batch.column(k).to_pylist() for k in range(4))):
            words = {w for w in plain_forms(words_of(value), set(peels or ()))[-1] if w not in WITHIN and not w.isdigit()}
            flat += [(field, w, " ".join(sorted(words - {w})), distance is not None) for w in sorted(words)]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*flat) if flat else ([],) * 4, (pa.string(), pa.string(), pa.string(), pa.bool_()))], names=["field", "word", "companion", "typed"])


def _name_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """field, name to the words of each name."""
    for batch in batches:
        flat = [(f, w) for f, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for w in words_of(n)]
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in flat], pa.string()), pa.array([w for _, w in flat], pa.string())], names=["field", "word"])


def own_words(found: DataFrame, names: DataFrame) -> dict[str, frozenset[str]]:
    """By field, the words that are no typing errors, of those that a value's name lacks (found: field, value, peels, distance, lacking).

    These are the words of the field's names, and those which values that stand for no name use with at least COMPANIONS
    different other words, and with more than do the values taken for a name with typing errors. What counts are
    different folded words without qualifiers, so neither spellings nor repetitions do, nor how many other values there
    are; a misspelling occurs where the right word does, in values taken for names.
    """
    asked = found.select("field", F.explode("lacking").alias("word")).distinct()
    uses = found.where("distance is null or distance >= 10").select("field", "value", "peels", "distance").mapInArrow(_uses, "field string, word string, companion string, typed boolean")
    uses = uses.join(asked, ["field", "word"], "left_semi").groupBy("field", "word", "companion").agg(F.max("typed").alias("typed"))
    alone, typed = F.count_if(~F.col("typed")), F.count_if("typed")
    used = uses.groupBy("field", "word").agg(alone.alias("alone"), typed.alias("typed")).where((F.col("alone") >= COMPANIONS) & (F.col("alone") > F.col("typed"))).select("field", "word")
    named = names.select("field", "name").mapInArrow(_name_words, "field string, word string").join(asked, ["field", "word"], "left_semi")
    out: dict[str, set[str]] = defaultdict(set)
    for r in used.union(named).distinct().collect():  # only words that some value has in place of a name's
        out[r["field"]].add(r["word"])
    return {f: frozenset(w) for f, w in out.items()}


def _match_all(rows: list[tuple[str, int, str]], own: dict[str, frozenset[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = _matchers(rows, own)
        for batch in batches:
            yield from _table(*(batch.column(k).to_pylist() for k in range(3)), matchers).to_batches()

    return run


def _match_shard(own: dict[str, frozenset[str]]):
    def run(values: pa.Table, names: pa.Table) -> pa.Table:
        rows = list(zip(*(names.column(c).to_pylist() for c in ("field", "entry", "name"))))
        return _table(*(values.column(c).to_pylist() for c in ("field", "value", "peels")), _matchers(rows, own))

    return run


def _nearest(distinct: DataFrame, names: DataFrame, own: dict[str, frozenset[str]], shard: int, slice_rows: int) -> DataFrame:
    """field, value, peels, distance, entry, lacking of each value, the last three null where it stands for no name."""
    schema, count, values = "field string, value string, peels array<string>, distance int, entry long, lacking array<string>", names.count(), distinct.count()
    if count <= shard:
        rows = [(r["field"], r["entry"], r["name"]) for r in names.select("field", "entry", "name").collect()]
        return distinct.select("field", "value", "peels").repartition(max(1, -(-values // TASK))).mapInArrow(_match_all(rows, own), schema)
    shards = -(-count // shard)
    slices = max(1, -(-values // slice_rows))
    left = distinct.withColumn("slice", F.pmod(F.xxhash64("value"), F.lit(slices)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = names.select("field", "entry", "name").withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards)).cast("int")).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    found = left.groupBy("shard", "slice").cogroup(right.groupBy("shard", "slice")).applyInArrow(_match_shard(own), schema)
    best = F.min(F.when(F.col("entry").isNotNull(), F.struct("distance", "entry", "lacking"))).alias("best")
    return found.groupBy("field", "value").agg(F.first("peels").alias("peels"), best).select("field", "value", "peels", "best.*")


def mapped(values: DataFrame, reference: DataFrame, shard: int = SHARD, slice_rows: int = SLICE) -> DataFrame:
    """key, field, value, entry: each distinct value of a key, and the entry it stands for, 0 if none.

    values: key, field string, value string; reference: field string, entry long, name string (an entry may have several
    names). Null and blank values, and those that are a name of the field as it stands under which `main` is true, are
    left out; null names are ignored. A value is compared in the field it is of. What is compared are letters and digits
    without case, accents, look-alike letters and qualifiers, which are learnt from all values (with_qualifiers()); see
    Matcher for what is near enough. Of entries equally near the smallest wins. An empty reference maps all to 0. Runs
    jobs and writes to the shared folder when called.
    """
    spark = values.sparkSession
    names = materialize(reference.where("name is not null and entry is not null").select("field", "entry", "name", "main").distinct(), "names")
    count = names.count()
    exact = names.where("main").select("field", F.col("name").alias("value")).distinct()
    own = values.where(F.col("key").isNotNull() & F.col("value").rlike(r"(?U)\S")).select("key", "field", "value").distinct()
    own = own.join(F.broadcast(exact) if count <= BROADCAST_MAPPINGS else exact, ["field", "value"], "left_anti")
    distinct = own.select("field", "value").distinct()
    distinct = materialize(with_qualifiers(materialize(distinct, "distinct"), names), "qualified")
    found = materialize(_nearest(distinct, names, {}, shard, slice_rows), "nearest")
    own_by_field = own_words(found, names)
    if own_by_field:
        words = spark.createDataFrame([(f, sorted(w)) for f, w in own_by_field.items()], "field string, own array<string>")
        again = found.join(F.broadcast(words), "field", "left").withColumn("again", F.coalesce(F.arrays_overlap("lacking", "own"), F.lit(False)))
        doubted = materialize(again.where("again").select("field", "value", "peels"), "doubted")
        found = again.where("not again").select("field", "value", "entry").unionByName(_nearest(doubted, names, own_by_field, shard, slice_rows).select("field", "value", "entry"))
    found = materialize(found.select("field", "value", F.coalesce("entry", F.lit(0)).cast("long").alias("entry")), "mapping")
    found = F.broadcast(found) if found.count() <= BROADCAST_MAPPINGS else found
    return own.join(found, ["field", "value"]).select("key", "field", "value", "entry")
