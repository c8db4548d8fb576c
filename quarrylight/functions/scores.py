"""Scores and counters of a repository's activity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrylight.functions.text import instant, whole_days


def activity_score(stars: Column, forks: Column, last7: Column, last30: Column, last90: Column, archived: Column) -> Column:
    """0 to 100: at most 60 for commits, 15 for stars, 15 for forks, 10 for any commit in 90 days; archived repos 0 to 10 by stars. Null counts are 0."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    log = lambda c, by: F.floor(F.log2(zero(c) + 1) * by)
    live = F.least(F.lit(60), zero(last30) * 3 + zero(last7) * 5) + F.least(F.lit(15), log(stars, 2)) + F.least(F.lit(15), log(forks, 3)) + F.when(zero(last90) > 0, 10).otherwise(0)
    return F.when(F.coalesce(archived, F.lit(False)), F.least(F.lit(10), log(stars, 1.5))).otherwise(F.least(F.lit(100), live)).cast("long")


def stars_log(stars: Column) -> Column:
    return F.when(stars > 0, F.round(F.log10(stars + 1), 4)).otherwise(F.lit(0.0))


def commit_windows(commits: Column, as_of: Column) -> dict[str, Column]:
    """today, last7, last30, last90 of an array of ISO texts: commits so many whole days old; later ones count but for today, unreadable ones don't."""
    days = F.transform(commits, lambda c: whole_days(instant(c), as_of))
    count = lambda keep: F.coalesce(F.size(F.filter(days, keep)), F.lit(0)).cast("long")
    within = lambda n: count(lambda d: d < n)
    return {"today": count(lambda d: d == 0), "last7": within(7), "last30": within(30), "last90": within(90)}


def week_windows(weeks: Column) -> dict[str, Column]:
    """last7, last30, last90 of weekly totals, oldest first: the last 1, 4 and 13; 0 where there are fewer."""
    total = lambda n: F.when(F.size(weeks) >= n, F.aggregate(F.slice(weeks, -n, n), F.lit(0).cast("long"), lambda s, x: s + F.coalesce(x, F.lit(0)))).otherwise(0).cast("long")
    return {"last7": total(1), "last30": total(4), "last90": total(13)}


def shares(counts: Column) -> Column:
    """Each value of a map in per cent of their sum, to one place; an empty map if the sum is 0."""
    total = F.aggregate(F.map_values(counts), F.lit(0).cast("long"), lambda s, x: s + F.coalesce(x, F.lit(0)))
    return F.when(total > 0, F.transform_values(counts, lambda _, v: F.round(v / total * 100, 1))).otherwise(F.create_map().cast("map<string,double>"))


def sync_state(ahead: Column, behind: Column) -> Column:
    """How a fork stands to its parent; unknown where a count is missing."""
    return (
        F.when(ahead.isNull() | behind.isNull(), "unknown")
        .when((ahead > 0) & (behind > 0), "diverged")
        .when(behind > 0, "behind")
        .when(ahead > 0, "ahead")
        .otherwise("up-to-date")
    )


def quality_overall(signals: Column) -> Column:
    """The number `overall` of a JSON object, to 4 places; null where it is missing, no number or the text no object."""
    return F.round(F.get_json_object(signals, "$.overall").try_cast("double"), 4)
