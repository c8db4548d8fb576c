"""What a run will cost of a request budget, and what to do about it; and the address of a database."""

from __future__ import annotations

from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

from pyspark.sql import Column
from pyspark.sql import functions as F


def estimated_calls(mode: Column, repos: Column) -> Column:
    """Requests of a run over so many repos: a tenth of them, at least one, is taken as changed; 7 for modes without an estimate."""
    part = lambda n: F.greatest(F.lit(1), F.floor(repos / n)).cast("long")
    quick = 7 + part(10) * 3
    return F.when(mode == "quick", quick).when(mode == "weekly", quick + repos * 2 + part(3)).when(mode == "full", 7 + repos * 5).otherwise(F.lit(7)).cast("long")


def decision(available: Column, wanted: Column, buffer: int = 100) -> Column:
    """ok where what is wanted fits beside the buffer, or nothing is known yet; wait where even the buffer is used up; else warn."""
    return F.when(available.isNull() | (available >= wanted + buffer), "ok").when(available < buffer, "wait").otherwise("warn")


def seconds_until(reset: Column, now: Column, margin: int = 5) -> Column:
    """Whole seconds from now to reset and some more, never less than 0."""
    return F.greatest(F.timestamp_diff("SECOND", now, reset) + margin, F.lit(0)).cast("long")


# Spellings of a database address's ssl setting.
SSL_MODES = {"true": "require", "1": "require", "require": "require", "false": "disable", "0": "disable", "disable": "disable"}


def database_url(url: str) -> str:
    """A PostgreSQL address without a driver's name in its scheme, and with `ssl` as `sslmode` unless that is given too."""
    scheme, mark, rest = url.partition("://")
    parts = urlsplit(scheme.partition("+")[0] + mark + rest)
    query: dict[str, str] = {}
    for key, value in parse_qsl(parts.query, keep_blank_values=True):
        query.setdefault(key, value)
    mode = SSL_MODES.get(query.pop("ssl", "").lower())
    if mode:
        query.setdefault("sslmode", mode)
    return urlunsplit(parts._replace(query=urlencode(query)))
