"""Repeatable pseudo-random columns.

Every draw depends on the row's key and a salt alone, so neither partitioning nor a retried
task changes a value, and any SQL engine with md5 computes the same one.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_BITS = 60
DRAW_SPAN = 1 << DRAW_BITS


def draw(salt: str, *keys: Column | str) -> Column:
    """A long uniform in [0, 2**60): the first 15 hex digits of md5('salt|key|...')."""
    digest = F.md5(F.concat_ws("|", F.lit(salt), *(_text(k) for k in keys)))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _text(key: Column | str) -> Column:
    return (F.col(key) if isinstance(key, str) else key).cast("string")


def below(limit: int, salt: str, *keys: Column | str) -> Column:
    """A long uniform in [0, limit)."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    return draw(salt, *keys) % F.lit(limit)


def pick(values: Sequence, salt: str, *keys: Column | str) -> Column:
    """One element of a literal list, all equally likely."""
    if not values:
        raise ValueError("values must not be empty")
    return F.element_at(F.array(*map(F.lit, values)), (below(len(values), salt, *keys) + 1).cast("int"))


def weighted(weights: Sequence[tuple[str, int]], salt: str, *keys: Column | str) -> Column:
    """One label, as likely as its share of the integer weights."""
    if not weights or any(w < 1 for _, w in weights):
        raise ValueError("weights must be positive")
    # one array element per unit of weight: the draw is evaluated once, not once per threshold
    return pick([label for label, weight in weights for _ in range(weight)], salt, *keys)


def date_in(first: date, last: date, salt: str, *keys: Column | str) -> Column:
    """A date in [first, last): the last day itself is never drawn."""
    span = (last - first).days
    if span < 1:
        raise ValueError("first must be before last")
    return F.date_add(F.lit(first), below(span, salt, *keys).cast("int"))


def uniform(low: float, high: float, salt: str, *keys: Column | str) -> Column:
    """A double uniform in [low, high)."""
    if not low < high:
        raise ValueError("low must be below high")
    return F.lit(float(low)) + draw(salt, *keys) / F.lit(float(DRAW_SPAN)) * F.lit(float(high - low))
