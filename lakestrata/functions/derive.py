"""Derived columns: null-safe arithmetic, ordered tiers, key fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_zero(column: Column | str, zero: int | float = 0.0) -> Column:
    """The column with NULL read as zero; pass ``zero=0`` to keep an integral type."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(zero))


def tiers(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """The label of the first rule that holds; a NULL rule does not hold."""
    if not rules:
        raise ValueError("tiers needs at least one rule")
    (condition, label), *rest = rules
    chosen = F.when(condition, F.lit(label))
    for condition, label in rest:
        chosen = chosen.when(condition, F.lit(label))
    return chosen.otherwise(F.lit(default))


def fingerprint(key: Column | str, salt: str = "") -> Column:
    """SHA-256 of the key as text, with an optional suffix."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.sha2(F.concat(text, F.lit(salt)) if salt else text, 256)


def difference(left: Column | str, right: Column | str) -> Column:
    """``left - right`` with NULL as zero on either side."""
    return or_zero(left) - or_zero(right)


def product(left: Column | str, right: Column | str) -> Column:
    """``left * right`` with NULL as zero on either side."""
    return or_zero(left) * or_zero(right)


def percent_of(part: Column | str, whole: Column | str) -> Column:
    """``part`` as a percentage of ``whole``; 0.0 where ``whole`` is NULL or zero."""
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.when(whole != 0, or_zero(part) / whole * 100).otherwise(F.lit(0.0))


def timestamp_of(day: Column | str, time: Column | str) -> Column:
    """The moment that a date and a time of day given as text name; NULL where either is NULL or they name none."""
    day, time = ((F.col(c) if isinstance(c, str) else c).cast("string") for c in (day, time))
    return F.try_to_timestamp(F.concat(day, F.lit(" "), time), F.lit("yyyy-MM-dd HH:mm:ss"))


def padded(number: Column | str, width: int) -> Column:
    """Digits with leading zeros, at least ``width`` of them; longer numbers stay whole."""
    digits = (F.col(number) if isinstance(number, str) else number).cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))
