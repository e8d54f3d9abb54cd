"""Seeded bank files: customers, their next snapshot, balances, and days of transactions.

Only the columns the bank model uses, plus the composed ones. All values follow from key and salt.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.derive import padded
from lakestrata.functions.draws import below, date_in, pick, uniform, weighted
from lakestrata.operators import synth
from lakestrata.plans.bank import ACCOUNT_TYPE_WEIGHTS, TRANSACTION_TYPE_WEIGHTS

# Codes and ranges of the source system.
RISK_LEVELS = ("LOW", "MED", "HIG", "CRT")
CREDIT_GRADES = ("AAA", "AA", "A", "BBB", "BB", "B", "CCC", "D")
BIRTH_DATES = (date(1970, 1, 1), date(2007, 12, 31))
ACCOUNT_DATES = (date(2005, 1, 1), date(2025, 12, 31))
MUTATED_SHARE, NEW_SHARE = 0.20, 0.006

WORDS: Mapping[str, Sequence[str]] = {
    "first": ("Alba", "Bruno", "Carla", "Dario", "Elena", "Fabio", "Gloria", "Hugo"),
    "last": ("Arias", "Bravo", "Campos", "Duran", "Espino", "Flores", "Galvez", "Heredia"),
    "city": ("Northport", "Eastfield", "Southgate", "Westbrook"),
    "country": ("AA", "BB", "CC"),
    "occupation": ("clerk", "driver", "nurse", "teacher"),
    "education": ("primary", "secondary", "college"),
    "status": ("ACT", "INA", "BLK"),
    "currency": ("USD", "EUR", "CRC"),
}


def customers(
    spark: SparkSession, rows: int, salt: str = "day1", words: Mapping[str, Sequence[str]] = WORDS
) -> DataFrame:
    synth.require_positive(rows=rows)
    synth.require_text(salt=salt)
    drawn = synth.generate_rows(spark, rows, "CUSTID")
    return drawn.withColumns(_person(F.col("CUSTID"), salt, words)).withColumns(_composed())


def next_customers(
    before: DataFrame,
    salt: str,
    share: float = MUTATED_SHARE,
    new_share: float = NEW_SHARE,
    words: Mapping[str, Sequence[str]] = WORDS,
) -> DataFrame:
    """The next day's master: some customers changed what people change, a few are new.

    Full name and e-mail follow from the changed names.
    """
    synth.require_text(salt=salt)
    synth.require_share(share=share, new_share=new_share)
    drawn = _person(F.col("CUSTID"), f"{salt} changed", words)
    changed = {name: drawn[name] for name in ("CUSNM", "CUSLN", "CUSCT", "CUSOC", "CUSED")}

    def fresh(key: Column) -> dict[str, Column]:
        made = _person(key, f"{salt} new", words)
        return {**made, **_composed(made["CUSNM"], made["CUSLN"])}

    return synth.mutate_snapshot(before, "CUSTID", share, [changed, _composed()], new_share, fresh, salt)


def _person(key: Column, salt: str, words: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    def word(kind: str) -> Column:
        return pick(words[kind], f"{salt} {kind}", key)

    return {
        "CUSNM": word("first"),
        "CUSLN": word("last"),
        "CUSCT": word("city"),
        "CUSCN": word("country"),
        "CUSNA": pick(words["country"], f"{salt} nationality", key),
        "CUSOC": word("occupation"),
        "CUSED": word("education"),
        "CUSDB": date_in(*BIRTH_DATES, f"{salt} birth", key),
        "CUSRK": pick(RISK_LEVELS, f"{salt} risk", key),
        "CUSCR": pick(CREDIT_GRADES, f"{salt} grade", key),
        "CUSAC2": below(5, f"{salt} accounts", key) + 1,
        "CUSTX": below(500, f"{salt} transactions", key) + 1,
        "CUSSC": below(850, f"{salt} score", key) + 300,
        "CUSLR": below(10, f"{salt} rank", key),
    }


def _composed(first: Column | None = None, last: Column | None = None) -> dict[str, Column]:
    first = F.col("CUSNM") if first is None else first
    last = F.col("CUSLN") if last is None else last
    return {
        "CUSFN": F.concat_ws(" ", first, last),
        "CUSEM": F.concat(F.lower(first), F.lit("."), F.lower(last), F.lit("@mail.com")),
    }


def balances(
    master: DataFrame, salt: str = "day1", low: float = 10.0, high: float = 100_000.0,
    words: Mapping[str, Sequence[str]] = WORDS,
) -> DataFrame:
    """One account per customer, numbered without gaps."""
    synth.require_range("amounts", low, high)
    key = F.col("CUSTID")
    return synth.one_per_parent(master, "CUSTID", "BLSQ").withColumns(
        {
            "BLACT": weighted(ACCOUNT_TYPE_WEIGHTS, f"{salt} account", key),
            "BLST": pick(words["status"], f"{salt} status", key),
            "BLAV": uniform(low, high, f"{salt} available", key),
            "BLTB": uniform(low, high, f"{salt} total", key),
            "BLCR": uniform(low, 2 * high + low, f"{salt} limit", key),
            "BLOD": date_in(*ACCOUNT_DATES, f"{salt} opened", key),
        }
    )


def transactions(
    master: DataFrame, rows: int, day: str, low: float = 10.0, high: float = 100_000.0,
    words: Mapping[str, Sequence[str]] = WORDS,
) -> DataFrame:
    """A day's transactions of existing customers; the id sequence starts over every day."""
    synth.require_positive(rows=rows)
    synth.require_date(day=day)
    synth.require_range("amounts", low, high)
    key = F.col("TRXSQ")

    def amount(name: str) -> Column:
        return uniform(low, high, f"{day} {name}", key)

    ids = synth.generate_rows(master.sparkSession, rows, "TRXSQ")
    drawn = synth.draw_parent(ids, "TRXSQ", master, "CUSTID", f"{day} customer").withColumns(
        {
            "TRXTYP": weighted(TRANSACTION_TYPE_WEIGHTS, f"{day} type", key),
            "TRXCUR": pick(words["currency"], f"{day} currency", key),
            "TRXDT": F.lit(date.fromisoformat(day)),
            "TRXAMT": amount("amount"),
            "TRXCM": amount("fee"),
            "TRXIM": amount("margin"),
            "TRXBA": amount("after"),
            "TRXBP": amount("before"),
            "TRXRK": uniform(0, 100, f"{day} risk", key),
        }
    )
    return drawn.withColumns(
        {
            "TRXID": F.concat("TRXTYP", padded(key, 8)),
            "TRXNT": F.col("TRXAMT") - F.col("TRXCM") - F.col("TRXIM"),
        }
    )
