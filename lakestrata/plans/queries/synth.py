"""Seeded tables, sized and keyed by the given ones."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.derive import padded, timestamp_of
from lakestrata.functions.draws import below, date_in, draw, pick, uniform, weighted
from lakestrata.operators import synth
from lakestrata.operators.index import dense_index
from lakestrata.operators.lookup import join_by_position
from lakestrata.plans import bank
from lakestrata.plans.queries import Registered, table

COLORS = ("amber", "blue", "cyan", "green", "red")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
FIRST, LAST = ("Ada", "Ben", "Cleo", "Dan"), ("Ames", "Boyd", "Cruz")


def _keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey")


def l1_row_generator(spark: SparkSession, sf: str) -> DataFrame:
    return synth.generate_rows(spark, table(spark, sf, "lineitem").count())


def l2_pick_from_list(spark: SparkSession, sf: str) -> DataFrame:
    return _keys(spark, sf).withColumn("color", pick(COLORS, "color", "o_orderkey"))


def l3_weighted_category(spark: SparkSession, sf: str) -> DataFrame:
    return _keys(spark, sf).withColumns(
        {
            "transaction_type": weighted(bank.TRANSACTION_TYPE_WEIGHTS, "type", "o_orderkey"),
            "account_type": weighted(bank.ACCOUNT_TYPE_WEIGHTS, "account", "o_orderkey"),
        }
    )


def l4_date_in_range(spark: SparkSession, sf: str) -> DataFrame:
    return _keys(spark, sf).withColumn("day", date_in(date(2005, 1, 1), date(2025, 12, 31), "day", "o_orderkey"))


def l5_uniform_number(spark: SparkSession, sf: str) -> DataFrame:
    return _keys(spark, sf).withColumn("amount", uniform(10, 100_000, "amount", "o_orderkey"))


def l6_composed_columns(spark: SparkSession, sf: str) -> DataFrame:
    drawn = _keys(spark, sf).withColumns(
        {
            "first_name": pick(FIRST, "first", "o_orderkey"),
            "last_name": pick(LAST, "last", "o_orderkey"),
            "kind": weighted(bank.TRANSACTION_TYPE_WEIGHTS, "type", "o_orderkey"),
            "amount": uniform(10, 100_000, "amount", "o_orderkey"),
            "fee": uniform(10, 1_000, "fee", "o_orderkey"),
        }
    )
    return drawn.withColumns(
        {
            "full_name": F.concat_ws(" ", "first_name", "last_name"),
            "email": F.concat(F.lower("first_name"), F.lit("."), F.lower("last_name"), F.col("o_orderkey"), F.lit("@mail.test")),
            "transaction_id": F.concat("kind", padded("o_orderkey", 8)),
            "short_id": F.lpad((F.col("o_orderkey") + 1_000_000).cast("string"), 5, "0"),
            "net": F.col("amount") - F.col("fee"),
        }
    )


def l6_composed_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    """A moment composed of a drawn date and a drawn time of day, both as text; some times name none."""
    drawn = _keys(spark, sf).withColumn("day_text", date_in(date(2005, 1, 1), date(2025, 12, 31), "day", "o_orderkey").cast("string"))
    parts = [padded(below(limit, salt, "o_orderkey"), 2) for limit, salt in ((25, "hour"), (60, "minute"), (60, "second"))]
    timed = drawn.withColumn("time_text", F.when(below(10, "known", "o_orderkey") > 0, F.concat_ws(":", *parts)))
    return timed.withColumn("happened_at", timestamp_of("day_text", "time_text").cast("timestamp_ntz"))


def c4_join_on_computed_index(spark: SparkSession, sf: str) -> DataFrame:
    """Whole order lines with the customer at a computed position. A third of them share one position;
    some have none, some one past the end, and keep a NULL."""
    customers = dense_index(table(spark, sf, "customer").select("c_custkey"), ["c_custkey"])
    size = customers.agg(F.max("idx") + 1).first()[0]
    slot = (
        F.when(F.col("l_partkey") % 3 == 0, F.lit(7))
        .when(F.col("l_linenumber") == 7, F.lit(None))
        .when(F.col("l_linenumber") == 6, F.lit(size))
        .otherwise(draw("slot", "l_orderkey", "l_linenumber") % F.lit(size))
    )
    lines = table(spark, sf, "lineitem").withColumn("slot", slot)
    return join_by_position(lines, "slot", customers)


def l7_draw_parent(spark: SparkSession, sf: str) -> DataFrame:
    return synth.draw_parent(_keys(spark, sf), "o_orderkey", table(spark, sf, "customer"), "c_custkey", "parent")


def l8_one_per_parent(spark: SparkSession, sf: str) -> DataFrame:
    rows = synth.one_per_parent(table(spark, sf, "orders"), "o_custkey")
    return rows.withColumn("account_type", weighted(bank.ACCOUNT_TYPE_WEIGHTS, "account", "o_custkey"))


def _name(segment: Column, key: Column) -> Column:
    return F.concat(segment, F.lit("#"), padded(key, 9))


def l9_snapshot_mutation(spark: SparkSession, sf: str) -> DataFrame:
    """A fifth of the customers change segment, then name and balance; 0.6 % are new."""
    key = F.col("c_custkey")
    return synth.mutate_snapshot(
        table(spark, sf, "customer"),
        "c_custkey",
        0.2,
        [
            {"c_mktsegment": pick(SEGMENTS, "segment2", key), "c_acctbal": uniform(10, 100_000, "balance2", key)},
            {"c_name": _name(F.col("c_mktsegment"), key)},
        ],
        0.006,
        lambda k: {
            "c_name": _name(F.lit("new"), k),
            "c_nationkey": F.lit(0),
            "c_acctbal": uniform(10, 100_000, "balance", k),
            "c_mktsegment": pick(SEGMENTS, "segment", k),
        },
        "mutate",
    )


def _draw(salt: str, key: str) -> str:
    return f"CAST('0x' || substr(md5('{salt}|' || {key}), 1, 15) AS BIGINT)"


def _pick(values: tuple[str, ...], salt: str, key: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{items}], {_draw(salt, key)} % {len(values)} + 1)"


def _uniform(low: int, high: int, salt: str, key: str) -> str:
    return f"CAST({low} AS DOUBLE) + CAST({_draw(salt, key)} AS DOUBLE) / CAST(1152921504606846976 AS DOUBLE) * CAST({high - low} AS DOUBLE)"


def _weighted(weights: tuple[tuple[str, int], ...], salt: str, key: str) -> str:
    total, cases = 0, []
    for label, weight in weights:
        total += weight
        cases.append(f"WHEN d < {total} THEN '{label}'")
    return f"(SELECT CASE {' '.join(cases)} END FROM (SELECT {_draw(salt, key)} % {total} AS d))"


_K = "o_orderkey"
_TYPE = _weighted(bank.TRANSACTION_TYPE_WEIGHTS, "type", _K)
QUERIES: Registered = {
    "l1_row_generator": (l1_row_generator, "SELECT unnest(range(1, (SELECT count(*) + 1 FROM lineitem))) AS id"),
    "l2_pick_from_list": (l2_pick_from_list, f"SELECT o_orderkey, {_pick(COLORS, 'color', _K)} AS color FROM orders"),
    "l3_weighted_category": (l3_weighted_category, f"""SELECT o_orderkey, {_TYPE} AS transaction_type,
        {_weighted(bank.ACCOUNT_TYPE_WEIGHTS, 'account', _K)} AS account_type FROM orders"""),
    "l4_date_in_range": (l4_date_in_range, f"""SELECT o_orderkey, DATE '2005-01-01' + CAST({_draw('day', _K)} %
        (DATE '2025-12-31' - DATE '2005-01-01') AS INTEGER) AS day FROM orders"""),
    "l5_uniform_number": (l5_uniform_number, f"SELECT o_orderkey, {_uniform(10, 100_000, 'amount', _K)} AS amount FROM orders"),
    "l6_composed_columns": (l6_composed_columns, f"""SELECT *, first_name || ' ' || last_name AS full_name,
        lower(first_name) || '.' || lower(last_name) || o_orderkey || '@mail.test' AS email,
        kind || lpad(CAST(o_orderkey AS VARCHAR), greatest(8, length(CAST(o_orderkey AS VARCHAR)))::INT, '0') AS transaction_id,
        lpad(CAST(o_orderkey + 1000000 AS VARCHAR), 5, '0') AS short_id, amount - fee AS net FROM (
        SELECT o_orderkey, {_pick(FIRST, 'first', _K)} AS first_name, {_pick(LAST, 'last', _K)} AS last_name, {_TYPE} AS kind,
          {_uniform(10, 100_000, 'amount', _K)} AS amount, {_uniform(10, 1_000, 'fee', _K)} AS fee FROM orders)"""),
    "l6_composed_timestamp": (l6_composed_timestamp, f"""SELECT *, try_strptime(day_text || ' ' || time_text, '%Y-%m-%d %H:%M:%S') AS happened_at FROM (
        SELECT o_orderkey, CAST(DATE '2005-01-01' + CAST({_draw('day', _K)} % (DATE '2025-12-31' - DATE '2005-01-01') AS INTEGER) AS VARCHAR) AS day_text,
          CASE WHEN {_draw('known', _K)} % 10 > 0 THEN concat_ws(':', {", ".join(f"lpad(CAST({_draw(s, _K)} % {n} AS VARCHAR), 2, '0')" for n, s in ((25, 'hour'), (60, 'minute'), (60, 'second')))}) END AS time_text
        FROM orders)"""),
    "c4_join_on_computed_index": (c4_join_on_computed_index, f"""SELECT l.*, c_custkey FROM (SELECT *,
          CASE WHEN l_partkey % 3 = 0 THEN 7 WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN (SELECT count(*) FROM customer)
            ELSE {_draw('slot', "l_orderkey || '|' || l_linenumber")} % (SELECT count(*) FROM customer) END AS slot FROM lineitem) l
        LEFT JOIN (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS slot FROM customer) USING (slot)"""),
    "l7_draw_parent": (l7_draw_parent, f"""SELECT o_orderkey, c_custkey FROM orders JOIN (
        SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS slot FROM customer)
        ON {_draw('parent', _K)} % (SELECT count(*) FROM customer) = slot"""),
    "l8_one_per_parent": (l8_one_per_parent, f"""SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) AS seq,
        {_weighted(bank.ACCOUNT_TYPE_WEIGHTS, 'account', 'o_custkey')} AS account_type FROM (SELECT DISTINCT o_custkey FROM orders)"""),
    "l9_snapshot_mutation": (l9_snapshot_mutation, f"""WITH ranked AS (
          SELECT *, row_number() OVER (ORDER BY {_draw('mutate', 'c_custkey')}, c_custkey)
            <= (SELECT CAST(floor(count(*) * 0.2) AS BIGINT) FROM customer) AS picked FROM customer),
        changed AS (SELECT c_custkey, c_name, c_nationkey, picked,
          CASE WHEN picked THEN {_uniform(10, 100_000, 'balance2', 'c_custkey')} ELSE c_acctbal END AS c_acctbal,
          CASE WHEN picked THEN {_pick(SEGMENTS, 'segment2', 'c_custkey')} ELSE c_mktsegment END AS c_mktsegment FROM ranked),
        fresh AS (SELECT unnest(range((SELECT max(c_custkey) + 1 FROM customer),
          (SELECT max(c_custkey) + 1 + CAST(floor(count(*) * 0.006) AS BIGINT) FROM customer))) AS k)
        SELECT c_custkey, CASE WHEN picked THEN c_mktsegment || '#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') ELSE c_name END AS c_name,
          c_nationkey, c_acctbal, c_mktsegment FROM changed
        UNION ALL SELECT k, 'new#' || lpad(CAST(k AS VARCHAR), 9, '0'), 0, {_uniform(10, 100_000, 'balance', 'k')},
          {_pick(SEGMENTS, 'segment', 'k')} FROM fresh"""),
}
