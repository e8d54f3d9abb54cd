"""The flagship flow on orders data: customer view, order metrics, and the profile joined from both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.derive import fingerprint, or_zero, tiers
from lakestrata.operators.aggregate import Metric, conditional_metrics
from lakestrata.operators.joins import inner_once, left_once
from lakestrata.operators.latest import latest_per_key
from lakestrata.operators.project import rename_project

CUSTOMER_NAMES = {
    "c_custkey": "customer_id",
    "c_name": "customer_name",
    "c_nationkey": "nation_id",
    "c_acctbal": "account_balance",
    "c_mktsegment": "market_segment",
}
ORDER_NAMES = {
    "o_custkey": "customer_id",
    "o_orderkey": "last_order_id",
    "o_orderstatus": "last_order_status",
    "o_totalprice": "last_order_amount",
    "o_orderdate": "last_order_date",
    "o_orderpriority": "last_order_priority",
}
ORDER_METRICS = (
    Metric("filled_orders", "count", "F"),
    Metric("open_orders", "count", "O"),
    Metric("avg_filled_amount", "avg", "F"),
    Metric("avg_open_amount", "avg", "O"),
    Metric("pending_amount", "sum", "P"),
)


def risk_tier() -> Column:
    balance = or_zero("account_balance")
    segment, priority = F.col("market_segment"), F.col("last_order_priority")
    return tiers(
        [
            ((balance >= 5000) & segment.isin("AUTOMOBILE", "BUILDING") & priority.isin("1-URGENT", "2-HIGH"), "LOW_RISK"),
            ((balance >= 2500) & segment.isin("MACHINERY", "FURNITURE"), "MEDIUM_RISK"),
            ((balance < 1000) | segment.isin("HOUSEHOLD"), "HIGH_RISK"),
        ],
        "UNCLASSIFIED",
    )


def balance_tier() -> Column:
    balance, amount = or_zero("account_balance"), or_zero("last_order_amount")
    return tiers(
        [
            ((balance >= 7500) & (amount >= 250000), "PREMIUM"),
            ((balance >= 2500) & (amount >= 100000), "STANDARD"),
            (balance > 0, "BASIC"),
        ],
        "NO_BALANCE",
    )


def latest_orders(orders: DataFrame) -> DataFrame:
    return latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], unique=True)


def customer_view(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Every customer with their latest order, two tiers and a fingerprint."""
    return join_latest(customer, latest_orders(orders))


def join_latest(customer: DataFrame, newest_orders: DataFrame) -> DataFrame:
    joined = left_once(
        rename_project(customer, CUSTOMER_NAMES, strict=True),
        rename_project(newest_orders, ORDER_NAMES, strict=True),
        ["customer_id"],
    )
    return _derived(joined)


def paired_view(pairs: DataFrame) -> DataFrame:
    """The view from (``c_custkey``, newest customer, newest order or NULL); the order's key is ``c_custkey``."""
    flat = pairs.select("c_custkey", "left.*", "right.*")
    return _derived(rename_project(flat, {**CUSTOMER_NAMES, **{a: b for a, b in ORDER_NAMES.items() if a != "o_custkey"}}, strict=True))


def _derived(joined: DataFrame) -> DataFrame:
    return joined.withColumns(
        {
            "customer_fingerprint": fingerprint("customer_id"),
            "risk_tier": risk_tier(),
            "balance_tier": balance_tier(),
        }
    )


def order_metrics(orders: DataFrame) -> DataFrame:
    metrics = conditional_metrics(orders, "o_custkey", "o_orderstatus", "o_totalprice", ORDER_METRICS, scale=2)
    return metrics.withColumnRenamed("o_custkey", "customer_id")


def customer_profile(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer that has orders."""
    joined = inner_once(customer_view(customer, orders), order_metrics(orders), ["customer_id"])
    return joined.select(
        "customer_fingerprint",
        "customer_id",
        "customer_name",
        "market_segment",
        "risk_tier",
        "balance_tier",
        "account_balance",
        "last_order_amount",
        "last_order_date",
        "last_order_status",
        *(m.name for m in ORDER_METRICS),
    )
