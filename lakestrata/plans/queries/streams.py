"""Streaming and incremental refresh: every result must equal the query over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators.aggregate import Metric
from lakestrata.functions.derive import difference, fingerprint, percent_of
from lakestrata.operators.aggregate import conditional_metrics
from lakestrata.operators.project import lead_columns, rename_project, stamp_ingest
from lakestrata.plans import profile
from lakestrata.plans.queries import Registered, table
from lakestrata.plans.queries.relational import (
    CUSTOMER_VIEW_SQL,
    EVENT_METRICS,
    EVENT_METRICS_SQL,
    PROFILE_SQL,
    customer_profile,
)
from lakestrata.plans.queries.sources import Landing, deliveries
from lakestrata.session import new_scratch
from lakestrata.sources import tables
from lakestrata.sources.ingest import ingest_files, read_ingested
from lakestrata.streaming.append import append_refresh, read_appended
from lakestrata.streaming.group_refresh import group_refresh, read_metrics
from lakestrata.streaming.view_refresh import read_view, stateful_session, view_refresh

BUCKETS = 8
MAX_FILES = 1_000


def i1_streaming_transform(spark: SparkSession, sf: str) -> DataFrame:
    landing = Landing.new(spark, "i1")

    def transform(df: DataFrame) -> DataFrame:
        return lead_columns(stamp_ingest(df), ["ingest_ts", "user_id"])

    for delivery in deliveries(spark, sf):
        landing.drop(delivery)
        stream = spark.readStream.schema(delivery.schema).parquet(landing.source)
        append_refresh(stream, transform, f"{landing.root}/table", f"{landing.root}/checkpoint")
    stored = read_appended(spark, f"{landing.root}/table", transform(delivery).schema)
    return stored.withColumn("stamped", F.col("ingest_ts").isNotNull()).drop("ingest_ts")


LINE_NAMES = {
    "l_orderkey": "order_id",
    "l_linenumber": "line_number",
    "l_extendedprice": "price",
    "l_discount": "discount",
    "l_tax": "tax",
    "l_shipdate": "ship_date",
}


def silver_lines(bronze: DataFrame) -> DataFrame:
    """Row by row, so it runs on a batch and on a stream alike."""
    return rename_project(bronze, LINE_NAMES).withColumns(
        {
            "line_print": fingerprint(F.concat_ws("-", "order_id", "line_number")),
            "net": difference("price", "tax"),
            "fee_percent": percent_of("tax", "discount"),
        }
    )


def i2_append_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Files to bronze to silver, twice; the second run sees only what is new."""
    landing = Landing.new(spark, "i2")
    lines = table(spark, sf, "lineitem")
    early = F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    for delivery in (lines.filter(early), lines.filter(~early)):
        landing.drop(delivery)
        landing.take()
        append_refresh(landing.stream(), silver_lines, f"{landing.root}/silver", f"{landing.root}/silver_checkpoint", ["ship_date"])
    return read_appended(spark, f"{landing.root}/silver", silver_lines(landing.read()).schema)


def i3_group_refresh(spark: SparkSession, sf: str) -> DataFrame:
    landing = Landing.new(spark, "i3")
    target = f"{landing.root}/metrics"
    for delivery in deliveries(spark, sf):
        landing.drop(delivery)
        stream = spark.readStream.schema(delivery.schema).parquet(landing.source)
        group_refresh(
            stream, target, f"{landing.root}/checkpoint", "user_id", "event_type", "value", scale=2, fold_after=2
        )
    return read_metrics(spark, target, "user_id", EVENT_METRICS)


LATER_METRICS = (Metric("signups", "count", "signup"), Metric("avg_signup", "avg", "signup"), Metric("click_value", "sum", "click"))


def i3_changed_list(spark: SparkSession, sf: str) -> DataFrame:
    """The list of metrics changes after all deliveries came in: the same partials answer it."""
    landing = Landing.new(spark, "i3c")
    target = f"{landing.root}/metrics"
    for delivery in deliveries(spark, sf):
        landing.drop(delivery)
        stream = spark.readStream.schema(delivery.schema).parquet(landing.source)
        group_refresh(stream, target, f"{landing.root}/checkpoint", "user_id", "event_type", "value", scale=2)
        read_metrics(spark, target, "user_id", EVENT_METRICS)
    return read_metrics(spark, target, "user_id", LATER_METRICS)


def i4_affected_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The customer view after customers and two deliveries of orders: the second only changes its own keys."""
    root = new_scratch(spark, "i4")
    customers, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    early = F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    customers.write.parquet(f"{root}/customers")
    own = stateful_session(spark, BUCKETS)

    def stream(rows: DataFrame, name: str) -> DataFrame:
        return own.readStream.schema(rows.schema).option("maxFilesPerTrigger", MAX_FILES).parquet(f"{root}/{name}")

    for delivery in (orders.filter(early), orders.filter(~early)):
        _renamed(delivery).write.mode("append").parquet(f"{root}/orders")
        view_refresh(
            stream(customers, "customers"), stream(_renamed(orders), "orders"), f"{root}/view", f"{root}/checkpoint",
            ["c_custkey"], (["c_name"], ["o_orderdate", "o_orderkey"]), profile.paired_view, ["customer_id"],
        )
    schema = profile.join_latest(customers, orders).schema
    return read_view(spark, f"{root}/view", schema, ["customer_id"])


def _renamed(orders: DataFrame) -> DataFrame:
    return orders.withColumnRenamed("o_custkey", "c_custkey")


def i5_full_recompute(spark: SparkSession, sf: str) -> DataFrame:
    root = new_scratch(spark, "i5")
    for _ in range(2):
        tables.full_refresh(customer_profile(spark, sf), root)
    return tables.current_version(spark, root)


def i6_full_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """From the landed files into a new table with a new checkpoint, then the metrics on top."""
    landing = Landing.new(spark, "i6")
    first, *rest = deliveries(spark, sf)
    landing.drop(first)
    landing.take()
    for delivery in rest:
        landing.drop(delivery)
    fresh = f"{landing.root}/rebuilt"
    ingest_files(spark, landing.source, f"{fresh}/table", f"{fresh}/checkpoint", f"{fresh}/schema")
    bronze = read_ingested(spark, f"{fresh}/table", f"{fresh}/schema")
    metrics = conditional_metrics(bronze, "user_id", "event_type", "value", EVENT_METRICS, scale=2)
    tables.full_refresh(metrics, f"{fresh}/metrics")
    return tables.current_version(spark, f"{fresh}/metrics")


QUERIES: Registered = {
    "i1_streaming_transform": (i1_streaming_transform, "SELECT *, true AS stamped FROM events"),
    "i2_append_refresh": (i2_append_refresh, """SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_extendedprice AS price,
        l_discount AS discount, l_tax AS tax, l_shipdate AS ship_date, sha256(l_orderkey || '-' || l_linenumber) AS line_print,
        coalesce(l_extendedprice, 0) - coalesce(l_tax, 0) AS net,
        CASE WHEN l_discount <> 0 AND l_discount IS NOT NULL THEN coalesce(l_tax, 0) / l_discount * 100 ELSE 0.0 END AS fee_percent
        FROM lineitem"""),
    "i3_changed_list": (i3_changed_list, """SELECT user_id, count(value) FILTER (event_type = 'signup') AS signups,
        coalesce(CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'signup') AS DOUBLE)
          / nullif(count(value) FILTER (event_type = 'signup'), 0), 0.0) AS avg_signup,
        coalesce(CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'click') AS DOUBLE), 0.0) AS click_value
        FROM events GROUP BY user_id"""),
    "i3_group_refresh": (i3_group_refresh, EVENT_METRICS_SQL),
    "i4_affected_keys": (i4_affected_keys, CUSTOMER_VIEW_SQL),
    "i5_full_recompute": (i5_full_recompute, PROFILE_SQL),
    "i6_full_rebuild": (i6_full_rebuild, EVENT_METRICS_SQL),
}
