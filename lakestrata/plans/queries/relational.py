"""Projections, filters, joins, aggregates, windows, sorts, unions, derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.derive import difference, fingerprint, or_zero, percent_of, product, tiers
from lakestrata.operators import aggregate, index, joins, latest, project, quality
from lakestrata.operators.aggregate import Metric
from lakestrata.plans import profile
from lakestrata.plans.queries import Registered, table
from lakestrata.session import new_scratch
from lakestrata.sources import settings

ORDER_METRICS_SQL = """
SELECT o_custkey AS customer_id,
       count(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS filled_orders,
       count(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS open_orders,
       coalesce(CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE)
                / nullif(count(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 0), 0.0) AS avg_filled_amount,
       coalesce(CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE)
                / nullif(count(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 0), 0.0) AS avg_open_amount,
       coalesce(CAST(sum(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE), 0.0)
           AS pending_amount
FROM orders GROUP BY o_custkey
"""
LATEST_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders
) WHERE rn = 1
"""
RISK_SQL = """CASE
  WHEN coalesce(c_acctbal, 0) >= 5000 AND c_mktsegment IN ('AUTOMOBILE','BUILDING')
       AND o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'LOW_RISK'
  WHEN coalesce(c_acctbal, 0) >= 2500 AND c_mktsegment IN ('MACHINERY','FURNITURE') THEN 'MEDIUM_RISK'
  WHEN coalesce(c_acctbal, 0) < 1000 OR c_mktsegment IN ('HOUSEHOLD') THEN 'HIGH_RISK'
  ELSE 'UNCLASSIFIED' END"""
BALANCE_SQL = """CASE
  WHEN coalesce(c_acctbal, 0) >= 7500 AND coalesce(o_totalprice, 0) >= 250000 THEN 'PREMIUM'
  WHEN coalesce(c_acctbal, 0) >= 2500 AND coalesce(o_totalprice, 0) >= 100000 THEN 'STANDARD'
  WHEN coalesce(c_acctbal, 0) > 0 THEN 'BASIC' ELSE 'NO_BALANCE' END"""
CUSTOMER_VIEW_SQL = f"""
SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id, c_acctbal AS account_balance,
       c_mktsegment AS market_segment, o_orderkey AS last_order_id, o_orderstatus AS last_order_status,
       o_totalprice AS last_order_amount, o_orderdate AS last_order_date, o_orderpriority AS last_order_priority,
       sha256(CAST(c_custkey AS VARCHAR)) AS customer_fingerprint, {RISK_SQL} AS risk_tier, {BALANCE_SQL} AS balance_tier
FROM customer LEFT JOIN ({LATEST_SQL}) l ON c_custkey = o_custkey
"""
PROFILE_SQL = f"""
SELECT v.customer_fingerprint, v.customer_id, v.customer_name, v.market_segment, v.risk_tier, v.balance_tier,
       v.account_balance, v.last_order_amount, v.last_order_date, v.last_order_status,
       m.filled_orders, m.open_orders, m.avg_filled_amount, m.avg_open_amount, m.pending_amount
FROM ({CUSTOMER_VIEW_SQL}) v JOIN ({ORDER_METRICS_SQL}) m ON v.customer_id = m.customer_id
"""


def customer_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.customer_profile(table(spark, sf, "customer"), table(spark, sf, "orders"))


# --- projections and filters -------------------------------------------------------------------


def b1_ingest_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    stamped = project.stamp_ingest(table(spark, sf, "orders"))
    return stamped.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("ingest_ts").alias("stamped"),
        F.count_distinct("ingest_ts").alias("distinct_stamps"),
    )


def b2_lead_columns(spark: SparkSession, sf: str) -> DataFrame:
    return project.lead_columns(table(spark, sf, "lineitem"), ["l_shipdate", "l_partkey", "l_returnflag"])


def b3_drop_if_present(spark: SparkSession, sf: str) -> DataFrame:
    return project.drop_present(table(spark, sf, "events"), ["props", "_rescued_data", "year", "month", "day"])


LINE_NAMES = {
    "l_orderkey": "order_id",
    "l_linenumber": "line_number",
    "l_partkey": "part_id",
    "l_suppkey": "supplier_id",
    "l_extendedprice": "price",
    "l_discount": "discount",
    "l_not_there": "never_present",
    "l_shipdate": "ship_date",
}


def b4_mapped_rename(spark: SparkSession, sf: str) -> DataFrame:
    return project.rename_project(table(spark, sf, "lineitem"), LINE_NAMES)


def b5_explicit_projection(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    joined = joins.left_once(docs, labels, ["doc_id"])
    return joined.select(
        "doc_id", "lang", "source", "n_chars", or_zero("quality", 0).alias("quality"), or_zero("toxic", 0).alias("toxic")
    )


def b6_comparison_filter(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    keep = (F.col("l_quantity") > 10) & ((F.col("l_discount") == 0.05) | (F.col("l_tax") < 0.02))
    return lines.filter(keep & ~(F.col("l_returnflag") == "R") & (F.col("l_linestatus") != "F")).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"
    )


def b7_membership_filter(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.filter(
        F.col("o_orderstatus").isin("F", "P") & ~F.col("o_orderpriority").isin("1-URGENT", "5-LOW")
    ).select("o_orderkey", "o_orderstatus", "o_orderpriority")


def b8_regex_filter(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    return parts.filter(
        quality.contains_word("p_name", ["RED", "bolt", "Ring"]) & quality.has_format("p_brand", "Brand#[0-9]{2}")
    ).select("p_partkey", "p_name", "p_brand")


def b9_null_predicates(spark: SparkSession, sf: str) -> DataFrame:
    joined = joins.left_once(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"])
    return joined.filter(F.col("quality").isNull() & F.col("text").isNotNull()).select("doc_id", "lang", "n_chars")


def b10_key_lookup(spark: SparkSession, sf: str) -> DataFrame:
    named = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("key"), F.col("c_name").alias("value"))
    return settings.lookup(named, "BUILDING")


# --- joins ---------------------------------------------------------------------------------------


def c1_left_join(spark: SparkSession, sf: str) -> DataFrame:
    newest = latest.latest_per_key(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], unique=True)
    right = newest.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return joins.left_once(table(spark, sf, "customer"), right, ["c_custkey"])


def c1_left_join_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), "l_orderkey", "l_linenumber")
    return joins.left_once(lines, table(spark, sf, "supplier").select("s_suppkey", "s_name"), ["s_suppkey"])


def c2_inner_join(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").withColumnRenamed("c_custkey", "customer_id")
    return joins.inner_once(customers, profile.order_metrics(table(spark, sf, "orders")), ["customer_id"])


def c3_left_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    orphans = joins.orphan_rows(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id", "doc_id")
    return orphans.select("doc_id", "lang", "source", "n_chars")


# --- aggregates ----------------------------------------------------------------------------------

EVENT_METRICS = (
    Metric("clicks", "count", "click"),
    Metric("purchases", "count", "purchase"),
    Metric("avg_click_value", "avg", "click"),
    Metric("avg_purchase_value", "avg", "purchase"),
    Metric("signup_value", "sum", "signup"),
)
EVENT_METRICS_SQL = """
SELECT user_id,
  count(CASE WHEN event_type = 'click' THEN value END) AS clicks,
  count(CASE WHEN event_type = 'purchase' THEN value END) AS purchases,
  coalesce(CAST(sum(CASE WHEN event_type = 'click' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE)
           / nullif(count(CASE WHEN event_type = 'click' THEN value END), 0), 0.0) AS avg_click_value,
  coalesce(CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE)
           / nullif(count(CASE WHEN event_type = 'purchase' THEN value END), 0), 0.0) AS avg_purchase_value,
  coalesce(CAST(sum(CASE WHEN event_type = 'signup' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE), 0.0) AS signup_value
FROM events GROUP BY user_id
"""


def d1_conditional_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return profile.order_metrics(table(spark, sf, "orders"))


def d2_empty_defaults(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    metrics = (Metric("refunds", "count", "refund"), Metric("avg_refund", "avg", "refund"), Metric("total_refund", "sum", "refund"))
    return aggregate.conditional_metrics(events, "user_id", "event_type", "value", metrics, scale=2)


def d3_codes_from_settings(spark: SparkSession, sf: str) -> DataFrame:
    """The codes are positions of a list kept in settings, here the statuses by frequency."""
    orders = table(spark, sf, "orders")
    name = f"settings_{new_scratch(spark, 'd3').rsplit('-', 1)[-1]}"
    leading = aggregate.top_k(aggregate.frequency(orders, "o_orderstatus"), "rows", 3, ["o_orderstatus"])
    codes = ",".join(row["o_orderstatus"] for row in leading.collect())
    settings.replace_settings(spark, name, {"status_codes": codes})
    try:
        first, second, third = settings.split_codes(settings.load_settings(spark, name, ("status_codes",))["status_codes"], 3)
    finally:
        spark.sql(f"DROP TABLE {name}")
    metrics = (Metric("first_orders", "count", first), Metric("second_orders", "count", second), Metric("third_amount", "sum", third))
    return aggregate.conditional_metrics(orders, "o_custkey", "o_orderstatus", "o_totalprice", metrics, scale=2)


def d4_global_count(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.row_count(table(spark, sf, "lineitem"))


def d5_global_max(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.next_key(table(spark, sf, "customer"), "c_custkey")


def d6_distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.distinct_keys(table(spark, sf, "lineitem"), "l_partkey")


def d6_distinct_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").agg(F.count_distinct("l_partkey").alias("parts"))


def d7_frequency_table(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.frequency(table(spark, sf, "lineitem"), "l_returnflag")


SHARES = {"F": 48.0, "O": 48.0, "P": 4.0, "X": 1.0}


def d8_share_of_total(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.class_shares(table(spark, sf, "orders"), "o_orderstatus", SHARES, 5.0)


COUNTED = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def d9_layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.layer_counts({name: table(spark, sf, name) for name in COUNTED})


# --- windows, sorts, unions ----------------------------------------------------------------------


def e1_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return profile.latest_orders(table(spark, sf, "orders"))


def e1_latest_per_key_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Only the date orders the rows; ties fall to the other columns."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return latest.latest_per_key(orders, ["o_custkey"], ["o_orderdate"])


def e2_dense_index(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    return index.dense_index(orders, ["o_orderdate", "o_orderkey"])


def e3_exact_fraction(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return index.pick_fraction(orders, ["o_orderkey"], 0.2, "seven")


def f1_total_sort(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.distinct_keys(table(spark, sf, "orders"), "o_custkey").orderBy("o_custkey")


def f2_filtered_top_k(spark: SparkSession, sf: str) -> DataFrame:
    metrics = profile.order_metrics(table(spark, sf, "orders")).filter("filled_orders > 0 OR open_orders > 0")
    return aggregate.top_k(metrics, "filled_orders", 10, ["customer_id"])


def f3_preview(spark: SparkSession, sf: str) -> DataFrame:
    shown = customer_profile(spark, sf).select("customer_id", "customer_name", "risk_tier", "filled_orders")
    return shown.orderBy("customer_id").limit(5)


def g1_union_aligned(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind")
    )
    return aggregate.union_aligned(customers, suppliers)


def g2_union_of_scalars(spark: SparkSession, sf: str) -> DataFrame:
    """Three counts as rows, from one scan."""
    status = F.col("o_orderstatus")
    counted = {"all_orders": F.count(F.lit(1)), "filled": F.count_if(status == "F"), "pending": F.count_if(status == "P")}
    found = table(spark, sf, "orders").agg(*(count.alias(name) for name, count in counted.items()))
    rows = (F.struct(F.lit(name).alias("table_name"), F.col(name).alias("rows")) for name in counted)
    return found.select(F.inline(F.array(*rows)))


# --- derived columns -----------------------------------------------------------------------------


def h1_risk_tier(spark: SparkSession, sf: str) -> DataFrame:
    view = profile.customer_view(table(spark, sf, "customer"), table(spark, sf, "orders"))
    return view.select("customer_id", "risk_tier")


def h2_balance_tier(spark: SparkSession, sf: str) -> DataFrame:
    view = profile.customer_view(table(spark, sf, "customer"), table(spark, sf, "orders"))
    return view.select("customer_id", "balance_tier")


def h3_activity_tier(spark: SparkSession, sf: str) -> DataFrame:
    counted = table(spark, sf, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("event_type").alias("kinds"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
    )
    n, kinds, bought = or_zero("events", 0), or_zero("kinds", 0), or_zero("purchases", 0)
    rules = [((n >= 70) & (kinds >= 3) & (bought >= 5), "VERY_ACTIVE"), ((n >= 60) & (kinds >= 2), "ACTIVE"), (n >= 1, "MODERATE")]
    return counted.select("user_id", tiers(rules, "INACTIVE").alias("activity_tier"))


def h4_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", fingerprint("c_custkey").alias("print"), fingerprint("c_custkey", "#s").alias("salted"))


def _line(spark: SparkSession, sf: str, **columns: Column) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", *(c.alias(n) for n, c in columns.items()))


def h5_net_of_fee(spark: SparkSession, sf: str) -> DataFrame:
    fee = F.nullif(F.col("l_tax"), F.lit(0.0))
    return _line(spark, sf, net=difference("l_extendedprice", fee))


def h6_fee_percent(spark: SparkSession, sf: str) -> DataFrame:
    return _line(spark, sf, fee_percent=percent_of("l_tax", "l_discount"))


def h7_balance_change(spark: SparkSession, sf: str) -> DataFrame:
    return _line(spark, sf, change=difference(F.nullif(F.col("l_discount"), F.lit(0.0)), F.nullif(F.col("l_tax"), F.lit(0.0))))


def h8_impact(spark: SparkSession, sf: str) -> DataFrame:
    return _line(spark, sf, impact=product("l_extendedprice", F.nullif(F.col("l_discount"), F.lit(0.0))))


_LINE = "SELECT l_orderkey, l_linenumber, l_partkey"
QUERIES: Registered = {
    "flagship_customer_profile": (customer_profile, PROFILE_SQL),
    "b1_ingest_timestamp": (b1_ingest_timestamp, "SELECT count(*) AS rows, count(*) AS stamped, CAST(1 AS BIGINT) AS distinct_stamps FROM orders"),
    "b2_lead_columns": (b2_lead_columns, "SELECT * FROM lineitem"),
    "b3_drop_if_present": (b3_drop_if_present, "SELECT event_id, ts, user_id, event_type, value FROM events"),
    "b4_mapped_rename": (b4_mapped_rename, """SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS part_id,
        l_suppkey AS supplier_id, l_extendedprice AS price, l_discount AS discount, l_shipdate AS ship_date FROM lineitem"""),
    "b5_explicit_projection": (b5_explicit_projection, """SELECT d.doc_id, d.lang, d.source, d.n_chars, coalesce(l.quality, 0) AS quality,
        coalesce(l.toxic, 0) AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""),
    "b6_comparison_filter": (b6_comparison_filter, """SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem
        WHERE l_quantity > 10 AND (l_discount = CAST(0.05 AS DOUBLE) OR l_tax < CAST(0.02 AS DOUBLE))
          AND NOT (l_returnflag = 'R') AND l_linestatus <> 'F'"""),
    "b7_membership_filter": (b7_membership_filter, """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
        WHERE o_orderstatus IN ('F','P') AND o_orderpriority NOT IN ('1-URGENT','5-LOW')"""),
    "b8_regex_filter": (b8_regex_filter, r"""SELECT p_partkey, p_name, p_brand FROM part
        WHERE regexp_matches(p_name, '(?i)\b(RED|bolt|Ring)\b') AND regexp_full_match(p_brand, 'Brand#[0-9]{2}')"""),
    "b9_null_predicates": (b9_null_predicates, """SELECT d.doc_id, d.lang, d.n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        WHERE l.quality IS NULL AND d.text IS NOT NULL"""),
    "b10_key_lookup": (b10_key_lookup, "SELECT c_mktsegment AS key, c_name AS value FROM customer WHERE c_mktsegment = 'BUILDING'"),
    "c1_left_join": (c1_left_join, """SELECT c.*, l.o_orderkey, l.o_totalprice FROM customer c LEFT JOIN (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders) l ON c.c_custkey = l.o_custkey AND l.rn = 1"""),
    "c1_left_join_hot_keys": (c1_left_join_hot_keys, """SELECT l_suppkey AS s_suppkey, l_orderkey, l_linenumber, s_name FROM lineitem
        LEFT JOIN (SELECT s_suppkey AS k, s_name FROM supplier) ON l_suppkey = k"""),
    "c2_inner_join": (c2_inner_join, f"""SELECT c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, m.*
        FROM customer c JOIN ({ORDER_METRICS_SQL}) m ON c.c_custkey = m.customer_id"""),
    "c3_left_anti_join": (c3_left_anti_join, """SELECT doc_id, lang, source, n_chars FROM documents d
        WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""),
    "d1_conditional_metrics": (d1_conditional_metrics, ORDER_METRICS_SQL),
    "d2_empty_defaults": (d2_empty_defaults, """SELECT user_id, CAST(0 AS BIGINT) AS refunds, CAST(0 AS DOUBLE) AS avg_refund,
        CAST(0 AS DOUBLE) AS total_refund FROM events GROUP BY user_id"""),
    "d3_codes_from_settings": (d3_codes_from_settings, """WITH ranked AS (
          SELECT o_orderstatus, row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) AS place FROM orders GROUP BY o_orderstatus)
        SELECT o_custkey, count(CASE WHEN place = 1 THEN o_totalprice END) AS first_orders,
          count(CASE WHEN place = 2 THEN o_totalprice END) AS second_orders,
          coalesce(CAST(sum(CASE WHEN place = 3 THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE), 0.0) AS third_amount
        FROM orders JOIN ranked USING (o_orderstatus) GROUP BY o_custkey"""),
    "d4_global_count": (d4_global_count, "SELECT count(*) AS rows FROM lineitem"),
    "d5_global_max": (d5_global_max, "SELECT max(c_custkey) AS max_key, coalesce(max(c_custkey), 0) + 1 AS next_key FROM customer"),
    "d6_distinct_keys": (d6_distinct_keys, "SELECT DISTINCT l_partkey FROM lineitem"),
    "d6_distinct_count": (d6_distinct_count, "SELECT count(DISTINCT l_partkey) AS parts FROM lineitem"),
    "d7_frequency_table": (d7_frequency_table, "SELECT l_returnflag, count(*) AS rows FROM lineitem GROUP BY l_returnflag"),
    "d8_share_of_total": (d8_share_of_total, """SELECT class, rows, share, target, abs(share - target) <= 5.0 AS met FROM (
        SELECT class, target, count(o_orderkey) AS rows, count(o_orderkey) * 100 / (SELECT count(*) FROM orders) AS share
        FROM (VALUES ('F', CAST(48 AS DOUBLE)), ('O', 48.0), ('P', 4.0), ('X', 1.0)) v(class, target)
        LEFT JOIN orders ON o_orderstatus = class GROUP BY class, target)"""),
    "d9_layer_counts": (d9_layer_counts, " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in COUNTED)),
    "e1_latest_per_key": (e1_latest_per_key, LATEST_SQL),
    "e1_latest_per_key_ties": (e1_latest_per_key_ties, """SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) AS rn
        FROM orders) WHERE rn = 1"""),
    "e2_dense_index": (e2_dense_index, """SELECT o_orderdate, o_orderkey,
        row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx FROM orders"""),
    "e3_exact_fraction": (e3_exact_fraction, """SELECT o_orderkey, o_custkey,
        row_number() OVER (ORDER BY CAST('0x' || substr(md5('seven|' || o_orderkey), 1, 15) AS BIGINT), o_orderkey)
          <= (SELECT CAST(floor(count(*) * 0.2) AS BIGINT) FROM orders) AS picked FROM orders"""),
    "f1_total_sort": (f1_total_sort, "SELECT DISTINCT o_custkey FROM orders ORDER BY o_custkey"),
    "f2_filtered_top_k": (f2_filtered_top_k, f"""SELECT * FROM ({ORDER_METRICS_SQL}) WHERE filled_orders > 0 OR open_orders > 0
        ORDER BY filled_orders DESC, customer_id LIMIT 10"""),
    "f3_preview": (f3_preview, f"""SELECT customer_id, customer_name, risk_tier, filled_orders FROM ({PROFILE_SQL})
        ORDER BY customer_id LIMIT 5"""),
    "g1_union_aligned": (g1_union_aligned, """SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
        UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier"""),
    "g2_union_of_scalars": (g2_union_of_scalars, """SELECT 'all_orders' AS table_name, count(*) AS rows FROM orders
        UNION ALL SELECT 'filled', count(*) FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 'pending', count(*) FROM orders WHERE o_orderstatus = 'P'"""),
    "h1_risk_tier": (h1_risk_tier, f"SELECT customer_id, risk_tier FROM ({CUSTOMER_VIEW_SQL})"),
    "h2_balance_tier": (h2_balance_tier, f"SELECT customer_id, balance_tier FROM ({CUSTOMER_VIEW_SQL})"),
    "h3_activity_tier": (h3_activity_tier, """SELECT user_id, CASE
        WHEN count(*) >= 70 AND count(DISTINCT event_type) >= 3 AND count(*) FILTER (event_type = 'purchase') >= 5 THEN 'VERY_ACTIVE'
        WHEN count(*) >= 60 AND count(DISTINCT event_type) >= 2 THEN 'ACTIVE' WHEN count(*) >= 1 THEN 'MODERATE'
        ELSE 'INACTIVE' END AS activity_tier FROM events GROUP BY user_id"""),
    "h4_fingerprint": (h4_fingerprint, """SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR)) AS print,
        sha256(CAST(c_custkey AS VARCHAR) || '#s') AS salted FROM customer"""),
    "h5_net_of_fee": (h5_net_of_fee, f"{_LINE}, coalesce(l_extendedprice, 0) - coalesce(nullif(l_tax, 0), 0) AS net FROM lineitem"),
    "h6_fee_percent": (h6_fee_percent, f"""{_LINE}, CASE WHEN l_discount <> 0 AND l_discount IS NOT NULL
        THEN coalesce(l_tax, 0) / l_discount * 100 ELSE 0.0 END AS fee_percent FROM lineitem"""),
    "h7_balance_change": (h7_balance_change, f"{_LINE}, coalesce(nullif(l_discount, 0), 0) - coalesce(nullif(l_tax, 0), 0) AS change FROM lineitem"),
    "h8_impact": (h8_impact, f"{_LINE}, coalesce(l_extendedprice, 0) * coalesce(nullif(l_discount, 0), 0) AS impact FROM lineitem"),
}
