"""Expectations and checks, stored layout, change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators import aggregate, changes, layout, quality
from lakestrata.plans.queries.relational import COUNTED
from lakestrata.plans.queries import Registered, table
from lakestrata.session import new_scratch
from lakestrata.sources import fs
from lakestrata.sources.checked import checked_refresh
from lakestrata.sources.tables import current_version, write_files

LINE_RULES = {
    "price_positive": "l_extendedprice > 0",
    "discount_above_tax": "l_discount > l_tax",
    "shipped_since_1999": "l_shipdate > TIMESTAMP_NTZ '1998-12-31 00:00:00'",
    "tax_share_below_one": "l_tax / nullif(l_discount, 0) < 1",
    "key_not_null": "l_orderkey IS NOT NULL",
}


def j1_expectations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.expectation_report(table(spark, sf, "lineitem"), LINE_RULES)


def j1_observed_expectations(spark: SparkSession, sf: str) -> DataFrame:
    """The same numbers as a by-product of writing the table."""
    watched, observation = quality.observe_rules(table(spark, sf, "lineitem"), LINE_RULES)
    watched.write.parquet(new_scratch(spark, "j1"))
    return quality.observed_report(spark, observation, LINE_RULES)


def j2_drop_unmet(spark: SparkSession, sf: str) -> DataFrame:
    kept = quality.drop_unmet(table(spark, sf, "lineitem"), LINE_RULES)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax", "l_shipdate")


def j2_drop_on_write(spark: SparkSession, sf: str) -> DataFrame:
    """Counted, dropped and published in one write."""
    root = new_scratch(spark, "j2")
    checked_refresh(table(spark, sf, "lineitem"), root, LINE_RULES, unmet="drop")
    return current_version(spark, root).select("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax", "l_shipdate")


def j3_key_check(spark: SparkSession, sf: str) -> DataFrame:
    return quality.key_check(table(spark, sf, "orders"), "o_orderkey")


def j4_reference_check(spark: SparkSession, sf: str) -> DataFrame:
    return quality.reference_check(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id", "doc_id")


def j4_one_to_one(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth document key and the keys of toxic labels are NULL on purpose."""
    docs = table(spark, sf, "documents").withColumn("key", F.when(F.col("doc_id") % 10 != 0, F.col("doc_id")))
    labels = table(spark, sf, "labels").withColumn("key", F.when(F.col("toxic") == 0, F.col("doc_id")))
    return quality.one_to_one_check(docs, labels, "key", "key")


def j5_domain_range_format(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return quality.violations(
        orders,
        {
            "status_known": F.col("o_orderstatus").isin("F", "O"),
            "year_in_range": F.year("o_orderdate").between(1996, 2000),
            "priority_format": quality.has_format("o_orderpriority", "[1-5]-[A-Z ]+"),
            "amount_not_negative": F.col("o_totalprice") >= 0,
        },
    )


def j6_schema_census(spark: SparkSession, sf: str) -> DataFrame:
    """Columns per type of every given table."""
    rows = []
    for name in COUNTED:
        census = quality.schema_census(table(spark, sf, name).schema)
        rows += [(name, kind, count) for kind, count in census.items() if kind != "columns"]
    return spark.createDataFrame(rows, "table_name string, type string, columns long")


#: of a Spark type the name DuckDB reports for the same Parquet column
TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "array<float>": "FLOAT[]"}


def _census_sql() -> str:
    names = " ".join(f"WHEN '{known}' THEN '{ours}'" for ours, known in TYPE_NAMES.items())
    tables = " UNION ALL ".join(f"SELECT '{t}' AS table_name, column_type FROM (DESCRIBE SELECT * FROM {t})" for t in COUNTED)
    return f"SELECT table_name, CASE column_type {names} ELSE lower(column_type) END AS type, count(*) AS columns FROM ({tables}) GROUP BY ALL"


def j7_distribution(spark: SparkSession, sf: str) -> DataFrame:
    shares = {"A": 33.3, "N": 33.3, "R": 33.3}
    met = aggregate.class_shares(table(spark, sf, "lineitem"), "l_returnflag", shares, 3.0)
    return met.agg(F.count_if("met").alias("met"), F.count_if(~F.col("met")).alias("unmet"))


def k1_clustered_layout(spark: SparkSession, sf: str) -> DataFrame:
    path = layout.recluster(
        spark, f"{sf}/lineitem.parquet", new_scratch(spark, "k1"), "clustered", ["l_returnflag", "l_shipdate"], target_bytes=256 * 1024
    )
    stored = spark.read.parquet(path)
    # a flag's rows lie together: of the files, few hold more than one of its values
    mixed = stored.groupBy(F.input_file_name().alias("f")).agg(F.count_distinct("l_returnflag").alias("flags"))
    files, across = mixed.agg(F.count(F.lit(1)), F.count_if(F.col("flags") > 1)).first()
    return stored.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("l_orderkey").alias("last_order"),
        F.lit(files > 3).alias("several_files"),
        F.lit(across <= 2).alias("clustered"),
    )


CURVE = {"l_shipdate": "TIMESTAMP_NTZ'1997-06-15 00:00:00'", "l_partkey": "500", "l_suppkey": "40"}


def k1_curve_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Per clustering column: the rows a filter finds, and whether it reads under a third of the files."""
    source = f"{sf}/lineitem.parquet"
    path = layout.recluster_curve(spark, source, new_scratch(spark, "k1c"), "curved", list(CURVE), fs.size(spark, source) // 128)
    stored = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_name"))
    spans = stored.groupBy("file").agg(*(F.struct(F.min(c).alias("least"), F.max(c).alias("most")).alias(c) for c in CURVE))
    may_hold = {c: F.expr(f"{v} BETWEEN {c}.least AND {c}.most") for c, v in CURVE.items()}
    shares = spans.agg(*((F.count_if(hold) * 3 < F.count(F.lit(1))).alias(c) for c, hold in may_hold.items())).first()
    matches = stored.agg(*(F.count_if(F.expr(f"{c} = {v}")).alias(c) for c, v in CURVE.items()))
    columns = F.array(*(F.struct(F.lit(c).alias("filtered"), F.col(c).alias("rows"), F.lit(shares[c]).alias("under_a_third")) for c in CURVE))
    return matches.select(F.inline(columns))


def k2_small_files(spark: SparkSession, sf: str) -> DataFrame:
    """One file near the target and 32 small ones: only the small ones are rewritten, and only once."""
    folder = f"{new_scratch(spark, 'k2s')}/orders"
    orders = table(spark, sf, "orders")
    done = F.col("o_orderstatus") == "F"
    orders.filter(done).repartition(1).write.parquet(folder)
    target = sum(fs.list_files(spark, folder).values())
    orders.filter(~done | done.isNull()).repartition(32).write.mode("append").parquet(folder)
    first, second = (layout.compact_in_place(spark, folder, target) for _ in range(2))
    return spark.read.parquet(folder).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
        F.lit(first.kept).alias("kept"), F.lit(first.replaced).alias("replaced"), F.lit(second.replaced).alias("replaced_again"),
    )


def k2_compaction(spark: SparkSession, sf: str) -> DataFrame:
    root = new_scratch(spark, "k2")
    write_files(table(spark, sf, "orders"), f"{root}/small", files=32)
    stored = spark.read.parquet(layout.compact(spark, f"{root}/small", root, "compacted"))
    stored, files = stored.withColumn("file", F.input_file_name()), F.count_distinct("file")
    return stored.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"), (files < 32).alias("fewer_files")
    )


def k3_change_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Debtors left, builders got 100 more, suppliers joined."""
    old = table(spark, sf, "customer")
    builder = F.col("c_mktsegment") == "BUILDING"
    stayed = old.filter("c_acctbal >= 0").withColumn("c_acctbal", F.col("c_acctbal") + F.when(builder, 100.0).otherwise(0.0))
    joined = table(spark, sf, "supplier").select(
        (-F.col("s_suppkey") - 1).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"), F.lit(None).cast("string").alias("c_mktsegment"),
    )
    return changes.snapshot_changes(old, stayed.unionByName(joined), ["c_custkey"])


def _report_sql() -> str:
    parts = []
    for name, rule in LINE_RULES.items():
        rule = rule.replace("TIMESTAMP_NTZ", "TIMESTAMP")
        parts.append(f"""SELECT '{name}' AS rule, count(*) FILTER ({rule}) AS met,
            count(*) - count(*) FILTER ({rule}) AS unmet, count(*) FILTER (({rule}) IS NULL) AS unknown FROM lineitem""")
    return " UNION ALL ".join(parts)


def _drop_sql() -> str:
    rules = " AND ".join(f"({r})" for r in LINE_RULES.values()).replace("TIMESTAMP_NTZ", "TIMESTAMP")
    return f"SELECT l_orderkey, l_linenumber, l_partkey, l_discount, l_tax, l_shipdate FROM lineitem WHERE {rules}"


QUERIES: Registered = {
    "j1_expectations": (j1_expectations, _report_sql()),
    "j1_observed_expectations": (j1_observed_expectations, _report_sql()),
    "j2_drop_unmet": (j2_drop_unmet, _drop_sql()),
    "j2_drop_on_write": (j2_drop_on_write, _drop_sql()),
    "j3_key_check": (j3_key_check, """SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS distinct_keys,
        count(*) FILTER (o_orderkey > 0) AS positive_keys, count(DISTINCT o_orderkey) = count(*) AS is_unique,
        count(*) FILTER (o_orderkey > 0) = count(*) AS is_positive FROM orders"""),
    "j4_reference_check": (j4_reference_check, """SELECT count(DISTINCT doc_id) AS orphan_keys, count(*) AS orphan_rows FROM documents
        WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)"""),
    "j4_one_to_one": (j4_one_to_one, """WITH l AS (SELECT CASE WHEN doc_id % 10 <> 0 THEN doc_id END AS k FROM documents),
        r AS (SELECT CASE WHEN toxic = 0 THEN doc_id END AS k FROM labels),
        a AS (SELECT k, count(*) AS n FROM l WHERE k IS NOT NULL GROUP BY k),
        b AS (SELECT k, count(*) AS n FROM r WHERE k IS NOT NULL GROUP BY k)
        SELECT (SELECT count(*) FROM l WHERE k IS NULL) AS left_null_keys, (SELECT count(*) FROM r WHERE k IS NULL) AS right_null_keys, CAST(coalesce(sum(a.n), 0) AS BIGINT) AS left_rows, CAST(coalesce(sum(b.n), 0) AS BIGINT) AS right_rows,
          count(*) FILTER (a.n > 1 OR b.n > 1) AS repeated_keys, count(*) FILTER (b.n IS NULL) AS left_only_keys,
          count(*) FILTER (a.n IS NULL) AS right_only_keys FROM a FULL JOIN b ON a.k = b.k"""),
    "j5_domain_range_format": (j5_domain_range_format, r"""SELECT "check", violations, violations = 0 AS passed FROM (
        SELECT 'status_known' AS "check", count(*) FILTER (o_orderstatus NOT IN ('F','O')) AS violations FROM orders UNION ALL
        SELECT 'year_in_range', count(*) FILTER (year(o_orderdate) NOT BETWEEN 1996 AND 2000) FROM orders UNION ALL
        SELECT 'priority_format', count(*) FILTER (NOT regexp_full_match(o_orderpriority, '[1-5]-[A-Z ]+')) FROM orders UNION ALL
        SELECT 'amount_not_negative', count(*) FILTER (o_totalprice < 0) FROM orders)"""),
    "j6_schema_census": (j6_schema_census, _census_sql()),
    "j7_distribution": (j7_distribution, """SELECT count(*) FILTER (ok) AS met, count(*) FILTER (NOT ok) AS unmet FROM (
        SELECT abs(count(*) * 100 / (SELECT count(*) FROM lineitem) - 33.3) <= 3.0 AS ok FROM lineitem
        WHERE l_returnflag IN ('A','N','R') GROUP BY l_returnflag)"""),
    "k1_clustered_layout": (k1_clustered_layout, """SELECT l_returnflag, count(*) AS rows, max(l_orderkey) AS last_order,
        true AS several_files, true AS clustered FROM lineitem GROUP BY l_returnflag"""),
    "k2_compaction": (k2_compaction, """SELECT o_orderstatus, count(*) AS rows, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
        true AS fewer_files FROM orders GROUP BY o_orderstatus"""),
    "k1_curve_layout": (k1_curve_layout, " UNION ALL ".join(
        f"SELECT '{c}' AS filtered, count(*) FILTER ({c} = {v.replace('TIMESTAMP_NTZ', 'TIMESTAMP')}) AS rows, true AS under_a_third FROM lineitem" for c, v in CURVE.items())),
    "k2_small_files": (k2_small_files, """SELECT o_orderstatus, count(*) AS rows, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
        1 AS kept, 32 AS replaced, 0 AS replaced_again FROM orders GROUP BY o_orderstatus"""),
    "k3_change_feed": (k3_change_feed, """SELECT 'delete' AS change_type, * FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT 'update_pre', * FROM customer WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING'
        UNION ALL SELECT 'update_post', c_custkey, c_name, c_nationkey, c_acctbal + 100, c_mktsegment FROM customer
          WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING'
        UNION ALL SELECT 'insert', -s_suppkey - 1, s_name, s_nationkey, s_acctbal, NULL FROM supplier"""),
}
