"""Ingest, scans, sinks, settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators.aggregate import row_count
from lakestrata.plans.queries import Registered, table
from lakestrata.session import new_scratch
from lakestrata.sources import fs, ingest, settings, tables
from lakestrata.streaming.append import append_refresh, read_appended

EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
SECOND, THIRD = "2024-01-11", "2024-01-21"


@dataclass(frozen=True)
class Landing:
    """A landing folder and the table it is taken into, all in one fresh scratch folder."""

    spark: SparkSession
    root: str

    @classmethod
    def new(cls, spark: SparkSession, label: str) -> Landing:
        return cls(spark, new_scratch(spark, label))

    @property
    def source(self) -> str:
        return f"{self.root}/landing"

    def drop(self, df: DataFrame, *folders: str) -> None:
        """Deliver more files, into ``key=value`` folders when columns are named."""
        if folders:
            # one shuffle gathers each folder's rows, and splits folders too large for one file
            df.hint("rebalance", *folders).write.mode("append").partitionBy(*folders).parquet(self.source)
        else:
            df.write.mode("append").parquet(self.source)

    def take(self, **options) -> None:
        ingest.ingest_files(
            self.spark, self.source, f"{self.root}/table", f"{self.root}/checkpoint", f"{self.root}/schema", **options
        )

    def read(self) -> DataFrame:
        return ingest.read_ingested(self.spark, f"{self.root}/table", f"{self.root}/schema")

    def stream(self) -> DataFrame:
        return ingest.stream_ingested(self.spark, f"{self.root}/table", f"{self.root}/schema")


def _span(df: DataFrame, first: str | None, last: str | None) -> DataFrame:
    if first:
        df = df.filter(F.col("ts") >= F.lit(first).cast("timestamp_ntz"))
    if last:
        df = df.filter(F.col("ts") < F.lit(last).cast("timestamp_ntz"))
    return df


def deliveries(spark: SparkSession, sf: str) -> list[DataFrame]:
    """All events, in three deliveries by date."""
    events = table(spark, sf, "events")
    return [_span(events, None, SECOND), _span(events, SECOND, THIRD), _span(events, THIRD, None)]


def a1_incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    landing = Landing.new(spark, "a1")
    for delivery in deliveries(spark, sf):
        landing.drop(delivery)
        landing.take()
    return landing.read().select(*EVENT_COLUMNS)


def a1_archived_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The same three deliveries; each leaves the landing folder once it is taken."""
    landing = Landing.new(spark, "a1a")
    for delivery in deliveries(spark, sf):
        landing.drop(delivery)
        for _ in range(2):
            ingest.ingest_and_archive(spark, landing.source, f"{landing.root}/table", f"{landing.root}/archive", f"{landing.root}/schema")
    left = sum(n.endswith(".parquet") for n in fs.list_files(spark, landing.source))
    return landing.read().select(*EVENT_COLUMNS, F.lit(left).cast("long").alias("files_left"))


def a2_schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """``props`` appears with the second delivery, ``value`` vanishes with the third."""
    landing = Landing.new(spark, "a2")
    first, second, third = deliveries(spark, sf)
    for delivery in (first.drop("props"), second, third.drop("value")):
        landing.drop(delivery)
        landing.take()
    return landing.read().select(*EVENT_COLUMNS)


def a3_rescued_values(spark: SparkSession, sf: str) -> DataFrame:
    """The second delivery has ``value`` as text, with errors that are no numbers."""
    landing = Landing.new(spark, "a3")
    first, second, third = deliveries(spark, sf)
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    landing.drop(first)
    landing.take()
    landing.drop(second.withColumn("value", text))
    landing.drop(third)
    landing.take()
    return landing.read().select(*EVENT_COLUMNS, F.col(ingest.RESCUED).alias("rescued"))


def a4_folder_keys(spark: SparkSession, sf: str) -> DataFrame:
    landing = Landing.new(spark, "a4")
    parts = {"year": F.year("ts"), "month": F.month("ts"), "day": F.dayofmonth("ts")}
    for delivery in deliveries(spark, sf):
        landing.drop(delivery.withColumns(parts), *parts)
        landing.take()
    return landing.read().select(*EVENT_COLUMNS, *parts)


def _name(spark: SparkSession, label: str) -> str:
    """A catalog table name nobody else uses."""
    return f"{label}_{new_scratch(spark, label).rsplit('-', 1)[-1]}"


def a5_table_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A table by its three-part name; the files stay where they are."""
    name = f"spark_catalog.default.{_name(spark, 'orders')}"
    spark.catalog.createTable(name, path=f"{sf}/orders.parquet", source="parquet")
    scanned = tables.scan_table(spark, name).select("o_orderkey", "o_custkey", "o_totalprice")
    spark.sql(f"DROP TABLE {name}")
    return scanned


def a6_parquet_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The parent of many day folders."""
    landing = Landing.new(spark, "a6")
    landing.drop(table(spark, sf, "events").withColumn("day", F.dayofmonth("ts")), "day")
    return tables.scan_parquet(spark, landing.source).select(*EVENT_COLUMNS)


def a7_sql_over_files(spark: SparkSession, sf: str) -> DataFrame:
    return tables.sql_over_files(
        spark, "l_returnflag, l_linestatus, COUNT(*) AS rows", f"{sf}/lineitem.parquet", "GROUP BY l_returnflag, l_linestatus"
    )


def a8_append_sink(spark: SparkSession, sf: str) -> DataFrame:
    landing = Landing.new(spark, "a8")
    for delivery in deliveries(spark, sf):
        landing.drop(delivery)
        stream = spark.readStream.schema(delivery.schema).parquet(landing.source)
        append_refresh(stream, lambda df: df, f"{landing.root}/table", f"{landing.root}/checkpoint")
    return read_appended(spark, f"{landing.root}/table", delivery.schema)


def a9_full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    root = new_scratch(spark, "a9")
    customers = table(spark, sf, "customer")
    tables.full_refresh(customers.filter("c_acctbal < 0"), root)
    tables.full_refresh(customers, root)
    # the new content may come from the old
    tables.full_refresh(tables.current_version(spark, root).filter("c_acctbal >= 0"), root)
    return tables.current_version(spark, root)


def a9_catalog_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog table, refreshed from itself under its name, then by a job that fails."""
    root, name = new_scratch(spark, "a9c"), _name(spark, "refreshed")
    tables.refresh_table(table(spark, sf, "customer"), name, root)
    tables.refresh_table(spark.table(name).filter("c_acctbal >= 0").withColumn("times", F.lit(2)), name, root)
    try:
        tables.refresh_table(spark.table(name).withColumn("times", F.raise_error(F.lit("cut short")).cast("int")), name, root)
    except PySparkException:
        pass
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


def a10_exactly_once(spark: SparkSession, sf: str) -> DataFrame:
    landing = Landing.new(spark, "a10")
    landing.drop(table(spark, sf, "events"))
    landing.take()
    before = row_count(landing.read(), "rows_first_run").collect()[0][0]
    landing.take()
    return landing.read().agg(
        F.lit(before).cast("long").alias("rows_first_run"),
        F.count(F.lit(1)).alias("rows_second_run"),
        F.count_distinct("event_id").alias("distinct_events"),
    )


def a11_overwrite_files(spark: SparkSession, sf: str) -> DataFrame:
    path = new_scratch(spark, "a11")
    orders = table(spark, sf, "orders")
    tables.write_files(orders.filter("o_orderstatus = 'F'"), path, files=2)
    tables.write_files(orders, path, files=4)
    stored = spark.read.parquet(path)
    files = stored.select(F.col("_metadata.file_name").alias("file")).agg(F.count_distinct("file")).collect()[0][0]
    return stored.withColumn("files", F.lit(files).cast("long"))


def a12_written_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.write_files(table(spark, sf, "lineitem"), new_scratch(spark, "a12"), files=4)
    return spark.createDataFrame([("lineitem", rows)], "table_name string, rows long")


def _segment_settings(spark: SparkSession, sf: str) -> dict[str, str]:
    counts = table(spark, sf, "customer").groupBy("c_mktsegment").count()
    return {f"segment.{row['c_mktsegment']}": str(row["count"]) for row in counts.collect()}


def a13_settings_lookup(spark: SparkSession, sf: str) -> DataFrame:
    name = _name(spark, "settings")
    settings.replace_settings(spark, name, _segment_settings(spark, sf))
    found = settings.load_settings(spark, name)
    assert settings.load_settings(spark, name, ("segment.BUILDING",)).items() <= found.items()
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(sorted(found.items()), "key string, value string")


def a14_settings_replace(spark: SparkSession, sf: str) -> DataFrame:
    name = _name(spark, "settings")
    settings.replace_settings(spark, name, {"segment.NONE": "it's gone after the next"})
    settings.replace_settings(spark, name, _segment_settings(spark, sf))
    rows = settings.load_settings(spark, name)
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(sorted(rows.items()), "key string, value string")


def a15_insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers in debt are known; all suppliers are offered, twice."""
    name = _name(spark, "known")
    suppliers = table(spark, sf, "supplier").withColumnRenamed("s_name", "key")
    known = suppliers.filter("s_acctbal < 0").select("key", F.lit("in debt").alias("value"))
    known.write.format("parquet").saveAsTable(name)
    offered = suppliers.select("key", F.lit("new").alias("value"))
    settings.insert_missing(spark, name, offered)
    settings.insert_missing(spark, name, offered)
    path = new_scratch(spark, "a15")
    spark.table(name).write.parquet(path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
_SETTINGS = "SELECT 'segment.' || c_mktsegment AS key, CAST(count(*) AS VARCHAR) AS value FROM customer GROUP BY c_mktsegment"
QUERIES: Registered = {
    "a1_incremental_ingest": (a1_incremental_ingest, _EVENTS),
    "a1_archived_ingest": (a1_archived_ingest, "SELECT event_id, ts, user_id, event_type, value, props, CAST(0 AS BIGINT) AS files_left FROM events"),
    "a2_schema_evolution": (a2_schema_evolution, f"""SELECT event_id, ts, user_id, event_type,
        CASE WHEN ts < TIMESTAMP '{THIRD}' THEN value END AS value,
        CASE WHEN ts >= TIMESTAMP '{SECOND}' THEN props END AS props FROM events"""),
    "a3_rescued_values": (a3_rescued_values, f"""SELECT event_id, ts, user_id, event_type, props,
        CASE WHEN NOT lost THEN value END AS value, CASE WHEN lost THEN '{{"value":"n/a"}}' END AS rescued FROM (
        SELECT *, ts >= TIMESTAMP '{SECOND}' AND ts < TIMESTAMP '{THIRD}' AND event_type = 'error' AS lost FROM events)"""),
    "a4_folder_keys": (a4_folder_keys, """SELECT *, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
        CAST(day(ts) AS INTEGER) AS day FROM events"""),
    "a5_table_scan": (a5_table_scan, "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"),
    "a6_parquet_scan": (a6_parquet_scan, _EVENTS),
    "a7_sql_over_files": (a7_sql_over_files, "SELECT l_returnflag, l_linestatus, count(*) AS rows FROM lineitem GROUP BY l_returnflag, l_linestatus"),
    "a8_append_sink": (a8_append_sink, _EVENTS),
    "a9_full_refresh": (a9_full_refresh, "SELECT * FROM customer WHERE c_acctbal >= 0"),
    "a9_catalog_refresh": (a9_catalog_refresh, "SELECT *, 2 AS times FROM customer WHERE c_acctbal >= 0"),
    "a10_exactly_once": (a10_exactly_once, """SELECT count(*) AS rows_first_run, count(*) AS rows_second_run,
        count(DISTINCT event_id) AS distinct_events FROM events"""),
    "a11_overwrite_files": (a11_overwrite_files, "SELECT *, CAST(4 AS BIGINT) AS files FROM orders"),
    "a12_written_rows": (a12_written_rows, "SELECT 'lineitem' AS table_name, count(*) AS rows FROM lineitem"),
    "a13_settings_lookup": (a13_settings_lookup, _SETTINGS),
    "a14_settings_replace": (a14_settings_replace, _SETTINGS),
    "a15_insert_if_absent": (a15_insert_if_absent, """SELECT s_name AS key,
        CASE WHEN s_acctbal < 0 THEN 'in debt' ELSE 'new' END AS value FROM supplier"""),
}
