"""The bank model, with customers as master, orders as balances and order lines as transactions."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.derive import padded
from lakestrata.functions.draws import below, date_in, pick
from lakestrata.operators import quality
from lakestrata.plans import bank
from lakestrata.plans.bank_flow import BankTables
from lakestrata.plans.profile import latest_orders
from lakestrata.plans.queries import Registered, table
from lakestrata.plans.queries.synth import _draw, _pick
from lakestrata.session import new_scratch

LEVELS = {"AUTOMOBILE": "LOW", "BUILDING": "MED", "FURNITURE": "HIGH", "HOUSEHOLD": "HIG"}
GRADES = ("A", "AA", "AAA", "B")
TYPES = {"A": "DATM", "N": "CATM", "R": "PGSL"}


def _recode(column: str, codes: dict[str, str]) -> Column:
    """The code of each value, NULL for a value without one."""
    return F.create_map(*(F.lit(x) for pair in codes.items() for x in pair))[F.col(column)]


def master(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("CUSTID"),
        F.col("c_name").alias("CUSNM"),
        F.col("c_mktsegment").alias("CUSLN"),
        date_in(date(1970, 1, 1), date(2015, 1, 1), "birth", "c_custkey").alias("CUSDB"),
        F.lit("city").alias("CUSCT"),
        F.lit("country").alias("CUSCN"),
        F.col("c_nationkey").cast("string").alias("CUSNA"),
        F.lit("work").alias("CUSOC"),
        F.lit("school").alias("CUSED"),
        _recode("c_mktsegment", LEVELS).alias("CUSRK"),
        pick(GRADES, "grade", "c_custkey").alias("CUSCR"),
        below(5, "accounts", "c_custkey").alias("CUSAC2"),
        below(200, "transactions", "c_custkey").alias("CUSTX"),
        F.floor(F.col("c_acctbal") / 8).alias("CUSSC"),
        below(10, "rank", "c_custkey").alias("CUSLR"),
        F.lit("1").alias("ingest_ts"),
        F.lit("1").alias("source_time"),
        F.lit("1").alias("source_file"),
        F.lit(0).cast("long").alias("source_row"),
        F.lit(None).cast("string").alias("_rescued_data"),
    )


def balances(spark: SparkSession, sf: str) -> DataFrame:
    """Every order redelivers its customer's balance; the newest counts."""
    return balance_rows(table(spark, sf, "orders"))


def balance_rows(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_custkey").alias("CUSTID"),
        F.col("o_orderpriority").alias("BLACT"),
        F.col("o_orderstatus").alias("BLST"),
        (F.col("o_totalprice") / 4).alias("BLAV"),
        F.col("o_totalprice").alias("BLTB"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 8).alias("BLCR"),
        F.col("o_orderdate").cast("date").alias("BLOD"),
        F.col("o_orderdate").alias("ingest_ts"),
        F.lit("1").alias("source_time"),
        F.lit("1").alias("source_file"),
        F.col("o_orderkey").alias("source_row"),
    )


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    joined = lines.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    return joined.select(
        F.concat(_recode("l_returnflag", TYPES), padded("l_orderkey", 8)).alias("TRXID"),
        F.col("o_custkey").alias("CUSTID"),
        _recode("l_returnflag", TYPES).alias("TRXTYP"),
        F.when(F.col("l_linestatus") == "F", F.lit("USD")).alias("TRXCUR"),
        F.when(F.col("l_tax") != 0, F.col("l_extendedprice")).alias("TRXAMT"),
        (F.col("l_quantity") * 2).alias("TRXCM"),
        F.col("l_quantity").alias("TRXBA"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("TRXBP"),
        F.col("l_tax").alias("TRXRK"),
        (F.col("l_extendedprice") - 20000).alias("TRXNT"),
        F.col("l_shipdate").cast("date").alias("TRXDT"),
    )


def silver_customers(spark: SparkSession, sf: str) -> DataFrame:
    return bank.customer_view(master(spark, sf), balances(spark, sf))


def silver_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return bank.transaction_view(transactions(spark, sf))


def gold_activity(spark: SparkSession, sf: str) -> DataFrame:
    return bank.atm_metrics(silver_transactions(spark, sf), scale=2)


def gold_profile(spark: SparkSession, sf: str) -> DataFrame:
    return bank.customer_profile(silver_customers(spark, sf), gold_activity(spark, sf))


def silver_customer_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.expectation_report(silver_customers(spark, sf), bank.CUSTOMER_RULES)


def silver_transaction_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.expectation_report(silver_transactions(spark, sf), bank.TRANSACTION_RULES)


def two_day_tables(spark: SparkSession, sf: str) -> BankTables:
    """Two days of files, each followed by an update.

    Day one has outdated names, and balances and transactions up to a date; day two has the rest.
    """
    landing = new_scratch(spark, "bank")
    orders = table(spark, sf, "orders")
    early = F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    moved = transactions(spark, sf)
    before = F.col("TRXDT") < F.lit("1999-01-01").cast("date")
    people = master(spark, sf).drop("ingest_ts", "source_time", "source_file", "source_row", "_rescued_data")
    folders = {s: f"{landing}/{s}" for s in ("customers", "balances", "transactions")}
    kept = BankTables(spark, folders, f"{landing}/tables", buckets=8, scale=2)
    days = [
        (people.withColumn("CUSNM", F.lit("outdated")), orders.filter(early), moved.filter(before)),
        (people, orders.filter(~early), moved.filter(~before)),
    ]
    for number, (customers, redelivered, transacted) in enumerate(days, 1):
        newest = balance_rows(latest_orders(redelivered)).drop("ingest_ts", "source_time", "source_file", "source_row")
        landed = {"customers": customers, "balances": newest, "transactions": transacted}
        with ThreadPoolExecutor(len(landed)) as pool:
            list(pool.map(lambda name: landed[name].write.parquet(f"{folders[name]}/año=2026/mes=1/dia={number}"), landed))
        kept.update()
    return kept


def two_day_expectations(spark: SparkSession, sf: str) -> DataFrame:
    """What each of the two updates counted while it wrote: its changed customers, its new transactions."""
    return two_day_tables(spark, sf).expectation_history()


def two_day_profile(spark: SparkSession, sf: str) -> DataFrame:
    return two_day_tables(spark, sf).profile()


def _case(column: str, codes: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in codes.items()) + " END"


_CUSTOMERS = f"""
SELECT sha256(CAST(identificador_cliente AS VARCHAR)) AS huella_identificacion_cliente, v.*,
  CASE WHEN coalesce(score_cliente, 0) >= 750 AND nivel_riesgo IN ('L','LOW') AND calificacion_crediticia IN ('A','AA','AAA')
         THEN 'RIESGO_BAJO'
       WHEN coalesce(score_cliente, 0) >= 500 AND nivel_riesgo IN ('M','MED') THEN 'RIESGO_MEDIO'
       WHEN coalesce(score_cliente, 0) < 500 OR nivel_riesgo IN ('H','HIGH') THEN 'RIESGO_ALTO'
       ELSE 'SIN_CLASIFICAR' END AS clasificacion_riesgo_cliente,
  CASE WHEN coalesce(saldo_disponible, 0) >= 100000 AND coalesce(limite_credito, 0) >= 50000 AND coalesce(saldo_total, 0) >= 150000
         THEN 'PREMIUM'
       WHEN coalesce(saldo_disponible, 0) >= 25000 AND coalesce(limite_credito, 0) >= 10000 THEN 'ESTANDAR'
       WHEN coalesce(saldo_disponible, 0) > 0 THEN 'BASICO' ELSE 'SIN_SALDO' END AS categoria_saldo_disponible,
  CASE WHEN coalesce(cantidad_transacciones, 0) >= 100 AND coalesce(cantidad_cuentas, 0) >= 3 AND coalesce(ranking_prestamos, 0) >= 5
         THEN 'MUY_ACTIVO'
       WHEN coalesce(cantidad_transacciones, 0) >= 30 AND coalesce(cantidad_cuentas, 0) >= 2 THEN 'ACTIVO'
       WHEN coalesce(cantidad_transacciones, 0) >= 1 THEN 'MODERADO' ELSE 'INACTIVO' END AS perfil_actividad_bancaria
FROM (SELECT c_custkey AS identificador_cliente, c_name AS nombre_cliente, c_mktsegment AS apellido_cliente,
    DATE '1970-01-01' + CAST({_draw('birth', 'c_custkey')} % (DATE '2015-01-01' - DATE '1970-01-01') AS INTEGER) AS fecha_nacimiento,
    'city' AS ciudad_residencia, 'country' AS pais_residencia, CAST(c_nationkey AS VARCHAR) AS nacionalidad_cliente,
    'work' AS ocupacion_cliente, 'school' AS nivel_educativo, {_case('c_mktsegment', LEVELS)} AS nivel_riesgo,
    {_pick(GRADES, 'grade', 'c_custkey')} AS calificacion_crediticia, {_draw('accounts', 'c_custkey')} % 5 AS cantidad_cuentas,
    {_draw('transactions', 'c_custkey')} % 200 AS cantidad_transacciones, CAST(floor(c_acctbal / 8) AS BIGINT) AS score_cliente,
    {_draw('rank', 'c_custkey')} % 10 AS ranking_prestamos, o_orderpriority AS tipo_cuenta, o_orderstatus AS estado_cuenta,
    o_totalprice / 4 AS saldo_disponible, o_totalprice AS saldo_total,
    CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 8 END AS limite_credito, CAST(o_orderdate AS DATE) AS fecha_apertura_cuenta
  FROM customer LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) o ON c_custkey = o_custkey AND rn = 1) v
"""
_TRANSACTIONS = f"""
SELECT *, coalesce(monto_principal, 0) - coalesce(comision_transaccion, 0) AS monto_neto_comisiones,
  CASE WHEN monto_principal <> 0 AND monto_principal IS NOT NULL THEN coalesce(comision_transaccion, 0) / monto_principal * 100
       ELSE 0.0 END AS porcentaje_comision_sobre_monto,
  coalesce(saldo_posterior, 0) - coalesce(saldo_anterior, 0) AS variacion_saldo_transaccion,
  coalesce(monto_principal, 0) * coalesce(riesgo_transaccion, 0) AS indicador_impacto_financiero
FROM (SELECT {_case('l_returnflag', TYPES)} || lpad(CAST(l_orderkey AS VARCHAR), greatest(8, length(CAST(l_orderkey AS VARCHAR)))::INT, '0') AS identificador_transaccion,
    o_custkey AS identificador_cliente, {_case('l_returnflag', TYPES)} AS tipo_transaccion,
    CASE WHEN l_linestatus = 'F' THEN 'USD' END AS moneda_transaccion, CASE WHEN l_tax <> 0 THEN l_extendedprice END AS monto_principal,
    l_quantity * 2 AS comision_transaccion, l_quantity AS saldo_posterior, nullif(l_discount, 0) AS saldo_anterior,
    l_tax AS riesgo_transaccion, l_extendedprice - 20000 AS monto_neto, CAST(l_shipdate AS DATE) AS fecha_transaccion
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


def _metric(kind: str, code: str) -> str:
    chosen = f"CASE WHEN tipo_transaccion = '{code}' THEN monto_principal END"
    total = f"CAST(sum(CAST({chosen} AS DECIMAL(18,2))) AS DOUBLE)"
    if kind == "count":
        return f"count({chosen})"
    return f"coalesce({total}, 0.0)" if kind == "sum" else f"coalesce({total} / nullif(count({chosen}), 0), 0.0)"


_ACTIVITY = f"""SELECT identificador_cliente, {_metric('count', 'DATM')} AS cantidad_depositos_atm,
  {_metric('count', 'CATM')} AS cantidad_retiros_atm, {_metric('avg', 'DATM')} AS promedio_monto_depositos_atm,
  {_metric('avg', 'CATM')} AS promedio_monto_retiros_atm, {_metric('sum', 'PGSL')} AS total_pagos_saldo_cliente
FROM ({_TRANSACTIONS}) GROUP BY identificador_cliente"""
_PROFILE = f"""SELECT {', '.join('c.' + n for n in bank.PROFILE_CUSTOMER_COLUMNS)}, a.cantidad_depositos_atm, a.cantidad_retiros_atm,
  a.promedio_monto_depositos_atm, a.promedio_monto_retiros_atm, a.total_pagos_saldo_cliente
FROM ({_CUSTOMERS}) c JOIN ({_ACTIVITY}) a ON c.identificador_cliente = a.identificador_cliente"""


def _rules(view: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS rule, count(*) FILTER ({rule}) AS met, count(*) - count(*) FILTER ({rule}) AS unmet,
        count(*) FILTER (({rule}) IS NULL) AS unknown FROM ({view})"""
        for name, rule in rules.items()
    )


def _run_rules(run: int, name: str, view: str, rules: dict[str, str]) -> str:
    return f"SELECT CAST({run} AS BIGINT) AS run, '{name}' AS table_name, * FROM ({_rules(view, rules)})"


_EARLY = "FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'"
_DAY = "SELECT * FROM ({0}) WHERE fecha_transaccion {1} DATE '1999-01-01'"
_TWO_DAYS = " UNION ALL ".join(
    (
        _run_rules(0, "customers", _CUSTOMERS.replace("FROM orders", _EARLY), bank.CUSTOMER_RULES),
        _run_rules(1, "customers", _CUSTOMERS, bank.CUSTOMER_RULES),
        _run_rules(0, "transactions", _DAY.format(_TRANSACTIONS, "<"), bank.TRANSACTION_RULES),
        _run_rules(1, "transactions", _DAY.format(_TRANSACTIONS, ">="), bank.TRANSACTION_RULES),
    )
)

QUERIES: Registered = {
    "bank_silver_customers": (silver_customers, _CUSTOMERS),
    "bank_silver_transactions": (silver_transactions, _TRANSACTIONS),
    "bank_gold_activity": (gold_activity, _ACTIVITY),
    "bank_gold_profile": (gold_profile, _PROFILE),
    "bank_two_day_update": (two_day_profile, _PROFILE),
    "j1_two_day_expectations": (two_day_expectations, _TWO_DAYS),
    "bank_customer_expectations": (silver_customer_rules, _rules(_CUSTOMERS, bank.CUSTOMER_RULES)),
    "bank_transaction_expectations": (silver_transaction_rules, _rules(_TRANSACTIONS, bank.TRANSACTION_RULES)),
}
