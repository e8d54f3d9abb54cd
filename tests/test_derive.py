"""Derived columns and metrics on hand-computed rows."""

import pytest
from pyspark.sql import functions as F

from lakestrata.functions.derive import difference, fingerprint, percent_of, product, tiers, timestamp_of
from lakestrata.operators.aggregate import (
    Metric, class_shares, conditional_metrics, finish_metrics, frequency, merge_partials, next_key, partial_metrics, top_k,
)
from lakestrata.plans import bank


def column(df, name="out"):
    return [r[name] for r in df.orderBy("i").collect()]


@pytest.mark.parametrize("parts", [1, 5])
def test_risk_tier(spark, parts):
    rows = [
        (750, "LOW", "A", "RIESGO_BAJO"), (749, "LOW", "AAA", "SIN_CLASIFICAR"), (800, "LOW", "BBB", "SIN_CLASIFICAR"),
        (500, "MED", "D", "RIESGO_MEDIO"), (499, "MED", "A", "RIESGO_ALTO"), (900, "HIGH", "AAA", "RIESGO_ALTO"),
        (900, "HIG", "AAA", "SIN_CLASIFICAR"), (900, None, "AAA", "SIN_CLASIFICAR"), (None, "LOW", "AAA", "RIESGO_ALTO"),
        (None, None, None, "RIESGO_ALTO"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, s long, l string, g string, want string").repartition(parts)
    assert column(df.withColumn("out", bank.risk_tier("s", "l", "g"))) == [r[-1] for r in rows]


def test_balance_tier(spark):
    rows = [
        (100000.0, 50000.0, 150000.0, "PREMIUM"), (100000.0, 50000.0, 149999.99, "ESTANDAR"), (25000.0, 10000.0, None, "ESTANDAR"),
        (25000.0, 9999.99, 150000.0, "BASICO"), (0.01, None, None, "BASICO"), (0.0, 50000.0, 150000.0, "SIN_SALDO"),
        (None, None, None, "SIN_SALDO"), (-5.0, 50000.0, 150000.0, "SIN_SALDO"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a double, c double, t double, want string")
    assert column(df.withColumn("out", bank.balance_tier("a", "c", "t"))) == [r[-1] for r in rows]


def test_activity_tier(spark):
    rows = [
        (100, 3, 5, "MUY_ACTIVO"), (100, 3, 4, "ACTIVO"), (30, 2, None, "ACTIVO"), (100, 1, 9, "MODERADO"),
        (1, None, None, "MODERADO"), (0, 5, 9, "INACTIVO"), (None, None, None, "INACTIVO"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, n long, a long, r long, want string")
    assert column(df.withColumn("out", bank.activity_tier("n", "a", "r"))) == [r[-1] for r in rows]


def test_numeric_columns(spark):
    rows = [
        (200.0, 50.0, 10.0, 4.0, 2.0), (0.0, 50.0, 10.0, None, 2.0), (None, 50.0, None, 4.0, 2.0), (200.0, None, None, None, None),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a double, f double, t double, b double, r double")
    out = df.select("i", difference("a", "f").alias("n"), percent_of("f", "a").alias("p"), difference("t", "b").alias("c"), product("a", "r").alias("m"))
    assert [tuple(r)[1:] for r in out.orderBy("i").collect()] == [
        (150.0, 25.0, 6.0, 400.0), (-50.0, 0.0, 10.0, 0.0), (-50.0, 0.0, -4.0, 0.0), (200.0, 0.0, 0.0, 0.0),
    ]


def test_fingerprint(spark):
    row = spark.range(1, 2).select(fingerprint("id").alias("p"), fingerprint("id", "x").alias("s")).first()
    assert row["p"] == "6b86b273ff34fce19d6b804eff5a3f5747ada4eaa22f1d49c01e52ddb7875b4b"
    assert row["s"] != row["p"]


def test_tiers_needs_rules():
    with pytest.raises(ValueError):
        tiers([], "x")


ATM = [(1, "DATM", 10.0), (1, "DATM", None), (1, "CATM", 4.0), (1, "PGSL", 7.0), (1, "PGSL", 3.0), (2, "CMPR", 9.0)]
ATM_SCHEMA = "identificador_cliente long, tipo_transaccion string, monto_principal double"


@pytest.mark.parametrize("scale", [None, 2])
def test_conditional_metrics(spark, scale):
    out = bank.atm_metrics(spark.createDataFrame(ATM, ATM_SCHEMA), scale=scale)
    assert sorted(map(tuple, out.collect())) == [(1, 1, 1, 10.0, 4.0, 10.0), (2, 0, 0, 0.0, 0.0, 0.0)]
    assert [t for _, t in out.dtypes] == ["bigint", "bigint", "bigint", "double", "double", "double"]


@pytest.mark.parametrize("scale", [None, 2])
def test_partials_merge_to_the_whole(spark, scale):
    metrics = bank.atm_metrics_spec()
    args = ("identificador_cliente", "tipo_transaccion", "monto_principal", metrics, scale)
    parts = [partial_metrics(spark.createDataFrame([row], ATM_SCHEMA), *args) for row in ATM]
    union = parts[0]
    for part in parts[1:]:
        union = union.union(part)
    once = merge_partials(union, "identificador_cliente")
    twice = merge_partials(once.union(once.limit(0)), "identificador_cliente")
    assert once.schema["sum DATM"].dataType == parts[0].schema["sum DATM"].dataType == twice.schema["sum DATM"].dataType
    out = finish_metrics(twice, "identificador_cliente", metrics)
    assert sorted(map(tuple, out.collect())) == [(1, 1, 1, 10.0, 4.0, 10.0), (2, 0, 0, 0.0, 0.0, 0.0)]


def test_empty_input(spark):
    none = spark.createDataFrame([], ATM_SCHEMA)
    assert bank.atm_metrics(none).count() == 0
    assert frequency(none, "tipo_transaccion").count() == 0
    assert next_key(none, "identificador_cliente").first()["next_key"] == 1
    assert class_shares(none, "tipo_transaccion", {"DATM": 10.0}, 1.0).first()["share"] == 0.0


def test_top_k_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 5), (4, 5), (5, None)], "k int, v int").repartition(4)
    assert [r["k"] for r in top_k(df, "v", 3, ["k"]).collect()] == [2, 1, 3]
    with pytest.raises(ValueError):
        top_k(df, "v", 0, ["k"])


def test_metric_kind_checked():
    with pytest.raises(ValueError):
        Metric("x", "median", "A")


MASTER = "CUSTID long, CUSNM string, CUSLN string, CUSDB date, CUSCT string, CUSCN string, CUSNA string, CUSOC string, CUSED string, " \
    "CUSRK string, CUSCR string, CUSAC2 long, CUSTX long, CUSSC long, CUSLR long, FechaIngestaDatos timestamp"
BALANCE = "CUSTID long, BLACT string, BLST string, BLAV double, BLTB double, BLCR double, BLOD date, FechaIngestaDatos timestamp"


def master_rows(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "CUSTID long")
    names = [f.split() for f in MASTER.split(", ")[1:]]
    return df.select("CUSTID", *(F.lit(None).cast(t).alias(n) for n, t in names))


def test_bank_views_on_edge_cases(spark):
    stamp = F.lit("2026-01-01").cast("timestamp")
    masters = master_rows(spark, [1, 2, 2]).withColumn("FechaIngestaDatos", stamp).withColumn("año", F.lit(2026))
    balances = spark.createDataFrame([(1, "AHRO", "A", 30000.0, 1.0, 20000.0, None), (9, "AHRO", "A", 1.0, 1.0, 1.0, None)],
                                     BALANCE.rsplit(",", 1)[0]).withColumn("FechaIngestaDatos", stamp)
    view = bank.customer_view(masters, balances, newest_by=["FechaIngestaDatos"])
    rows = {r["identificador_cliente"]: r for r in view.collect()}
    assert set(rows) == {1, 2}  # balance 9 has no master
    assert rows[1]["categoria_saldo_disponible"] == "ESTANDAR"
    assert rows[2]["categoria_saldo_disponible"] == "SIN_SALDO" and rows[2]["saldo_disponible"] is None
    assert view.columns[:2] == list(bank.CUSTOMER_CLUSTER)
    assert not {"año", "FechaIngestaDatos"} & set(view.columns)

    # only customers with transactions are in the profile
    metrics = bank.atm_metrics(spark.createDataFrame([(1, "DATM", 10.0), (7, "DATM", 1.0)], ATM_SCHEMA))
    out = bank.customer_profile(view, metrics)
    assert [r["identificador_cliente"] for r in out.collect()] == [1]
    assert len(out.columns) == 22

    empty = bank.customer_view(masters.limit(0), balances.limit(0), newest_by=["FechaIngestaDatos"])
    assert empty.count() == 0 and empty.columns == view.columns
    assert bank.customer_profile(empty, metrics).count() == 0


def test_bank_wider_mapping_is_carried(spark):
    stamp = F.lit("2026-01-01").cast("timestamp")
    masters = master_rows(spark, [1]).withColumns({"FechaIngestaDatos": stamp, "CUSSX": F.lit("F")})
    balances = spark.createDataFrame([], BALANCE)
    names = {**bank.CUSTOMER_NAMES, "CUSSX": "sexo_cliente", "CUSXX": "nunca_presente"}
    view = bank.customer_view(masters, balances, customer_names=names, newest_by=["FechaIngestaDatos"])
    assert view.first()["sexo_cliente"] == "F" and "nunca_presente" not in view.columns


def test_timestamp_of_date_and_time_text(spark):
    rows = [("2024-02-29", "23:59:58"), ("2023-02-29", "10:00:00"), ("2024-01-01", "24:00:00"), (None, "10:00:00"), ("2024-01-01", None), ("", "")]
    df = spark.createDataFrame(rows, "d string, t string").select(timestamp_of("d", "t").cast("string").alias("at"))
    assert [r["at"] for r in df.collect()] == ["2024-02-29 23:59:58", None, None, None, None, None]
