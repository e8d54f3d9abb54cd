"""Seeded bank files keep the invariants of the source, and the flow runs on them."""

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import quality
from lakestrata.operators.aggregate import class_shares
from lakestrata.operators.changes import snapshot_changes
from lakestrata.plans import bank, bank_data
from lakestrata.plans.bank_flow import BankTables

N = 3000


@pytest.fixture(scope="module")
def master(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('bank')}/customers"
    bank_data.customers(spark, N).write.parquet(path)
    return spark.read.parquet(path)


def test_master(master):
    assert tuple(quality.key_check(master, "CUSTID").first()) == (N, N, N, True, True)
    checks = {
        "birth": F.year("CUSDB").between(1970, 2007),
        "risk": F.col("CUSRK").isin(*bank_data.RISK_LEVELS),
        "score": F.col("CUSSC").between(300, 1149),
        "mail": quality.has_format("CUSEM", "[a-z]+[.][a-z]+@mail[.]com"),
    }
    assert quality.violations(master, checks).filter("NOT passed").count() == 0


def test_balances_are_one_to_one(master):
    out = bank_data.balances(master)
    check = quality.one_to_one_check(master, out, "CUSTID", "CUSTID").first()
    assert tuple(check) == (0, 0, N, N, 0, 0, 0)
    seq = out.agg(F.min("BLSQ"), F.max("BLSQ"), F.count_distinct("BLSQ")).first()
    assert tuple(seq) == (1, N, N)
    shares = class_shares(out, "BLACT", {k: float(w) for k, w in bank.ACCOUNT_TYPE_WEIGHTS}, 3.0)
    assert shares.filter("NOT met").count() == 0


def test_transactions(master):
    out = bank_data.transactions(master, 3 * N, "2026-01-31")
    assert tuple(quality.reference_check(out, master, "CUSTID", "CUSTID").first()) == (0, 0)
    assert out.filter(~quality.has_format("TRXID", "[A-Z]{4}[0-9]{8}")).count() == 0
    shares = class_shares(out, "TRXTYP", {k: float(w) for k, w in bank.TRANSACTION_TYPE_WEIGHTS}, 3.0)
    assert shares.filter("NOT met").count() == 0
    assert out.filter(F.abs(F.col("TRXNT") - (F.col("TRXAMT") - F.col("TRXCM") - F.col("TRXIM"))) > 1e-9).count() == 0


def test_next_day(master):
    after = bank_data.next_customers(master, "day2")
    assert after.columns == master.columns
    changes = {r["change_type"]: r["count"] for r in snapshot_changes(master, after, ["CUSTID"]).groupBy("change_type").count().collect()}
    assert changes["insert"] == int(N * 0.006)
    # a few of the chosen draw the values they had
    assert 0.97 * N * 0.2 < changes["update_post"] == changes["update_pre"] <= N * 0.2 and "delete" not in changes
    composed = F.concat(F.lower("CUSNM"), F.lit("."), F.lower("CUSLN"), F.lit("@mail.com"))
    assert after.filter(F.col("CUSEM") != composed).count() == 0


def test_bad_arguments(spark, master):
    for bad in (
        lambda: bank_data.customers(spark, 0),
        lambda: bank_data.customers(spark, 1, " "),
        lambda: bank_data.next_customers(master, "s", share=1.5),
        lambda: bank_data.balances(master, low=5, high=5),
        lambda: bank_data.transactions(master, 10, "31-01-2026"),
    ):
        with pytest.raises(ValueError):
            bad()


def test_flow_over_two_days(spark, master, tmp_path):
    landing = {s: f"{tmp_path}/landing/{s}" for s in ("customers", "balances", "transactions")}
    kept = BankTables(spark, landing, f"{tmp_path}/tables", buckets=4)
    today = master
    for day in ("2026-01-01", "2026-01-02"):
        folder = f"año=2026/mes=1/dia={int(day[-2:])}"
        if day.endswith("02"):
            today = bank_data.next_customers(master, day)
        today.write.parquet(f"{landing['customers']}/{folder}")
        bank_data.balances(today, day).write.parquet(f"{landing['balances']}/{folder}")
        bank_data.transactions(today, N, day).write.parquet(f"{landing['transactions']}/{folder}")
        kept.update()
    counts = {r["table_name"]: r["rows"] for r in kept.counts().collect()}
    people = N + int(N * 0.006)
    assert counts["bronze.customers"] == counts["bronze.balances"] == N + people
    assert counts["silver.customers"] == people
    assert counts["silver.transactions"] == 2 * N
    names = kept.customers().select(F.col("identificador_cliente").alias("CUSTID"), F.col("nombre_cliente").alias("CUSNM"))
    assert snapshot_changes(names, today.select("CUSTID", "CUSNM"), ["CUSTID"]).count() == 0
    rules = {r["rule"]: r for r in kept.expectations().filter("rule LIKE '%positivo'").collect()}
    assert rules["limite_credito_positivo"]["unmet"] == 0 and rules["monto_neto_positivo"]["unmet"] > 0


def test_flow_over_files_without_rows(spark, master, tmp_path):
    landing = {s: f"{tmp_path}/landing/{s}" for s in ("customers", "balances", "transactions")}
    kept = BankTables(spark, landing, f"{tmp_path}/tables", buckets=2)
    frames = {
        "customers": master,
        "balances": bank_data.balances(master),
        "transactions": bank_data.transactions(master, 10, "2026-01-01"),
    }
    for name, df in frames.items():
        df.limit(0).write.parquet(f"{landing[name]}/dia=1")
    kept.update()
    assert {r["rows"] for r in kept.counts().collect()} == {0}
    assert len(kept.profile().columns) == 22
    assert kept.customers().columns[:2] == list(bank.CUSTOMER_CLUSTER)

    # customers and transactions arrive, balances do not
    for name in ("customers", "transactions"):
        frames[name].write.parquet(f"{landing[name]}/dia=2")
    kept.update()
    assert kept.customers().count() == N
    assert kept.customers().filter("categoria_saldo_disponible <> 'SIN_SALDO' OR saldo_disponible IS NOT NULL").count() == 0
    assert kept.profile().count() == frames["transactions"].select("CUSTID").distinct().count()
