"""The bank tables after two days of files."""

import threading

import pytest

from lakestrata.plans import bank, bank_flow
from lakestrata.plans.bank_flow import BankTables
from lakestrata.plans.queries import bank as queries
from lakestrata.session import new_scratch
from lakestrata.sources import fs
from lakestrata.sources.settings import replace_settings
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def kept(spark):
    return queries.two_day_tables(spark, SMALL)


def rowset(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_incremental_tables_equal_a_recompute(spark, kept):
    assert rowset(kept.transactions()) == rowset(queries.silver_transactions(spark, SMALL))
    assert rowset(kept.customers()) == rowset(queries.silver_customers(spark, SMALL))
    assert rowset(kept.activity()) == rowset(queries.gold_activity(spark, SMALL))
    assert rowset(kept.profile()) == rowset(queries.gold_profile(spark, SMALL))


def test_update_without_news_changes_nothing(kept):
    before = rowset(kept.counts()), rowset(kept.profile())
    kept.update()
    assert (rowset(kept.counts()), rowset(kept.profile())) == before


def test_rebuild_from_the_files_gives_the_same(spark, kept):
    fresh = BankTables(spark, kept.landing, f"{kept.root}_again", buckets=3, scale=2)
    fresh.update()
    assert rowset(fresh.transactions()) == rowset(kept.transactions())
    assert rowset(fresh.activity()) == rowset(kept.activity())


def test_bronze_keeps_all_deliveries(kept):
    counts = {r["table_name"]: r["rows"] for r in kept.counts().collect()}
    assert counts["bronze.customers"] == 300 and counts["silver.customers"] == 150
    assert kept.bronze("customers").select("año", "mes", "dia").distinct().count() == 2


def test_expectations_name_every_rule(kept):
    found = [r["rule"] for r in kept.expectations().collect()]
    assert sorted(found) == sorted([*bank.CUSTOMER_RULES, *bank.TRANSACTION_RULES])


def test_expectations_are_those_of_the_last_run_with_rows(spark, kept):
    """test_update_without_news ran in between: a run without rows carries the counts on."""
    history = {(r["run"], r["table_name"], r["rule"]): (r["met"], r["unmet"]) for r in kept.expectation_history().collect()}
    last = {(r["table_name"], r["rule"]): (r["met"], r["unmet"]) for r in kept.expectations().collect()}
    assert {run for run, _, _ in history} == {0, 1}
    assert last == {(t, rule): counts for (run, t, rule), counts in history.items() if run == 1}
    assert sum(history[0, "customers", "identificador_cliente_no_nulo"]) == sum(history[1, "customers", "identificador_cliente_no_nulo"]) == 150
    both = [sum(history[run, "transactions", "monto_neto_positivo"]) for run in (0, 1)]
    assert min(both) > 0 and sum(both) == kept.transactions().count()


def test_a_run_cut_short_before_its_log_is_made_up_for(spark, kept):
    before = rowset(kept.expectation_history().drop("run"))
    for name in fs.list_names(spark, f"{kept.root}/control/expectations"):
        if name != "0.json":
            fs.delete(spark, f"{kept.root}/control/expectations/{name}")
    kept.update()
    assert rowset(kept.expectation_history().drop("run")) == before


def test_skipped_columns_are_named(spark, kept):
    assert kept.skipped() == {}
    wider = BankTables(spark, kept.landing, kept.root, names={**kept.names, "balances": {**kept.names["balances"], "BLCN": "credito_utilizado"}})
    assert wider.skipped() == {"balances": ["BLCN"]}


def test_adhoc_sql(spark, kept):
    assert set(kept.views()) >= {"bronze_customers", "silver_customers", "gold_profile"}
    tiers = spark.sql(
        "SELECT clasificacion_riesgo_cliente, COUNT(*) AS n FROM silver_customers GROUP BY 1 ORDER BY n DESC"
    ).collect()
    assert sum(r["n"] for r in tiers) == 150
    top = spark.sql(
        "SELECT * FROM gold_activity WHERE cantidad_depositos_atm > 0 OR cantidad_retiros_atm > 0 "
        "ORDER BY cantidad_depositos_atm DESC LIMIT 10"
    ).collect()
    assert len(top) == 10
    assert spark.sql("SELECT COUNT(*) FROM silver_customers WHERE identificador_cliente IS NULL").first()[0] == 0


def test_from_settings(spark, tmp_path):
    name = "control_" + new_scratch(spark, "t").rsplit("-", 1)[-1]
    columns = ("Clave", "Valor")
    pairs = {"TipoStorage": "AmazonS3", "bucketS3": "b"}
    replace_settings(spark, name, pairs, columns)
    folders = {"customers": "landing/c/", "balances": "landing/b/", "transactions": "landing/t/"}
    with pytest.raises(KeyError, match="TiposTransaccionesLabBase"):
        BankTables.from_settings(spark, name, folders, "r", columns)
    replace_settings(spark, name, {**pairs, bank.TYPE_CODES_KEY: "X,Y,Z"}, columns)
    made = BankTables.from_settings(spark, name, folders, "r", columns, buckets=2)
    assert made.landing["balances"] == "s3://b/landing/b/" and made.type_codes == "X,Y,Z" and made.buckets == 2
    spark.sql(f"DROP TABLE {name}")


def test_from_settings_on_a_volume(spark):
    name = "control_" + new_scratch(spark, "t").rsplit("-", 1)[-1]
    pairs = {"TipoStorage": "Volume", "catalogoVolume": "c", "esquemaVolume": "s", bank.TYPE_CODES_KEY: "X,Y,Z", "bucketS3": "unused"}
    replace_settings(spark, name, pairs)
    with pytest.raises(KeyError, match="nombreVolume"):
        BankTables.from_settings(spark, name, {"customers": "in/c"}, "r")
    replace_settings(spark, name, {**pairs, "nombreVolume": "v"})
    assert BankTables.from_settings(spark, name, {"customers": "in/c"}, "r").landing == {"customers": "/Volumes/c/s/v/in/c"}
    replace_settings(spark, name, {**pairs, "TipoStorage": "Tape"})
    with pytest.raises(ValueError, match="Tape"):
        BankTables.from_settings(spark, name, {"customers": "in/c"}, "r")
    spark.sql(f"DROP TABLE {name}")


def test_tidy_keeps_the_tables(kept):
    before = rowset(kept.customers())
    kept.tidy()
    assert rowset(kept.customers()) == before


def test_tables_are_derived_as_soon_as_their_own_sources_are_in(monkeypatch):
    derived, waited, failing = threading.Event(), [], []

    def take_in(self, source):
        if source == bank_flow.TRANSACTIONS:
            waited.append(derived.wait(10))
        if source in failing:
            raise OSError(source)

    monkeypatch.setattr(BankTables, "_take_in", take_in)
    monkeypatch.setattr(BankTables, "_update_customers", lambda self: derived.set())
    monkeypatch.setattr(BankTables, "_update_transactions", lambda self: waited.append("derived"))
    for name in ("customers", "activity", "_log_expectations"):
        monkeypatch.setattr(BankTables, name, lambda self: None)
    monkeypatch.setattr(BankTables, "skipped", lambda self: {})
    monkeypatch.setattr(bank_flow.bank, "customer_profile", lambda *views: None)
    monkeypatch.setattr(bank_flow.tables, "full_refresh", lambda df, root: waited.append("profile"))
    BankTables(None, {}, "nowhere").update()
    assert waited == [True, "derived", "profile"]
    failing.append(bank_flow.TRANSACTIONS)
    with pytest.raises(OSError):
        BankTables(None, {}, "nowhere").update()
    assert waited == [True, "derived", "profile", True]  # nothing follows from a source that failed
