"""The bank model: silver customers and transactions, gold activity metrics and customer profile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.derive import difference, fingerprint, or_zero, percent_of, product, tiers
from lakestrata.operators.aggregate import Metric, conditional_metrics
from lakestrata.operators.joins import inner_once, left_once
from lakestrata.operators.latest import latest_per_key
from lakestrata.operators.project import drop_present, lead_columns, rename_project
from lakestrata.sources import ingest
from lakestrata.sources.settings import split_codes

# The source columns that formulas, checks, clustering and the profile depend on,
# with the names their consumers expect. Pass a wider mapping to carry more columns along.
CUSTOMER_NAMES = {
    "CUSTID": "identificador_cliente",
    "CUSNM": "nombre_cliente",
    "CUSLN": "apellido_cliente",
    "CUSDB": "fecha_nacimiento",
    "CUSCT": "ciudad_residencia",
    "CUSCN": "pais_residencia",
    "CUSNA": "nacionalidad_cliente",
    "CUSOC": "ocupacion_cliente",
    "CUSED": "nivel_educativo",
    "CUSRK": "nivel_riesgo",
    "CUSCR": "calificacion_crediticia",
    "CUSAC2": "cantidad_cuentas",
    "CUSTX": "cantidad_transacciones",
    "CUSSC": "score_cliente",
    "CUSLR": "ranking_prestamos",
}
BALANCE_NAMES = {
    "BLACT": "tipo_cuenta",
    "BLST": "estado_cuenta",
    "BLAV": "saldo_disponible",
    "BLTB": "saldo_total",
    "BLCR": "limite_credito",
    "BLOD": "fecha_apertura_cuenta",
}
TRANSACTION_NAMES = {
    "TRXID": "identificador_transaccion",
    "CUSTID": "identificador_cliente",
    "TRXTYP": "tipo_transaccion",
    "TRXCUR": "moneda_transaccion",
    "TRXAMT": "monto_principal",
    "TRXCM": "comision_transaccion",
    "TRXBA": "saldo_posterior",
    "TRXBP": "saldo_anterior",
    "TRXRK": "riesgo_transaccion",
    "TRXNT": "monto_neto",
    "TRXDT": "fecha_transaccion",
}
# Control columns of the ingested tables, the settings key of the type codes,
# clustering columns, expectations, and the columns of the profile.
CONTROL_COLUMNS = ("FechaIngestaDatos", "_rescued_data", "año", "mes", "dia", *ingest.CONTROL)
TYPE_CODES_KEY, TYPE_CODES = "TiposTransaccionesLabBase", "DATM,CATM,PGSL"
CUSTOMER_CLUSTER = ("huella_identificacion_cliente", "identificador_cliente")
TRANSACTION_CLUSTER = ("fecha_transaccion", "identificador_cliente", "tipo_transaccion")
CUSTOMER_RULES = {
    "fecha_nacimiento_valida": "fecha_nacimiento < '2009-01-01'",
    "fecha_apertura_cuenta_valida": "fecha_apertura_cuenta > '2020-12-31'",
    "limite_credito_no_nulo": "limite_credito IS NOT NULL",
    "identificador_cliente_no_nulo": "identificador_cliente IS NOT NULL",
    "limite_credito_positivo": "limite_credito > 0",
}
TRANSACTION_RULES = {
    "identificador_cliente_no_nulo": "identificador_cliente IS NOT NULL",
    "monto_neto_positivo": "monto_neto > 0",
    "monto_neto_no_nulo": "monto_neto IS NOT NULL",
    "moneda_transaccion_no_nula": "moneda_transaccion IS NOT NULL",
}
# How often each transaction and account type occurs, in percent.
TRANSACTION_TYPE_WEIGHTS = (
    ("CATM", 15),
    ("DATM", 14),
    ("CMPR", 13),
    ("TINT", 10),
    ("DPST", 8),
    ("PGSL", 7),
    ("TEXT", 6),
    ("RTRO", 5),
    ("PGSV", 5),
    ("NMNA", 4),
    ("INTR", 3),
    ("ADSL", 3),
    ("IMPT", 3),
    ("DMCL", 2),
    ("CMSN", 2),
)
ACCOUNT_TYPE_WEIGHTS = (("AHRO", 40), ("CRTE", 30), ("PRES", 20), ("INVR", 10))
PROFILE_CUSTOMER_COLUMNS = (
    "huella_identificacion_cliente",
    "identificador_cliente",
    "nombre_cliente",
    "apellido_cliente",
    "nacionalidad_cliente",
    "pais_residencia",
    "ciudad_residencia",
    "ocupacion_cliente",
    "nivel_educativo",
    "clasificacion_riesgo_cliente",
    "categoria_saldo_disponible",
    "perfil_actividad_bancaria",
    "limite_credito",
    "saldo_disponible",
    "fecha_apertura_cuenta",
    "estado_cuenta",
    "tipo_cuenta",
)

KEY = "CUSTID"
# which file brought a row, and its place in it: tells any two rows apart
NEWEST_BY = (ingest.INGEST_TS, ingest.SOURCE_TIME, ingest.SOURCE_FILE, ingest.SOURCE_ROW)


def risk_tier(score: str = "score_cliente", level: str = "nivel_riesgo", grade: str = "calificacion_crediticia") -> Column:
    points = or_zero(score, 0)
    return tiers(
        [
            ((points >= 750) & F.col(level).isin("L", "LOW") & F.col(grade).isin("A", "AA", "AAA"), "RIESGO_BAJO"),
            ((points >= 500) & F.col(level).isin("M", "MED"), "RIESGO_MEDIO"),
            ((points < 500) | F.col(level).isin("H", "HIGH"), "RIESGO_ALTO"),
        ],
        "SIN_CLASIFICAR",
    )


def balance_tier(available: str = "saldo_disponible", limit: str = "limite_credito", total: str = "saldo_total") -> Column:
    a, c, t = or_zero(available), or_zero(limit), or_zero(total)
    return tiers(
        [
            ((a >= 100_000) & (c >= 50_000) & (t >= 150_000), "PREMIUM"),
            ((a >= 25_000) & (c >= 10_000), "ESTANDAR"),
            (a > 0, "BASICO"),
        ],
        "SIN_SALDO",
    )


def activity_tier(
    transactions: str = "cantidad_transacciones", accounts: str = "cantidad_cuentas", rank: str = "ranking_prestamos"
) -> Column:
    n, a, r = or_zero(transactions, 0), or_zero(accounts, 0), or_zero(rank, 0)
    return tiers(
        [((n >= 100) & (a >= 3) & (r >= 5), "MUY_ACTIVO"), ((n >= 30) & (a >= 2), "ACTIVO"), (n >= 1, "MODERADO")],
        "INACTIVO",
    )


def customer_view(
    master: DataFrame,
    balances: DataFrame,
    customer_names: Mapping[str, str] = CUSTOMER_NAMES,
    balance_names: Mapping[str, str] = BALANCE_NAMES,
    newest_by: Sequence[str] = NEWEST_BY,
) -> DataFrame:
    """Silver customers: newest master and balance row per customer, renamed, with tiers and fingerprint."""
    return join_current(
        current_rows(master, customer_names, newest_by),
        current_rows(balances, balance_names, newest_by),
        {**customer_names, **balance_names},
    )


def mapped_columns(bronze: DataFrame, names: Mapping[str, str], newest_by: Sequence[str]) -> DataFrame:
    """Only the columns that are mapped or order the rows: the rest is neither sorted nor shuffled."""
    return bronze.select(*dict.fromkeys([KEY, *(c for c in names if c in bronze.columns), *newest_by]))


def current_rows(bronze: DataFrame, names: Mapping[str, str], newest_by: Sequence[str]) -> DataFrame:
    return latest_per_key(mapped_columns(bronze, names, newest_by), [KEY], newest_by, unique=tuple(newest_by) == NEWEST_BY)


def join_current(master: DataFrame, balances: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The view from one row per customer on each side; customers without balance stay."""
    return _customer_columns(left_once(drop_present(master, CONTROL_COLUMNS), drop_present(balances, CONTROL_COLUMNS), [KEY]), names)


def paired_view(pairs: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The view from (``KEY``, newest master row, newest balance row or NULL)."""
    parts = [F.col(f"{side}.`{f}`") for side in ("left", "right") for f in pairs.schema[side].dataType.names if f not in CONTROL_COLUMNS]
    return _customer_columns(pairs.select(KEY, *parts), names)


def _customer_columns(joined: DataFrame, names: Mapping[str, str]) -> DataFrame:
    derived = rename_project(joined, names).withColumns(
        {
            "clasificacion_riesgo_cliente": risk_tier(),
            "categoria_saldo_disponible": balance_tier(),
            "perfil_actividad_bancaria": activity_tier(),
            "huella_identificacion_cliente": fingerprint("identificador_cliente"),
        }
    )
    return lead_columns(derived, CUSTOMER_CLUSTER)


def transaction_view(bronze: DataFrame, names: Mapping[str, str] = TRANSACTION_NAMES) -> DataFrame:
    """Silver transactions: row by row, so it serves batches and append-only streams alike."""
    named = rename_project(drop_present(bronze, CONTROL_COLUMNS), names)
    derived = named.withColumns(
        {
            "monto_neto_comisiones": difference("monto_principal", "comision_transaccion"),
            "porcentaje_comision_sobre_monto": percent_of("comision_transaccion", "monto_principal"),
            "variacion_saldo_transaccion": difference("saldo_posterior", "saldo_anterior"),
            "indicador_impacto_financiero": product("monto_principal", "riesgo_transaccion"),
        }
    )
    return lead_columns(derived, TRANSACTION_CLUSTER)


def atm_metrics_spec(type_codes: str = TYPE_CODES) -> tuple[Metric, ...]:
    """The five metrics; deposit, withdrawal and payment codes by position in ``type_codes``."""
    deposit, withdrawal, payment = split_codes(type_codes, 3)
    return (
        Metric("cantidad_depositos_atm", "count", deposit),
        Metric("cantidad_retiros_atm", "count", withdrawal),
        Metric("promedio_monto_depositos_atm", "avg", deposit),
        Metric("promedio_monto_retiros_atm", "avg", withdrawal),
        Metric("total_pagos_saldo_cliente", "sum", payment),
    )


def atm_metrics(transactions: DataFrame, type_codes: str = TYPE_CODES, scale: int | None = None) -> DataFrame:
    """Gold activity: one row per customer with any transaction."""
    spec = atm_metrics_spec(type_codes)
    return conditional_metrics(
        transactions, "identificador_cliente", "tipo_transaccion", "monto_principal", spec, scale
    )


def customer_profile(customers: DataFrame, metrics: DataFrame) -> DataFrame:
    """Gold profile: customers present in both inputs, 22 columns."""
    measures = [m.name for m in atm_metrics_spec()]
    joined = inner_once(customers, metrics, ["identificador_cliente"])
    zero = {m: 0 if m.startswith("cantidad") else 0.0 for m in measures}
    return joined.select(*PROFILE_CUSTOMER_COLUMNS, *(or_zero(m, zero[m]).alias(m) for m in measures))
