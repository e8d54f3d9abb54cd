"""The bank model kept up to date from landed files: each update takes in and derives only what is new."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lakestrata.operators.aggregate import layer_counts
from lakestrata.operators.project import skipped_names
from lakestrata.plans import bank
from lakestrata.sources import fs, ingest, settings, tables
from lakestrata.sources.checked import rule_counts
from lakestrata.sources.paths import KIND_KEY, resolve_path, root_keys
from lakestrata.streaming.append import BATCH, append_refresh, read_appended
from lakestrata.streaming.group_refresh import group_refresh, read_metrics
from lakestrata.streaming.view_refresh import fold_view, newest_pairs, read_view, stateful_session, view_refresh

CUSTOMERS, BALANCES, TRANSACTIONS = "customers", "balances", "transactions"
VIEW_KEY = "identificador_cliente"
#: the tables with expectations: their folder and rules
CHECKED = {CUSTOMERS: ("silver/customer_view", bank.CUSTOMER_RULES), TRANSACTIONS: ("silver/transactions", bank.TRANSACTION_RULES)}
REPORT = "run long, table_name string, rule string, met long, unmet long, unknown long, upto long, carried boolean"
LEAD = {
    CUSTOMERS: (ingest.INGEST_TS, bank.KEY),
    BALANCES: (ingest.INGEST_TS, bank.KEY),
    TRANSACTIONS: ("TRXDT", bank.KEY, "TRXTYP"),
}


@dataclass(frozen=True)
class BankTables:
    """All tables below ``root``. To rebuild everything from the files, update a new ``root``.

    ``landing`` maps customers, balances and transactions to their folders. ``buckets`` is
    the number of parts of the customer state; choose it once, for the customers to come. A
    micro-batch takes at most ``max_files`` files of a source. With ``archive`` landed files are moved
    there once they are taken; choose it from the first update on.
    """

    spark: SparkSession
    landing: Mapping[str, str]
    root: str
    buckets: int = 64
    max_files: int = 1_000
    type_codes: str = bank.TYPE_CODES
    scale: int | None = None
    archive: str | None = None
    names: Mapping[str, Mapping[str, str]] = field(
        default_factory=lambda: {
            CUSTOMERS: bank.CUSTOMER_NAMES,
            BALANCES: bank.BALANCE_NAMES,
            TRANSACTIONS: bank.TRANSACTION_NAMES,
        }
    )

    @classmethod
    def from_settings(
        cls,
        spark: SparkSession,
        table: str,
        folders: Mapping[str, str],
        root: str,
        columns: tuple[str, str] = settings.COLUMNS,
        **options,
    ) -> BankTables:
        """Landing folders below the storage root, and type codes, both from a settings table.

        Only the storage kind, its own keys and the codes are read, however large the table is.
        """
        found = settings.load_settings(spark, table, (KIND_KEY, bank.TYPE_CODES_KEY), columns)
        of_kind = root_keys(found[KIND_KEY])
        if of_kind:
            found |= settings.load_settings(spark, table, of_kind, columns)
        landing = {source: resolve_path(found, folder) for source, folder in folders.items()}
        return cls(spark, landing, root, type_codes=found[bank.TYPE_CODES_KEY], **options)

    def update(self) -> None:
        """Take in new files and bring every table up to date; independent steps run side by side.

        A table is derived as soon as its own sources are taken in, whatever the others still do.
        The expectations of what the run processed are counted while it is written, and logged with
        it: a run that was cut short is made up for by the next one.
        """
        with ThreadPoolExecutor() as pool:
            taken = {source: pool.submit(self._take_in, source) for source in (CUSTOMERS, BALANCES, TRANSACTIONS)}

            def derive(step: Callable[[], None], *sources: str) -> None:
                for source in sources:
                    taken[source].result()
                step()

            derived = [
                pool.submit(derive, self._update_customers, CUSTOMERS, BALANCES),
                pool.submit(derive, self._update_transactions, TRANSACTIONS),
            ]
        for done in (*taken.values(), *derived):
            done.result()
        tables.full_refresh(bank.customer_profile(self.customers(), self.activity()), f"{self.root}/gold/profile")
        self._log_expectations()
        for source, names in self.skipped().items():
            logging.getLogger(__name__).warning("%s has no column for %s", source, ", ".join(names))

    def _take_in(self, source: str) -> None:
        folder = f"{self.root}/bronze/{source}"
        lay = {"lead": LEAD[source], "sort_by": LEAD[source]}
        if self.archive:
            ingest.ingest_and_archive(self.spark, self.landing[source], f"{folder}/table", f"{self.archive}/{source}", f"{folder}/schema", **lay)
        else:
            ingest.ingest_files(self.spark, self.landing[source], f"{folder}/table", f"{folder}/checkpoint", f"{folder}/schema", **lay)

    def _update_customers(self) -> None:
        own = stateful_session(self.spark, self.buckets)
        left, right = (bank.mapped_columns(self._stream(s, own), self.names[s], bank.NEWEST_BY) for s in (CUSTOMERS, BALANCES))
        folder, rules = CHECKED[CUSTOMERS]
        view_refresh(
            left, right, f"{self.root}/{folder}", f"{self.root}/{folder}_checkpoint",
            [bank.KEY], (bank.NEWEST_BY, bank.NEWEST_BY), self._pair, [VIEW_KEY], rules,
        )

    def _update_transactions(self) -> None:
        folder, rules = CHECKED[TRANSACTIONS]
        append_refresh(
            self._stream(TRANSACTIONS), self._enrich, f"{self.root}/{folder}", f"{self.root}/{folder}_checkpoint",
            bank.TRANSACTION_CLUSTER, rules,
        )
        silver = self.spark.readStream.schema(self.transactions().schema).option("maxFileAge", ingest.MAX_FILE_AGE)
        group_refresh(
            silver.option("maxFilesPerTrigger", self.max_files).parquet(f"{self.root}/{folder}"),
            f"{self.root}/gold/activity", f"{self.root}/gold/activity_checkpoint",
            VIEW_KEY, "tipo_transaccion", "monto_principal",
            self.scale,
        )

    def tidy(self) -> None:
        """Fold the customer view into one folder."""
        fold_view(self.spark, f"{self.root}/{CHECKED[CUSTOMERS][0]}", self._view_schema(), [VIEW_KEY])

    # --- the tables --------------------------------------------------------------------------

    def bronze(self, source: str) -> DataFrame:
        folder = f"{self.root}/bronze/{source}"
        return ingest.read_ingested(self.spark, f"{folder}/table", f"{folder}/schema")

    def customers(self) -> DataFrame:
        return read_view(self.spark, f"{self.root}/{CHECKED[CUSTOMERS][0]}", self._view_schema(), [VIEW_KEY])

    def transactions(self) -> DataFrame:
        schema = self._enrich(self.bronze(TRANSACTIONS)).schema
        return read_appended(self.spark, f"{self.root}/silver/transactions", schema)

    def activity(self) -> DataFrame:
        spec = bank.atm_metrics_spec(self.type_codes)
        return read_metrics(self.spark, f"{self.root}/gold/activity", "identificador_cliente", spec)

    def profile(self) -> DataFrame:
        return tables.current_version(self.spark, f"{self.root}/gold/profile")

    def views(self) -> list[str]:
        """Register every table as a temporary view for SQL; returns their names."""
        found = {f"bronze_{s}": self.bronze(s) for s in (CUSTOMERS, BALANCES, TRANSACTIONS)}
        found |= {"silver_customers": self.customers(), "silver_transactions": self.transactions()}
        found |= {"gold_activity": self.activity(), "gold_profile": self.profile()}
        for name, df in found.items():
            df.createOrReplaceTempView(name)
        return list(found)

    def expectations(self) -> DataFrame:
        """Per table and rule the rows of the newest run that had any: met, unmet, and unknown among those."""
        runs = self._runs()
        if not runs:
            return self.spark.createDataFrame([], REPORT).drop("run", "upto", "carried")
        return self._reports(f"{runs[-1]}.json").drop("run", "upto", "carried")

    def expectation_history(self) -> DataFrame:
        """The same of every run and table that had rows to process."""
        return self._reports("*.json").filter("NOT carried").drop("upto", "carried")

    def skipped(self) -> dict[str, list[str]]:
        """Mapped columns that the files taken in so far don't have, by source; the views lack them."""
        found = {s: skipped_names(self.bronze(s), self.names[s]) for s in (CUSTOMERS, BALANCES, TRANSACTIONS)}
        return {s: names for s, names in found.items() if names}

    def counts(self) -> DataFrame:
        named = {f"bronze.{s}": self.bronze(s) for s in (CUSTOMERS, BALANCES, TRANSACTIONS)}
        named |= {"silver.customers": self.customers(), "silver.transactions": self.transactions()}
        return layer_counts(named | {"gold.activity": self.activity(), "gold.profile": self.profile()})

    # --- helpers -----------------------------------------------------------------------------

    def _stream(self, source: str, session: SparkSession | None = None) -> DataFrame:
        folder = f"{self.root}/bronze/{source}"
        return ingest.stream_ingested(session or self.spark, f"{folder}/table", f"{folder}/schema", self.max_files)

    def _view_schema(self):
        columns = (bank.mapped_columns(self.bronze(s), self.names[s], bank.NEWEST_BY) for s in (CUSTOMERS, BALANCES))
        empty = (self.spark.createDataFrame([], c.schema) for c in columns)
        return self._pair(newest_pairs(*empty, [bank.KEY], (bank.NEWEST_BY, bank.NEWEST_BY))).schema

    def _pair(self, pairs: DataFrame) -> DataFrame:
        return bank.paired_view(pairs, {**self.names[CUSTOMERS], **self.names[BALANCES]})

    def _runs(self) -> list[int]:
        """Numbers of the logged runs, one small file each."""
        return sorted(int(n.removesuffix(".json")) for n in fs.list_names(self.spark, f"{self.root}/control/expectations") if n.endswith(".json"))

    def _reports(self, name: str) -> DataFrame:
        return self.spark.read.schema(REPORT).json(f"{fs.escape_glob(self.root)}/control/expectations/{name}")

    def _log_expectations(self) -> None:
        """One file per run: the counts of the batches since the last logged one, or that one's carried on."""
        log, runs = f"{self.root}/control/expectations", self._runs()
        last = map(json.loads, fs.read_text(self.spark, f"{log}/{runs[-1]}.json").splitlines()) if runs else ()
        known: dict[str, list[dict]] = {}
        for line in last:
            known.setdefault(line["table_name"], []).append(line)
        run, lines = (runs[-1] + 1 if runs else 0), []
        for table, (folder, _) in CHECKED.items():
            upto = known[table][0]["upto"] if table in known else -1
            new = [n for n in tables.numbered(self.spark, f"{self.root}/{folder}", BATCH) if n > upto]
            if not new:
                lines += [line | {"carried": True} for line in known.get(table, [])]
            counted = rule_counts(self.spark, f"{self.root}/{folder}", [f"{BATCH}={n}" for n in new])
            for rule, (met, unmet, unknown) in counted.items():
                lines.append({"run": run, "table_name": table, "rule": rule, "met": met, "unmet": unmet, "unknown": unknown, "upto": new[-1], "carried": False})
        fs.write_text(self.spark, f"{log}/{run}.json", "\n".join(map(json.dumps, lines)))

    def _enrich(self, bronze: DataFrame) -> DataFrame:
        return bank.transaction_view(bronze, self.names[TRANSACTIONS])
