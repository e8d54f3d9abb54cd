"""Compare a Spark result with the same query in DuckDB: columns, types, rows, order ignored."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type name to DuckDB type name
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """The differences found; empty when both agree."""
    answer = con.sql(sql)
    want_types = {n: str(t) for n, t in zip(answer.columns, answer.types)}
    have_types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    if have_types != want_types:
        return [f"schema: {have_types} vs {want_types}"]
    names = sorted(have_types)
    order = [answer.columns.index(n) for n in names]
    want = sorted((tuple(row[i] for i in order) for row in answer.fetchall()), key=repr)
    have = sorted((tuple(row) for row in df.select(*names).collect()), key=repr)
    if len(want) != len(have):
        return [f"rows: {len(have)} vs {len(want)}"]
    wrong = [(h, w) for h, w in zip(have, want) if h != w]
    return [f"{len(wrong)} rows differ, e.g. {wrong[0][0]} vs {wrong[0][1]}"] if wrong else []


def main(sf_dir: str, names: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    spark = make_session()
    con = connect(sf_dir)
    sqls = oracle_sql()
    for name, query in queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                bad = compare(df, con, sqls[name])
                said = "; ".join(bad) or "ok"
            else:
                said = f"rows only: {df.count()}"
        except Exception as error:  # a report over all queries must not stop at the first
            said = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:32} {time.time() - start:6.2f}s  {said}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
