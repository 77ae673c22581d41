"""Run queries next to their SQL twins and compare rows as the driver does, but stricter."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normalised(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    rows = [
        tuple(None if pd.isna(v) else v for v in row) for row in pdf.itertuples(index=False, name=None)
    ]
    return sorted(rows, key=repr)


def compare(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> str | None:
    """None if equal, else what differs first."""
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} != {sorted(sql_pdf.columns)}"
    if len(spark_pdf) != len(sql_pdf):
        return f"rows {len(spark_pdf)} != {len(sql_pdf)}"
    kinds = {
        c: (spark_pdf[c].dtype.kind, sql_pdf[c].dtype.kind)
        for c in spark_pdf.columns
        if spark_pdf[c].dtype.kind != sql_pdf[c].dtype.kind and not spark_pdf[c].isna().any()
    }
    if kinds:
        return f"types {kinds}"
    for ours, theirs in zip(normalised(spark_pdf), normalised(sql_pdf)):
        if ours != theirs:
            return f"{ours} != {theirs}"
    return None


if __name__ == "__main__":
    from tests.conftest import session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark, connection = session(), connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in sql.keys() - queries.keys():
        print("no query for", name)
    for name in wanted or queries:
        start = time.time()
        try:
            ours = queries[name](spark, sf_dir).toPandas()
            seconds = time.time() - start
            verdict = compare(ours, connection.sql(sql[name]).df()) if name in sql else "no SQL"
        except Exception as error:  # noqa: BLE001
            print(f"FAIL {name}: {type(error).__name__} {str(error)[:600]}")
            continue
        print(f"{'ok  ' if verdict is None else 'DIFF'} {name} {len(ours)} rows {seconds:.2f}s {verdict or ''}"[:700])
