"""Run registered queries and their oracles side by side.

    python -m tests.compare [sf] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if names, types and rows agree."""
    found: list[str] = []
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    kinds = {d[0]: str(d[1]) for d in answer.description}
    expected = _sorted_rows(names, answer.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} vs {sorted(names)}"]
    for field in spark_df.schema.fields:
        kind = SPARK_TO_DUCK.get(field.dataType.simpleString(), field.dataType.simpleString())
        if kind != kinds[field.name]:
            found.append(f"type of {field.name}: {kind} vs {kinds[field.name]}")
    got = _sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(got) != len(expected):
        found.append(f"rows {len(got)} vs {len(expected)}")
    wrong = [(a, b) for a, b in zip(got, expected) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first: {wrong[0]}")
    return found


def main(argv: list[str]) -> int:
    import __spark_entry__ as contract
    from tallyspan.session import build_session

    sf_dir = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    spark: SparkSession = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = contract.oracle_sql()
    failed = 0
    for name, run in contract.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        started = time.time()
        try:
            if name in oracles:
                found = differences(run(spark, sf_dir), con, oracles[name])
                verdict = "ok" if not found else "DIFF " + "; ".join(found)
            else:
                verdict = f"rows only: {run(spark, sf_dir).count()}"
        except Exception as error:  # report and go on with the next query
            found, verdict = [str(error)], f"ERROR {str(error)[:1500]}"
        failed += verdict.startswith(("DIFF", "ERROR"))
        print(f"{name:32s} {time.time() - started:6.2f}s  {verdict}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
