"""Run registered queries beside their oracle SQL and compare columns and values."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def difference(frame, connection, sql: str) -> str | None:
    """None when both agree; otherwise what differs first."""
    names = sorted(frame.columns)
    got = Counter(tuple(_value(row[n]) for n in names) for row in frame.toLocalIterator())
    relation = connection.sql(sql)
    wanted_names = sorted(relation.columns)
    if [n.lower() for n in names] != [n.lower() for n in wanted_names] or names != wanted_names:
        return f"columns {names} against {wanted_names}"
    place = [relation.columns.index(n) for n in wanted_names]
    want = Counter(tuple(_value(row[i]) for i in place) for row in relation.fetchall())
    types = {n: type(v).__name__ for row in list(got)[:50] for n, v in zip(names, row) if v is not None}
    wanted_types = {n: type(v).__name__ for row in list(want)[:50] for n, v in zip(names, row) if v is not None}
    clash = {n: (t, wanted_types[n]) for n, t in types.items() if n in wanted_types and wanted_types[n] != t}
    if clash:
        return f"types {clash}"
    if got != want:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"{sum(got.values())} rows against {sum(want.values())}; extra {extra}; missing {missing}"
    return None


if __name__ == "__main__":
    from tollspark.session import build_session
    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session(master="local[8]", shuffle_partitions=8, **{
        "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles = oracle_connection(sf_dir), entry.oracle_sql()
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        begun = time.time()
        try:
            result = difference(fn(spark, sf_dir), connection, oracles[name])
        except Exception as error:  # noqa: BLE001 - a report of every query is wanted
            result = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{'ok  ' if result is None else 'FAIL'} {name} {time.time() - begun:.1f}s {result or ''}", flush=True)
