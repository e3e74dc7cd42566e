"""Run queries beside their SQL and compare columns, types and rows.

``python -m workload.check SF_DIR [query ...]``
"""

from __future__ import annotations

import collections
import math
import sys
import time

import duckdb

from workload.oracles import oracles
from workload.queries import queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """What differs between a query and its SQL; empty when nothing does."""
    df = query(spark, sf_dir)
    got_types = {c: _TYPES.get(t, t) for c, t in df.dtypes}
    names = sorted(df.columns)
    got = collections.Counter(tuple(_plain(r[c]) for c in names) for r in df.collect())
    relation = con.sql(sql)
    want_types = dict(zip(relation.columns, map(str, relation.types)))
    if got_types != want_types:
        return [f"columns differ: {sorted(set(got_types.items()) ^ set(want_types.items()))}"]
    order = [relation.columns.index(c) for c in names]
    want = collections.Counter(tuple(_plain(r[i]) for i in order) for r in relation.fetchall())
    problems = []
    for label, rows in (("only in Spark", got - want), ("only in SQL", want - got)):
        if rows:
            problems.append(f"{label}: {sum(rows.values())} rows, such as {str(min(rows, key=str))[:900]}")
    return problems


def main(sf_dir: str, only: list[str]) -> int:
    from tidemill.session import get_session

    spark = get_session("check", "local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = database(sf_dir), 0
    for name in only or [q for q in queries() if q in oracles()]:
        started = time.time()
        try:
            problems = differences(spark, con, queries()[name], oracles()[name], sf_dir)
        except Exception as error:
            problems = [str(error)[:1200]]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - started:.1f}s", *problems, sep="\n     ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
