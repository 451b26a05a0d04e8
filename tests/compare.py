"""Run registered queries and their SQL twins side by side.

    python tests/compare.py [SF_DIR] [QUERY ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> tuple[bool, str]:
    """Whether names, row count and every value agree exactly, and a note."""
    df = contract.queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return bool(rows), f"{len(rows)} rows, no twin"
    cursor = con.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(expected_columns):
        return False, f"columns {sorted(df.columns)} / {sorted(expected_columns)}"
    left, right = canonical(df.columns, rows), canonical(expected_columns, expected)
    types = {c: (t, kinds[c]) for c, t in df.dtypes if not same_type(t, kinds[c])}
    if types:
        return False, f"types {types}"
    if left == right:
        return bool(rows), f"{len(rows)} rows"
    only_left = sorted(set(left) - set(right))[:2]
    only_right = sorted(set(right) - set(left))[:2]
    return False, f"{len(left)}/{len(right)} rows\n  spark {only_left}\n  sql   {only_right}"


_TYPES = {
    "string": {"VARCHAR"},
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def same_type(spark_type: str, duck_type: str) -> bool:
    return duck_type in _TYPES.get(spark_type, {duck_type})


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(contract.queries())
    spark, con, failed = local_session(), duck(sf_dir), 0
    for name in names:
        began = time.time()
        try:
            good, note = compare(spark, con, name, sf_dir)
        except Exception as error:
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not good
        print(f"{'ok  ' if good else 'FAIL'} {name:24s} {time.time() - began:6.2f}s {note}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
