"""Run registered queries next to their SQL in DuckDB and compare every value.

    python -m tests.compare --sf 0.01 [name ...]
"""

from __future__ import annotations

import argparse
import math
import time
import traceback

import duckdb

from rollcall.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
FAMILIES = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "INTEGER": "int", "BIGINT": "int",
    "double": "float", "DOUBLE": "float", "string": "text", "VARCHAR": "text", "boolean": "bool", "BOOLEAN": "bool",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.8g}") + 0.0
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def check(spark, con, name, fn, sql, sf_dir) -> tuple[str, str]:
    started = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if sql is None:
        return ("rows", f"{len(rows)} rows {took:.1f}s")
    started = time.time()
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    oracle = time.time() - started
    if sorted(df.columns) != sorted(types):
        return ("FAIL", f"columns {sorted(df.columns)} against {sorted(types)}")
    kinds = []
    for f in df.schema:
        a, b = FAMILIES.get(f.dataType.simpleString()), FAMILIES.get(types[f.name])
        if a is None or a != b:
            kinds.append(f"{f.name}: {f.dataType.simpleString()} against {types[f.name]}")
    if kinds:
        return ("FAIL", "types " + "; ".join(kinds))
    if len(rows) != len(expected):
        return ("FAIL", f"{len(rows)} rows against {len(expected)}")
    got, want = _rows(df.columns, rows), _rows(list(types), expected)
    different = [(a, b) for a, b in zip(got, want) if a != b]
    if different:
        return ("FAIL", f"{len(different)} of {len(rows)} rows differ, columns {sorted(df.columns)}: {different[:2]}")
    return ("ok", f"{len(rows)} rows, spark {took:.1f}s, duckdb {oracle:.1f}s")


def main() -> int:
    import __spark_entry__ as entry

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.001")
    parser.add_argument("--cores", default="8")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = build_session(
        master=f"local[{args.cores}]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        try:
            state, text = check(spark, con, name, fn, oracles.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001 - a report of every query is wanted
            state, text = "FAIL", f"{type(error).__name__}: {str(error)[:600]}"
            if args.names:
                traceback.print_exc(limit=4)
        failed += state == "FAIL"
        print(f"{state:5} {name}  {text}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
