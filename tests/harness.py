"""Run checked queries next to their SQL and compare them as the driver does."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    if isinstance(value, float):
        return repr(round(value, 6))
    return repr(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    got = df.collect()
    if sql is None:
        return True, f"{len(got)} rows, no oracle"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(columns)}"
    odd = [(c, t, kinds[c]) for c, t in df.dtypes if KINDS.get(t) != kinds[c]]
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if a != b:
        in_a, in_b = set(a), set(b)
        only_a = [r for r in a if r not in in_b][:3]
        only_b = [r for r in b if r not in in_a][:3]
        return False, f"{len(a)} vs {len(b)} rows; spark only {only_a}; sql only {only_b}"
    return not odd, f"{len(a)} rows" + (f"; types {odd}" if odd else "")


def main(argv: list[str]) -> None:
    import __spark_entry__ as entry
    from pagegrain.session import get_spark

    sf = os.environ.get("SF", "0.01")
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_spark(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                            "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if argv and not any(name.startswith(a) for a in argv):
            continue
        start = time.time()
        try:
            ok, note = compare(spark, con, name, query, sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:1500]}"
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name:24s} {time.time() - start:6.2f}s {note[:1800]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
