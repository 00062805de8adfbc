"""Compare every registered query with its SQL on one data folder.

    python tools/check.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corpusprep.plans.registry import oracle_sql, queries  # noqa: E402
from corpusprep.session import local_session  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in values)


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    df = queries()[name](spark, folder)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    sql = oracle_sql().get(name)
    if sql is None:
        return len(got[1]) > 0, f"rows only: {len(got[1])}"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    want = rows(columns, result.fetchall())
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:2]
        missing = [r for r in want[1] if r not in set(got[1])][:2]
        return False, f"rows {len(got[1])} vs {len(want[1])}; extra {extra}; missing {missing}"
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    plain = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "INTEGER": "int", "BOOLEAN": "boolean"}
    odd = {c: (spark_types[c], types[c]) for c in columns if plain.get(types[c]) != spark_types[c]}
    return True, f"{len(got[1])} rows" + (f"; types differ {odd}" if odd else "")


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names:
        start = time.perf_counter()
        try:
            ok, note = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:24} {time.perf_counter() - start:6.2f}s  {note}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
