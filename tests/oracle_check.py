"""Compare registered queries with their oracle SQL, value by value.

    python -m tests.oracle_check 0.01 [query ...]
"""

import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, Decimal):
        raise TypeError("decimal result: cast it on both sides")
    return value


def spark_rows(frame):
    names = sorted(frame.columns)
    types = {f.name: TYPES[f.dataType.simpleString()] for f in frame.schema.fields}
    rows = Counter(tuple(_plain(v) for v in r) for r in frame.select(*names).collect())
    return names, types, rows


def oracle_rows(con, sql):
    result = con.execute(sql)
    columns = [(d[0], str(d[1])) for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i][0])
    rows = Counter(tuple(_plain(r[i]) for i in order) for r in result.fetchall())
    return [columns[i][0] for i in order], dict(columns), rows


def difference(frame, con, sql):
    """None when equal, else a short text."""
    names, types, rows = spark_rows(frame)
    want_names, want_types, want = oracle_rows(con, sql)
    if names != want_names:
        return f"columns {sorted(set(names) ^ set(want_names))}"
    if types != want_types:
        return f"types {[(n, types[n], want_types[n]) for n in names if types[n] != want_types[n]]}"
    if rows != want:
        extra, missing = rows - want, want - rows
        text = f"{rows.total()} rows, want {want.total()}; {extra.total()} extra, {missing.total()} missing"
        for row in list(extra)[:1]:
            near = max(missing, key=lambda m: sum(a == b for a, b in zip(row, m)), default=None)
            if near:
                text += f"; {[(n, a, b) for n, a, b in zip(names, row, near) if a != b]}"
        return text
    return None if rows else "no rows"


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from tests.session import local_session

    sf_dir = TESTDATA / f"sf{argv[0]}"
    spark, con, sql = local_session(), connect(sf_dir), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if len(argv) > 1 and name not in argv[1:]:
            continue
        began = time.perf_counter()
        if name in sql:
            problem = difference(query(spark, str(sf_dir)), con, sql[name])
        else:
            problem = None if query(spark, str(sf_dir)).collect() else "no rows"
        bad += problem is not None
        kind = "" if name in sql else " (rows only)"
        print(f"{name:30s} {time.perf_counter() - began:6.2f}s {problem or 'ok'}{kind}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
