"""Run queries against their SQL: python tests/compare.py [folder] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if value is None:
        return "\0null"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


_KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and the SQL's result, as readable lines."""
    result = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in result.description}
    want_names, want = _rows(list(want_types), result.fetchall())
    got_types = {f.name: _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    found = []
    if want_names != got_names:
        found.append(f"columns: {got_names} instead of {want_names}")
    elif want_types != got_types:
        found.append(f"types: {got_types} instead of {want_types}")
    if len(want) != len(got):
        found.append(f"rows: {len(got)} instead of {len(want)}")
    if want != got:
        extra = sorted(set(got) - set(want))[:3]
        missing = sorted(set(want) - set(got))[:3]
        found.append(f"values: extra {extra} missing {missing}"[:1500])
    if not want:
        found.append("the SQL gives no rows")
    return found


def main() -> int:
    import __spark_entry__ as entry
    from siteweave.session import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(entry.queries())
    spark, con, bad = get_session("compare", 8, 8), connect(folder), 0
    for name in names:
        begun = time.time()
        try:
            df = entry.queries()[name](spark, folder)
            sql = entry.oracle_sql().get(name)
            found = differences(df, con, sql) if sql else [f"no SQL; {df.count()} rows"]
        except Exception as error:  # report and go on
            found = [f"{type(error).__name__}: {str(error)[:1200]}"]
        bad += bool(found)
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - begun:.1f}s", *found, sep="\n    ", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
