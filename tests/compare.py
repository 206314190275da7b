"""Run queries next to their SQL and report differences: python tests/compare.py SF [name ...]"""

from __future__ import annotations

import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "double": "DOUBLE",
}


def oracle_connection(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql) -> str | None:
    want = con.sql(sql)
    names, kinds = want.columns, dict(zip(want.columns, map(str, want.types)))
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    off = [
        f"{c}: {k} != {kinds[c]}" for c, k in df.dtypes
        if kinds[c].replace(" ", "") != KINDS.get(k, k.upper()).replace(" ", "")
    ]
    got, exp = table(df.columns, df.collect()), table(names, want.fetchall())
    if got != exp:
        a, b = set(got) - set(exp), set(exp) - set(got)
        return f"rows {len(got)} != {len(exp)}; only here {list(a)[:2]}; only there {list(b)[:2]}"
    if off:
        return "types " + ", ".join(off)
    return None if got else "EMPTY"


def main() -> None:
    import __spark_entry__ as entry
    from pulsebook.session import local_session

    folder = f"/root/testdata/sf{sys.argv[1]}"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session(8)
    con = oracle_connection(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = queries[n](spark, folder)
            if n in oracles:
                note = difference(df, con, oracles[n])
            else:
                note = f"no SQL, {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            note = f"{type(e).__name__}: {str(e)[:700]}"
        if note and not note.startswith("no SQL"):
            bad += 1
        if note or len(sys.argv) > 2:
            print(f"{n} [{time.time() - t0:.1f}s]: {note or 'same'}", flush=True)
    print(f"{len(names)} queries, {bad} differ")


if __name__ == "__main__":
    main()
