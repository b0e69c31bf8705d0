"""Run registered queries and their DuckDB oracles side by side.

Usage: python tests/oracle_harness.py [sf_dir] [key ...]
Prints one line per key: OK / MISMATCH (rows, columns, values) / ERROR.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _cell(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        v = round(v, 6) + 0.0
        return str(int(v)) if v.is_integer() else repr(v)  # a long column with nulls comes as floats
    return str(v)


def frame_digest(pdf):
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_cell(r[c]) for c in cols) for r in pdf[cols].to_dict("records"))
    return cols, len(rows), hashlib.sha256("\n".join(rows).encode()).hexdigest(), rows


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from quotelens.session import get_session
    spark = get_session("local[8]", 8)
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    keys = keys or list(qs)
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            sp = qs[k](spark, sf_dir).toPandas()
            t1 = time.time() - t0
            if k not in orc:
                print(f"ROWS-ONLY {k}: {len(sp)} rows  {t1:.1f}s", flush=True)
                continue
            dd = con.execute(orc[k]).df()
            a, b = frame_digest(sp), frame_digest(dd)
            if a[0] != b[0]:
                bad += 1
                print(f"MISMATCH-COLS {k}: spark={a[0]} duck={b[0]}", flush=True)
            elif a[1] != b[1]:
                bad += 1
                print(f"MISMATCH-ROWS {k}: spark={a[1]} duck={b[1]}", flush=True)
            elif a[2] != b[2]:
                bad += 1
                diff = [x for x in a[3] if x not in set(b[3])][:3]
                diff2 = [x for x in b[3] if x not in set(a[3])][:3]
                print(f"MISMATCH-VALUES {k}: cols={a[0]}\n  spark: {diff}\n  duck:  {diff2}", flush=True)
            else:
                print(f"OK {k}: {a[1]} rows  {t1:.1f}s", flush=True)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR {k}: {type(e).__name__}: {str(e)[:600]}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()
    print(f"done: {len(keys)} keys, {bad} bad")


if __name__ == "__main__":
    main(sys.argv)
