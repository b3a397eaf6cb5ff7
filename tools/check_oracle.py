"""Run registered Spark queries and their DuckDB oracle side by side and
compare row counts, column names and values (order-insensitive)."""

from __future__ import annotations

import math
import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from ratelens.plans.queries_all import ORACLE, QUERIES  # noqa: E402
from ratelens.session import get_spark  # noqa: E402
from ratelens.sources.driver import DRIVER_TABLES, table_path  # noqa: E402


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        text = str(v)
        if len(text) > 10 and text[10:19] in (" 00:00:00", "T00:00:00") and text[19:].strip("0.") == "":
            return text[:10]
        return text[:26].replace("T", " ")
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(norm(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def main(names, sf="/root/testdata/sf0.01"):
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf, t)}')")
    names = names or sorted(QUERIES)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            spdf = QUERIES[name](spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:400]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in ORACLE:
            print(f"ROWS {name}: {len(spdf)} rows (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            ddf = con.execute(ORACLE[name]).fetchdf()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:600]}")
            bad += 1
            continue
        sc, sr = rows_of(spdf)
        dc, dr = rows_of(ddf)
        if sc != dc:
            print(f"FAIL {name}: columns spark={sc} duck={dc}")
            bad += 1
            continue
        if sr != dr:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
            print(f"FAIL {name}: rows spark={len(sr)} duck={len(dr)} first diffs={diff}")
            bad += 1
            continue
        print(f"OK   {name}: {len(sr)} rows {t1 - t0:.1f}s")
    print(f"{bad} failing of {len(names)}")


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if not a.startswith("--sf=")]
    sfs = [a[5:] for a in sys.argv[1:] if a.startswith("--sf=")]
    main(args, *(sfs or []))
