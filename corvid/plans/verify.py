"""Run registered queries against their DuckDB oracles (the correctness gate, locally).

    python -m corvid.plans.verify [--sf DIR] [name ...]

Both results are brought to pandas, columns sorted by name, floats rounded, and the
multisets of rows compared.
"""

from __future__ import annotations

import argparse
import math
import sys
import time

import duckdb
import pandas as pd

from corvid.sources.tables import TABLES

ROUND = 6


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_value(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, ROUND)
        return 0.0 if r == 0 else r
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm_value(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    return str(v) if not isinstance(v, (str, bytes)) else v


def normalise(pdf: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm_value(v) for v in row) for row in pdf[cols].itertuples(index=False, name=None)]
    rows.sort(key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))
    return cols, rows


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    c1, r1 = normalise(spark_pdf)
    c2, r2 = normalise(duck_pdf)
    if c1 != c2:
        return False, f"columns differ: spark={c1} duck={c2}"
    if len(r1) != len(r2):
        return False, f"row count spark={len(r1)} duck={len(r2)}"
    diffs = [(a, b) for a, b in zip(r1, r2) if a != b]
    if diffs:
        a, b = diffs[0]
        return False, f"{len(diffs)} rows differ, first: spark={a} duck={b}"
    return True, f"{len(r1)} rows"


def dtype_differences(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> dict:
    """Columns whose pandas dtypes differ between the two results (schema check)."""
    out = {}
    for c in spark_pdf.columns:
        if c in duck_pdf.columns:
            a, b = str(spark_pdf[c].dtype), str(duck_pdf[c].dtype)
            if a != b:
                out[c] = (a, b)
    return out


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--plain-session", action="store_true",
                    help="use a default SparkSession (no corvid settings), as an external driver would")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)

    from corvid.plans.registry import all_oracles, all_queries
    from corvid.session import build_session, scratch_scope

    if args.plain_session:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    queries, oracles = all_queries(), all_oracles()
    con = duck_connect(args.sf)
    names = args.names or list(queries)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            with scratch_scope(spark):
                spdf = queries[name](spark, args.sf).toPandas()
        except Exception as exc:  # report and continue
            bad += 1
            print(f"FAIL  {name}: spark error {type(exc).__name__}: {str(exc)[:300]}")
            continue
        t1 = time.time()
        if name not in oracles:
            print(f"ROWS  {name}: {len(spdf)} rows ({t1 - t0:.1f}s, no oracle)")
            continue
        try:
            dpdf = con.execute(oracles[name]).df()
        except Exception as exc:
            bad += 1
            print(f"FAIL  {name}: duckdb error {str(exc)[:300]}")
            continue
        ok, msg = compare(spdf, dpdf)
        bad += not ok
        types = dtype_differences(spdf, dpdf)
        if types:
            msg += f"; dtypes differ: {types}"
        print(f"{'OK  ' if ok else 'FAIL'}  {name}: {msg} ({t1 - t0:.1f}s)")
    print(f"{len(names) - bad}/{len(names)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
