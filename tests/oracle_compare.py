"""Run registered queries in Spark and their SQL in DuckDB; compare the results.

Used by the tests and runnable by hand:
    python tests/oracle_compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, datetime.date) and not isinstance(v, datetime.datetime):
        return datetime.datetime(v.year, v.month, v.day)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return v.item()
        except Exception:
            return v
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return False, f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"row count {len(spark_pdf)} vs {len(duck_pdf)}"
    a, b = rows_of(spark_pdf), rows_of(duck_pdf)
    cols = sorted(spark_pdf.columns)
    exact = True
    for ra, rb in zip(a, b):
        if ra != rb:
            exact = False
            for c, x, y in zip(cols, ra, rb):
                if x != y:
                    close = (isinstance(x, float) and isinstance(y, float)
                             and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9))
                    return False, f"first diff col={c}: {x!r} vs {y!r} (close={close}) row={ra}"
    return exact, "ok"


def run(spark, sf_dir: str, names=None, verbose=True) -> dict[str, str]:
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # report and continue
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:600]}"
            if verbose:
                print(f"{name:28s} {results[name]}", flush=True)
            continue
        t1 = time.time()
        if name not in sqls:
            results[name] = f"rows-only ({len(sp)} rows)"
        else:
            try:
                # through a view, as the statement must also work there
                con.execute(f"CREATE OR REPLACE VIEW oracle_result AS {sqls[name]}")
                dk = con.execute("SELECT * FROM oracle_result").df()
                ok, msg = compare(sp, dk)
                results[name] = "MATCH" if ok else f"MISMATCH {msg}"
            except Exception as e:
                results[name] = f"DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}"
        if verbose:
            print(f"{name:28s} {t1 - t0:6.2f}s  {results[name]}", flush=True)
    return results


if __name__ == "__main__":
    from clientele.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    res = run(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not (v == "MATCH" or v.startswith("rows-only"))]
    print("FAILED:", bad)
