"""Spark result vs DuckDB oracle: row count, column names, order-insensitive
value hash. Used by the tests and the local check script."""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math

from carelake.sources.tables import TABLE_NAMES


def duckdb_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        r = round(f, digits)
        return 0.0 if r == 0 else r
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def digest(cols: list[str], rows: list[tuple], digits: int = 6) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    normed = sorted(repr(tuple(_norm(r[i], digits) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(normed).encode()).hexdigest()
    return len(rows), h


def spark_rows(df):
    return list(df.columns), [tuple(r) for r in df.collect()]


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, [tuple(r) for r in cur.fetchall()]


def compare(df, sql: str, con, digits: int = 6) -> dict:
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    out = {"spark_rows": len(sr), "oracle_rows": len(dr),
           "columns_match": sorted(sc) == sorted(dc), "spark_cols": sc, "oracle_cols": dc}
    if out["columns_match"]:
        dr2 = [tuple(r[dc.index(c)] for c in sc) for r in dr]
        out["hash_match"] = digest(sc, sr, digits) == digest(sc, dr2, digits)
        if not out["hash_match"]:
            a = sorted(repr(tuple(_norm(v, digits) for v in r)) for r in sr)
            b = sorted(repr(tuple(_norm(v, digits) for v in r)) for r in dr2)
            sa, sb = set(a), set(b)
            out["only_spark"] = [x for x in a if x not in sb][:3]
            out["only_oracle"] = [x for x in b if x not in sa][:3]
    else:
        out["hash_match"] = False
    out["ok"] = out["columns_match"] and out["hash_match"] and len(sr) == len(dr)
    return out
