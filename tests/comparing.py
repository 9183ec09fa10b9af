"""Comparing a query's rows with those of its SQL in DuckDB."""

import datetime
import glob
import math
import os


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def views(sf_dir):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(plain(v) for v in r) for r in df.select(*cols).collect())


def sql_rows(con, sql):
    c = con.execute(sql)
    names = [x[0] for x in c.description]
    order = [names.index(n) for n in sorted(names)]
    return sorted(names), sorted(tuple(plain(r[i]) for i in order) for r in c.fetchall())
