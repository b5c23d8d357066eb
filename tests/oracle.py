"""Compare a registered query with its SQL in DuckDB."""

import decimal
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if v != v else float(f"{float(v):.8g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return float(v) if isinstance(v, int) and not isinstance(v, bool) else v


def same(df, con, sql):
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted(repr([plain(r[names.index(c)]) for c in order]) for r in result.fetchall())
    got = sorted(repr([plain(r[c]) for c in order]) for r in df.collect())
    assert got == want
