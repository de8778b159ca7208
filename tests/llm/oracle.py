"""Runs a query and its SQL side by side."""

import glob
import os

import duckdb

TABLES = "documents pages benchmark labels conversations embeddings".split()


def sql_rows(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if glob.glob(f"{sf_dir}/{t}.parquet*"):
            path = f"{sf_dir}/{t}.parquet"
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    out = con.execute(sql)
    names = [d[0] for d in out.description]
    return names, out.fetchall()


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def same(df, sql, sf_dir):
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    want = canonical(*sql_rows(sql, sf_dir))
    assert got[0] == want[0]
    assert got[1] == want[1]
