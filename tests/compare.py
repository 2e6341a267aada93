"""Results of Spark and of DuckDB as sorted rows, columns by name."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return c


def _plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda k: cols[k])
    return sorted(cols), sorted((tuple(_plain(r[k]) for k in order) for r in data), key=repr)


def both(spark, sf_dir, query, sql, con=None):
    df = query(spark, sf_dir)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    r = (con or duck(sf_dir)).execute(sql)
    return mine, rows([d[0] for d in r.description], r.fetchall())
