"""Comparing a query with its SQL in DuckDB."""

import datetime
import decimal

import duckdb

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def compare(spark, sf_dir, query, sql):
    """Rows of both, each as a sorted list of tuples in order of column names."""
    con = duckdb.connect()
    for n in NAMES:
        con.sql(f"create view {n} as select * from read_parquet('{sf_dir}/{n}.parquet')")
    df, other = query(spark, sf_dir), con.sql(sql)
    names = sorted(df.columns)
    assert sorted(other.columns) == names
    at, rows = [other.columns.index(n) for n in names], other.fetchall()
    return sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr), sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)
