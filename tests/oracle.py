"""Comparing a query's rows with its DuckDB counterpart."""

import math
import os

import duckdb


def cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, list | tuple):
        return tuple(cell(x) for x in v)
    return v


def rows_of_spark(df):
    columns = sorted(df.columns)
    return columns, sorted(repr(tuple(cell(r[c]) for c in columns)) for r in df.collect())


def rows_of_duckdb(sql, sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(repr(tuple(cell(r[i]) for i in order)) for r in cursor.fetchall())
