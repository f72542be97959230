"""Compare a query with its SQL run by DuckDB over the same tables."""

import os

import duckdb
import numpy as np
import pandas as pd


def rows(df):
    df = df[sorted(df.columns)]

    def show(x):
        if pd.isna(x):
            return "~"
        if isinstance(x, (int, float, np.number)) and not isinstance(x, (bool, np.bool_)):
            return repr(round(float(x), 6))
        return str(x)

    return sorted(tuple(map(show, r)) for r in df.itertuples(index=False))


def sql(sf, text):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    return con.execute(text).df()


def same(spark, sf, query, text):
    a, b = query(spark, sf).toPandas(), sql(sf, text)
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)
