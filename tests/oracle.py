"""Compares a query with its SQL, as rows without order."""

import datetime
import decimal
import math
import os


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)):
        name = f.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    return con


def value(x):
    if isinstance(x, (list, tuple)) or type(x).__name__ == "ndarray":
        return tuple(value(v) for v in x)
    if isinstance(x, (float, decimal.Decimal)) and not isinstance(x, bool):
        return "nan" if math.isnan(x) else round(float(x), 5) + 0.0
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    return x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(value(r[i]) for i in order) for r in data), key=repr)


def compare(con, df, sql):
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names), (df.columns, names)
    a, b = rows(df.columns, df.collect()), rows(names, want.fetchall())
    assert len(a) == len(b), (len(a), len(b))
    for x, y in zip(a, b, strict=True):
        assert x == y, (x, y)
    return len(a)
