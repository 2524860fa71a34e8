"""Run a query and its SQL on the same tables and compare the rows."""

import decimal
import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(p).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{p}{'/*' if os.path.isdir(p) else ''}')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    return v


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in values), key=repr)


def assert_same(df, con, sql):
    found = con.execute(sql)
    expected = rows([d[0] for d in found.description], found.fetchall())
    assert rows(df.columns, df.collect()) == expected
