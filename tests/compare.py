"""Row comparison between a Spark DataFrame and a DuckDB query on the same files."""

import datetime as dt
import decimal
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(float(f"{value:.9g}"))
    if isinstance(value, decimal.Decimal):
        return f"D{value}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return sorted(columns), rows_of(columns, cur.fetchall())


def difference(df, con, sql):
    """None when equal, else a short account of the difference."""
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return f"columns {sc} != {dc}"
    if sr == dr:
        return None
    only_s = [r for r in sr if r not in set(dr)][:3]
    only_d = [r for r in dr if r not in set(sr)][:3]
    return f"rows {len(sr)} vs {len(dr)}; columns {sc}; only spark {only_s}; only duckdb {only_d}"
