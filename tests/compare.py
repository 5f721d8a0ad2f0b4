"""Compare a Spark result with the checking engine's, order-insensitively."""

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def cell(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        return "nan" if math.isnan(f) else repr(f)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in data)


def compare(df, con, sql):
    """(same, message, number of rows)."""
    cur = con.execute(sql)
    want_names, want = rows([c[0] for c in cur.description], cur.fetchall())
    got_names, got = rows(df.columns, [tuple(r) for r in df.collect()])
    if got_names != want_names:
        return False, f"columns {got_names} <> {want_names}", len(got)
    if got != want:
        extra = sorted(set(got) - set(want))[:3]
        lack = sorted(set(want) - set(got))[:3]
        return False, f"{len(got)} rows <> {len(want)}; only spark {extra}; only sql {lack}", len(got)
    return True, "", len(got)
