"""Runs a query in Spark and its SQL twin in DuckDB and compares them like the driver."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings rebates_staging rebates incentive energy_star_raw dsire_program review_labels containers source_rank".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.6g}"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str:
    """Empty if both agree, else what differs."""
    a = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    b = rows_of(list(rel.columns), rel.fetchall())
    if a[0] != b[0]:
        return f"columns {a[0]} against {b[0]}"
    if a[1] != b[1]:
        only = [x for x in set(a[1]) - set(b[1])][:3], [x for x in set(b[1]) - set(a[1])][:3]
        return f"{len(a[1])} rows against {len(b[1])}; only here {only[0]}; only there {only[1]}"
    return ""
