"""Compare a query's rows with those of its SQL twin run by DuckDB."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """(spark rows, sql rows, first differences); no differences means equal."""
    res = con.execute(sql)
    sql_cols, sql_rows = [d[0] for d in res.description], res.fetchall()
    if sorted(df.columns) != sorted(sql_cols):
        return 0, len(sql_rows), [("columns", sorted(df.columns), sorted(sql_cols))]
    a = rows_of(df.columns, [tuple(r) for r in df.collect()])
    b = rows_of(sql_cols, sql_rows)
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    diff = [("spark", x) for x in only_a[:2]] + [("sql", x) for x in only_b[:2]]
    if not diff and a != b:
        diff = [("row multiplicity", len(a), len(b))]
    return len(a), len(b), diff
