"""Compare a registered query with its SQL twin."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql):
    """Returns (spark rows, oracle rows, differences)."""
    result = con.execute(sql)
    sql_columns = [d[0] for d in result.description]
    want = rows_of(sql_columns, result.fetchall())
    got = rows_of(df.columns, df.collect())
    assert sorted(df.columns) == sorted(sql_columns), (df.columns, sql_columns)
    return got, want, [(g, w) for g, w in zip(got, want) if g != w]
