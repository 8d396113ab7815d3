"""Rows of a query against DuckDB's, whatever their order."""

import decimal
import os

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return None if v != v else round(v, 5)
    if isinstance(v, decimal.Decimal):
        return norm(float(v))
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def both(df, con, sql):
    """(columns and sorted rows of Spark, the same of DuckDB)."""
    rel = con.execute(sql)
    names = [x[0] for x in rel.description]
    theirs = [dict(zip(names, r, strict=True)) for r in rel.fetchall()]
    mine = [r.asDict() for r in df.collect()]
    form = lambda rows, cols: (sorted(cols), sorted(repr(tuple(norm(r[c]) for c in sorted(cols))) for r in rows))
    return form(mine, df.columns), form(theirs, names)
