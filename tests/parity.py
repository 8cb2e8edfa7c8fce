"""Rows of a Spark query and of its SQL twin, made comparable."""

import math

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, (float, np.floating)):
        # whole numbers with nulls among them come as floats from one side and as integers from the other
        return None if math.isnan(v) else int(v) if float(v).is_integer() else round(float(v), 6)
    if isinstance(v, np.bool_):
        return bool(v)
    if isinstance(v, np.integer):
        return int(v)
    if isinstance(v, (list, np.ndarray)):
        return tuple(map(plain, v))
    return v


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(plain, r)) for r in frame.astype(object).itertuples(index=False)), key=repr)


def compare(spark, folder, query, sql):
    df = query(spark, folder)
    types = {c: TYPES.get(t, t) for c, t in df.dtypes}
    relation = connect(folder).sql(sql)
    assert types == dict(zip(relation.columns, map(str, relation.types)))
    assert rows(df.toPandas()) == rows(relation.df())
