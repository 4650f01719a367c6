"""Runs a query's DuckDB equivalent and compares rows regardless of order."""

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir=SF):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def _plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, list | tuple):
        return tuple(map(_plain, v))
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(_plain(r[k]) for k in order) for r in data), key=repr)


def assert_same(df, sql, sf_dir=SF):
    result = duck(sf_dir).sql(sql)
    assert sorted(df.columns) == sorted(result.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(result.columns, result.fetchall())
