"""Runs a registered query and its SQL side by side."""

import os

DATA = "/root/testdata/sf0.001"


def views():
    import duckdb

    con = duckdb.connect()
    for name in sorted(os.listdir(DATA)):
        path = f"{DATA}/{name}"
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}/*.parquet')" if os.path.isdir(path) else f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([r[i] for i in order]) for r in records)


def same(con, query, sql, spark):
    df = query(spark, DATA)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows(names, answer.fetchall())
    return len(got)
