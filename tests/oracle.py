"""Runs a query on Spark and its SQL on DuckDB and compares the rows."""

from pathlib import Path

import duckdb


def connect(sf_dir):
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return db


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(str(r[i]) for i in order) for r in data)


def compare(df, db, sql):
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(sql)
    want = rows([c[0] for c in result.description], result.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    return len(got[1])
