"""Comparison of a Spark query with its SQL in DuckDB, as multisets of rows."""

import glob
import os

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def canonical(value) -> str:
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(canonical, value)) + "]"
    return repr(value + 0.0) if isinstance(value, float) else repr(value)


def assert_same(frame, relation) -> None:
    names = sorted(frame.columns)
    assert names == sorted(relation.columns)
    ours = sorted(tuple(canonical(r[n]) for n in names) for r in frame.collect())
    theirs = sorted(tuple(canonical(r[relation.columns.index(n)]) for n in names) for r in relation.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs
