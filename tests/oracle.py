"""Compare a query with its SQL the way the outside check does."""

import glob
import os

import duckdb


def connect(sf_dir):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def spark_rows(frame):
    return rows_of(frame.columns, [tuple(r) for r in frame.collect()])


def sql_rows(db, sql):
    cursor = db.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())
