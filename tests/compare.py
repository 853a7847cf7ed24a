"""Compare queries with their SQL counterparts: columns by name, rows in any order."""

import datetime

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def database(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _cell(value):
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return repr(value)


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_by_name(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(db, sql):
    result = db.execute(sql)
    return rows_by_name([d[0] for d in result.description], result.fetchall())
