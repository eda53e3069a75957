"""Row comparison between Spark and DuckDB results."""

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()
TESTDATA = "/root/testdata"


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    return value


def order(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def rows_of(columns, rows):
    """Rows with their columns sorted by name, in one fixed order."""
    index = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in index) for r in rows), key=order)


def duck(folder):
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(folder, f"{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


FAMILIES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "decimal(5,2)": "DECIMAL(5,2)",
}
