"""Runs a Spark query and its checking SQL side by side."""

import datetime
import decimal
import math

import duckdb

from plumbline.catalog.views import TABLES


def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def both(spark_df, connection, sql):
    """(same, message)"""
    names = spark_df.columns
    left = _rows(names, [tuple(r) for r in spark_df.collect()])
    result = connection.execute(sql)
    other = [d[0] for d in result.description]
    right = _rows(other, result.fetchall())
    if sorted(names) != sorted(other):
        return False, f"columns {sorted(names)} != {sorted(other)}"
    if len(left) != len(right):
        return False, f"{len(left)} rows != {len(right)} rows; {left[:2]} {right[:2]}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return not wrong, f"{len(wrong)} of {len(left)} rows differ, columns {sorted(names)}: {wrong[:2]}"
