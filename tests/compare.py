"""Run a query in Spark and its SQL in DuckDB, and compare schemas and values."""

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def kind(value):
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, decimal.Decimal):
        return "decimal"
    return type(value).__name__


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    lines = [tuple(row[i] for i in order) for row in rows]
    kinds = {n: {kind(line[j]) for line in lines} - {"NoneType"} for j, n in enumerate(names)}
    values = sorted((tuple(map(normal, line)) for line in lines), key=repr)
    return names, kinds, values


def differences(df, sql, folder):
    """Empty when both results are equal."""
    got = table(df.columns, [tuple(r) for r in df.collect()])
    result = connect(folder).execute(sql)
    columns = [d[0] for d in result.description]
    want = table(columns, result.fetchall())
    found = []
    if got[0] != want[0]:
        return [f"columns {got[0]} instead of {want[0]}"]
    if got[1] != want[1]:
        found += [
            f"{n}: {got[1][n]} instead of {want[1][n]}"
            for n in got[0]
            if got[1][n] != want[1][n]
        ]
    if len(got[2]) != len(want[2]):
        found.append(f"{len(got[2])} rows instead of {len(want[2])}")
    if got[2] != want[2]:
        extra, missing = set(got[2]) - set(want[2]), set(want[2]) - set(got[2])
        found.append(f"columns {got[0]}")
        found.append(f"extra {sorted(extra, key=repr)[:3]}")
        found.append(f"missing {sorted(missing, key=repr)[:3]}")
    return found
