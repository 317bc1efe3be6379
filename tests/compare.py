"""Order-insensitive result comparison (column names sorted, values normalised)."""

from __future__ import annotations

import datetime as dt
import decimal
import math


def norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    res = con.execute(sql)
    return [d[0] for d in res.description], res.fetchall()


def assert_same(spark_result, duck_result, label=""):
    scols, srows = spark_result
    dcols, drows = duck_result
    assert sorted(scols) == sorted(dcols), f"{label}: columns differ {sorted(scols)} vs {sorted(dcols)}"
    assert len(srows) == len(drows), f"{label}: row counts differ {len(srows)} vs {len(drows)}"
    a, b = canonical(scols, srows), canonical(dcols, drows)
    if a != b:
        only_s = [r for r in a if r not in set(b)][:3]
        only_d = [r for r in b if r not in set(a)][:3]
        raise AssertionError(f"{label}: values differ\n spark-only {only_s}\n duck-only {only_d}")
