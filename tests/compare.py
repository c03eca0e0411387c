"""Order-insensitive comparison of query results (columns sorted by name)."""

import datetime as dt
import decimal
import math
from collections import Counter


def norm(v, digits=None):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return round(v, digits) if digits is not None else v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, digits) for x in v)
    return v


def multiset(cols, rows, digits=None):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i], digits) for i in order) for r in rows)


def same(cols_a, rows_a, cols_b, rows_b, digits=None):
    return sorted(cols_a) == sorted(cols_b) and multiset(cols_a, rows_a, digits) == multiset(cols_b, rows_b, digits)
