"""Comparing rows of two engines."""

from __future__ import annotations

from decimal import Decimal


def plain(value):
    """A value as text that is equal for equal values of both engines."""
    if isinstance(value, (float, Decimal)):
        return f"{float(value):.9g}"
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return "~" if value is None else str(value)


def same_rows(columns, rows, other_columns, other_rows) -> None:
    names = sorted(columns)
    assert names == sorted(other_columns)
    left = sorted(tuple(plain(r[columns.index(c)]) for c in names) for r in rows)
    right = sorted(tuple(plain(r[other_columns.index(c)]) for c in names) for r in other_rows)
    assert left == right


def against_oracle(spark, con, query, sql, sf_dir) -> int:
    found = query(spark, sf_dir)
    rows = [tuple(r) for r in found.collect()]
    answer = con.execute(sql)
    same_rows(found.columns, rows, [d[0] for d in answer.description], answer.fetchall())
    return len(rows)
