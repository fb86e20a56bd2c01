from __future__ import annotations

import datetime as dt


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def daily(spark, values, start="2001-01-01", key="a", skip=()):
    """Daily series of one key; None is missing, skipped positions have no row."""
    first = day(start)
    rows = [(key, first + dt.timedelta(days=n), None if v is None else float(v)) for n, v in enumerate(values) if n not in skip]
    return spark.createDataFrame(rows, "k string, d date, t double")


def column(df, name, order="d"):
    return [r[name] for r in df.orderBy(order).collect()]


def close(ours, theirs, tol=1e-9):
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        assert (a is None) == (b is None), (ours, theirs)
        if a is not None:
            assert abs(a - b) <= tol * max(1.0, abs(b)), (a, b)
