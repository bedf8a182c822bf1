"""Hand-made frames."""

import datetime as dt


def days(n, start=dt.date(2024, 1, 1)):
    return [start + dt.timedelta(days=i) for i in range(n)]


def series(spark, values, start=dt.date(2024, 1, 1), name="a"):
    rows = [(name, d, None if v is None else float(v)) for d, v in zip(days(len(values), start), values)]
    return spark.createDataFrame(rows, "series_id string, date date, y double")


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def column(df, name, *order):
    return [r[name] for r in df.orderBy(*order).collect()]
