"""Column expressions that several operators share. Undefined values are null, never NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b as a double; null where b is 0 or null."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def month_number(date: str | Column) -> Column:
    """Months since year 0, so that differences are calendar months."""
    return F.year(col(date)) * 12 + F.month(col(date))


def month_start(ts: str | Column) -> Column:
    return F.trunc(col(ts).cast("date"), "month")


def cv(value: str | Column) -> Column:
    """Population standard deviation by mean; null for fewer than two values or a zero mean."""
    return F.when(F.count(col(value)) > 1, F.try_divide(F.stddev_pop(col(value)), F.avg(col(value))))


def metric_id(name: str | Column) -> Column:
    """Canonical snake-case id."""
    return F.trim(F.regexp_replace(F.lower(col(name)), r"[^a-z0-9]+", "_"), F.lit("_"))
