"""Ratios rounded half away from zero on exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(24,2)"


def ratio(num: Column, den: Column, digits: int, times: int = 1) -> Column:
    """``times * num / den`` to ``digits`` places; NULL when ``den`` is 0 or NULL."""
    top = F.lit(times).cast("decimal(3,0)") * num.cast(MONEY)
    bottom = F.nullif(den.cast(MONEY), F.lit(0).cast(MONEY))
    return F.round(top / bottom, digits).cast(f"decimal(18,{digits})")


def percent(num: Column, den: Column, digits: int = 1) -> Column:
    return ratio(num, den, digits, times=100)


def change_pct(now: Column, before: Column, digits: int = 1) -> Column:
    """Percentage change from ``before`` to ``now``."""
    return percent(now.cast(MONEY) - before.cast(MONEY), before, digits)
