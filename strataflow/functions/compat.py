"""Semantics that differ between warehouses, decided once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds per unit for boundary counting.
_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600}

MONEY = "decimal(18,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since the epoch of a timestamp with or without zone."""
    return F.unix_seconds(col(ts).cast("timestamp"))


def date_diff(unit: str, start: str | Column, end: str | Column) -> Column:
    """Number of unit boundaries between two times (00:59 to 01:01 is one hour)."""
    start, end = col(start), col(end)
    if unit == "day":
        return F.datediff(end.cast("date"), start.cast("date")).cast("long")
    if unit == "month":
        a, b = start.cast("date"), end.cast("date")
        return ((F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)).cast("long")
    width = _UNIT_SECONDS[unit]
    return (F.floor(epoch_seconds(end) / width) - F.floor(epoch_seconds(start) / width)).cast("long")


def date_add_unit(unit: str, n: int, start: str | Column) -> Column:
    """Shift a timestamp by n days, hours or minutes."""
    if unit not in ("day", "hour", "minute"):
        raise ValueError(unit)
    return col(start) + F.expr(f"INTERVAL {int(n)} {unit.upper()}")


def json_get(c: str | Column, path: str, dtype: str, strict: bool = True) -> Column:
    """Typed value at a JSON path of a VARIANT column; not strict turns bad values into null."""
    fn = F.variant_get if strict else F.try_variant_get
    return fn(col(c), path, dtype)


def money(c: str | Column) -> Column:
    """Exact money: doubles become decimals before any sum, so sums do not depend on order."""
    return col(c).cast(MONEY)


def dbl_sum(c: str | Column) -> Column:
    return F.sum(col(c)).cast("double")


def dbl_avg(c: str | Column) -> Column:
    """Mean of an exact column as sum / count in double: one rounding, no fixed-scale quotient."""
    return F.sum(col(c)).cast("double") / F.count(col(c))


def dbl_ratio(total: str | Column, n: str | Column) -> Column:
    """A mean out of a merged exact sum and count, null for none."""
    return col(total).cast("double") / F.nullif(col(n), F.lit(0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """part / whole in percent, null for an empty whole."""
    return F.round(part.cast("double") * F.lit(100.0) / F.nullif(whole, F.lit(0)), digits)


def flag_count(cond: Column) -> Column:
    """Conditional sum: rows where cond holds (null counts as no)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def ratio_or_zero(n: Column, d: Column, digits: int = 4) -> Column:
    """n / d rounded, or 0 where d is not positive."""
    return F.when(d > 0, F.round(n.cast("double") / d.cast("double"), digits)).otherwise(F.lit(0.0))


def day_text(c: str | Column) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")


def second_text(c: str | Column) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss")
