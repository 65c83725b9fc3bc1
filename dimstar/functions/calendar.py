"""Calendar column expressions (all JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import DAY_NAMES_IT, EASTER_DATES_IT, FIXED_HOLIDAYS_IT, MONTH_NAMES_IT


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: Column | str) -> Column:
    """int YYYYMMDD of a date or timestamp."""
    d = _c(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week(c: Column | str) -> Column:
    """1 = Monday .. 7 = Sunday (``dayofweek`` would start on Sunday)."""
    return (F.weekday(_c(c)) + 1).cast("int")


def week_label(c: Column | str) -> Column:
    """``%Y-W%W``: Monday weeks, days before the year's first Monday are week 00."""
    d = _c(c)
    week = F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7).cast("int")
    return F.concat(F.year(d).cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def _literal_map(pairs) -> Column:
    flat = []
    for k, v in pairs:
        flat += [F.lit(k), F.lit(v)]
    return F.create_map(*flat)


def month_name_it(c: Column | str) -> Column:
    return F.element_at(_literal_map(enumerate(MONTH_NAMES_IT, start=1)), F.month(_c(c)))


def day_name_it(c: Column | str) -> Column:
    return F.element_at(_literal_map(enumerate(DAY_NAMES_IT, start=1)), day_of_week(c))


def holiday_name_it(c: Column | str, variable_holidays: dict[str, str] | None = None) -> Column:
    """Variable (Easter-like) table first, then the fixed MM-DD table, else NULL."""
    d = _c(c)
    variable = dict(EASTER_DATES_IT if variable_holidays is None else variable_holidays)
    fixed = _literal_map(FIXED_HOLIDAYS_IT.items())
    fixed_hit = F.try_element_at(fixed, F.date_format(d, "MM-dd"))
    if not variable:
        return fixed_hit
    var_hit = F.try_element_at(_literal_map(variable.items()), F.date_format(d, "yyyy-MM-dd"))
    return F.coalesce(var_hit, fixed_hit)
