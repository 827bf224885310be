"""Money labels and the cost-of-turnover formula."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit name -> divisor, for value labels.
UNITS = {"0": 1.0, "K": 1e3, "M": 1e6}

# Default inputs of the turnover cost.
TURNOVER_DEFAULTS = {
    "salary": 80000,
    "separation_cost": 500,
    "vacancy_cost": 10000,
    "acquisition_cost": 4900,
    "placement_cost": 3500,
    "net_revenue_per_employee": 250000,
    "workdays_per_year": 240,
    "workdays_position_open": 40,
    "workdays_onboarding": 60,
    "onboarding_efficiency": 0.5,
}


def turnover_cost(n: Column | float = 1, **inputs) -> Column:
    """Yearly cost of ``n`` people leaving.

    One leaver costs the one-off payments, plus the revenue lost on the days
    the position is empty or only partly effective, minus the salary saved
    while it is empty. Any input may be a number or a column.
    """
    unknown = set(inputs) - set(TURNOVER_DEFAULTS)
    if unknown:
        raise TypeError(f"unknown inputs: {sorted(unknown)}")
    given = {**TURNOVER_DEFAULTS, **inputs}
    v = {k: (x if isinstance(x, Column) else F.lit(float(x))) for k, x in given.items()}
    one_off = v["separation_cost"] + v["vacancy_cost"] + v["acquisition_cost"] + v["placement_cost"]
    lost_days = v["workdays_position_open"] + v["workdays_onboarding"] * v["onboarding_efficiency"]
    lost = F.try_divide(v["net_revenue_per_employee"], v["workdays_per_year"]) * lost_days
    saved = F.try_divide(v["salary"], v["workdays_per_year"]) * v["workdays_position_open"]
    heads = n if isinstance(n, Column) else F.lit(float(n))
    return heads * (one_off + lost - saved)


def money(col: Column, digits: int = 0, unit: str = "0", prefix: str = "$", suffix: str = "") -> Column:
    """``$1,234``, ``$1.6M``, ``-$5K``: sign, prefix, grouped digits, unit."""
    scaled = col.cast("double") / F.lit(UNITS[unit])
    sign = F.when(scaled < 0, F.lit("-")).otherwise(F.lit(""))
    tail = ("" if unit == "0" else unit) + suffix
    return F.concat(sign, F.lit(prefix), F.format_number(F.abs(scaled), digits), F.lit(tail))


def needs_cents(col: Column, limit: float = 1e3) -> Column:
    """Aggregate: true when some value has a fraction and none is above ``limit``."""
    return (F.max(F.abs(col)) <= F.lit(limit)) & F.max(col != F.floor(col))
