"""Date parts and United States holidays as column rules (no calendar join needed)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SUNDAY, _MONDAY, _TUESDAY, _THURSDAY = 1, 2, 3, 5

# Holidays on a fixed day (month, day).
FIXED_DAY = {
    "NewYearsDay": (1, 1),
    "InaugurationDay": (1, 20),
    "LincolnsBirthday": (2, 12),
    "WashingtonsBirthdayTraditional": (2, 22),
    "Juneteenth": (6, 19),
    "IndependenceDay": (7, 4),
    "VeteransDay": (11, 11),
    "ChristmasDay": (12, 25),
}

# Holidays on the n-th weekday of a month (month, weekday, n); n = -1 is the last one.
NTH_WEEKDAY = {
    "MLKingsBirthday": (1, _MONDAY, 3),
    "PresidentsDay": (2, _MONDAY, 3),
    "MemorialDay": (5, _MONDAY, -1),
    "LaborDay": (9, _MONDAY, 1),
    "ColumbusDay": (10, _MONDAY, 2),
    "ElectionDay": (11, _TUESDAY, 1),
    "ThanksgivingDay": (11, _THURSDAY, 4),
}

US_HOLIDAYS = (*FIXED_DAY, *NTH_WEEKDAY, "GoodFriday")


def weekday_label(day: Column) -> Column:
    return F.date_format(day, "EEE")


def month_label(day: Column) -> Column:
    return F.date_format(day, "MMM")


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by the anonymous (Meeus/Jones/Butcher) computus."""

    def div(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b)).cast("int")

    golden = year % 19
    century, rest = div(year, 100), year % 100
    epact = (golden * 19 + century - div(century, 4) - div(century - div(century + 8, 25) + 1, 3) + 15) % 30
    to_sunday = ((century % 4) * 2 + div(rest, 4) * 2 + 32 - epact - rest % 4) % 7
    late = div(golden + epact * 11 + to_sunday * 22, 451)
    serial = epact + to_sunday - late * 7 + 114
    return F.make_date(year, div(serial, 31), serial % 31 + 1)


def is_holiday(day: Column, name: str) -> Column:
    """True on the named holiday."""
    date = day.cast("date")
    if name in FIXED_DAY:
        month, number = FIXED_DAY[name]
        hit = (F.month(date) == month) & (F.dayofmonth(date) == number)
        if name == "InaugurationDay":
            hit = hit & (F.year(date) % 4 == 1)
        return hit
    if name in NTH_WEEKDAY:
        month, weekday, nth = NTH_WEEKDAY[name]
        number = F.dayofmonth(date)
        if name == "ElectionDay":  # the Tuesday after the first Monday
            window = number.between(2, 8)
        elif nth < 0:
            window = number > F.dayofmonth(F.last_day(date)) - 7
        else:
            window = number.between(7 * nth - 6, 7 * nth)
        return (F.month(date) == month) & (F.dayofweek(date) == weekday) & window
    if name == "GoodFriday":
        return date == F.date_sub(easter_sunday(F.year(date)), 2)
    raise ValueError(f"unknown holiday {name!r}")


def holiday_flags(day: Column, names=US_HOLIDAYS) -> dict[str, Column]:
    """One 0/1 column per holiday; a missing date gives a missing flag."""
    return {name: is_holiday(day, name).cast("int") for name in names}
