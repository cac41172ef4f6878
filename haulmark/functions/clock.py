"""Time helpers. The present moment is always an argument, never the wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from haulmark.functions.lookup import as_col

# Fixed value: local time is stored as UTC moved by this many minutes.
LOCAL_SHIFT_MINUTES = 330


def moment(as_of) -> Column:
    """A literal (or column) as timestamp without zone."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (dt.date, dt.datetime)):
        as_of = as_of.isoformat(sep=" ") if isinstance(as_of, dt.datetime) else as_of.isoformat()
    return F.lit(str(as_of)).cast("timestamp_ntz")


def plus(c, *, days: int = 0, hours: int = 0, minutes: int = 0) -> Column:
    """Shift by a whole number of minutes."""
    total = days * 1440 + hours * 60 + minutes
    sign = "-" if total < 0 else ""
    return as_col(c) + F.expr(f"INTERVAL '{sign}{abs(total)}' MINUTE")


def to_local(c, shift_minutes: int = LOCAL_SHIFT_MINUTES) -> Column:
    return plus(c, minutes=shift_minutes)


def day(c) -> Column:
    return F.date_trunc("day", as_col(c)).cast("timestamp_ntz")


def week(c) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", as_col(c)).cast("timestamp_ntz")


def month(c) -> Column:
    return F.date_trunc("month", as_col(c)).cast("timestamp_ntz")


def months_before(c, months: int, days: int = 0) -> Column:
    """Calendar months first, then days."""
    return as_col(c) - F.make_ym_interval(F.lit(0), F.lit(months)) - F.make_dt_interval(F.lit(days))


def in_month(c, first_day) -> Column:
    """Half-open range test, so that file and partition pruning apply."""
    lo = month(moment(first_day))
    return (as_col(c) >= lo) & (as_col(c) < lo + F.make_ym_interval(F.lit(0), F.lit(1)))


def in_week(c, first) -> Column:
    lo = week(moment(first))
    return (as_col(c) >= lo) & (as_col(c) < plus(lo, days=7))


def hours_between(later, earlier) -> Column:
    """Fractional hours; negative when the order is reversed."""
    return F.timestamp_diff("MICROSECOND", as_col(earlier), as_col(later)) / F.lit(3.6e9)


def days_between(later, earlier) -> Column:
    """Calendar days, as ``date - date``."""
    return F.datediff(as_col(later), as_col(earlier))


def whole_days(later, earlier) -> Column:
    """Elapsed time cut to full 24-hour days."""
    return F.floor(F.timestamp_diff("MICROSECOND", as_col(earlier), as_col(later)) / F.lit(8.64e10)).cast("int")


def hour(c) -> Column:
    return F.hour(as_col(c))


# The three slot rules in use, as (hour, is the hour itself late, early name, late name).
SLOT_RULES = {
    "program": (12, False, "Morning", "Evening"),
    "productivity": (12, True, "Morning", "Afternoon"),
    "payout": (15, True, "morning", "evening"),
}


def slot_of(c, rule: str = "program") -> Column:
    bound, inclusive, early, late = SLOT_RULES[rule]
    is_late = hour(c) >= bound if inclusive else hour(c) > bound
    unknown = early if inclusive else late
    return F.when(is_late, late).when(as_col(c).isNull(), unknown).otherwise(early)


# Orders before this hour are due the same day, later ones at noon of the next day.
CUTOFF_HOUR, SAME_DAY_DUE_HOUR, NEXT_DAY_DUE_HOURS = 15, 17, 36


def cutoff(c) -> Column:
    """Warehouse cut-off moment for a given assignment time."""
    due = F.when(hour(c) < CUTOFF_HOUR, F.lit(SAME_DAY_DUE_HOUR)).otherwise(F.lit(NEXT_DAY_DUE_HOURS))
    return day(c) + F.make_dt_interval(F.lit(0), due)
