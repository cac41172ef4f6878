"""Numeric helpers: null-safe ratios, PostgreSQL rounding, distance, weight."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from haulmark.functions.lookup import as_col

# Fixed values.
EARTH_RADIUS_KM = 6371.0088
VOLUME_PER_GRAM = 5000.0


def ratio(num, den) -> Column:
    """Double division; a zero denominator gives null."""
    d = as_col(den).cast("double")
    return as_col(num).cast("double") / F.nullif(d, F.lit(0.0))


def int_ratio(num, den) -> Column:
    """Whole-number division; a zero denominator gives null."""
    return F.call_function("div", as_col(num).cast("bigint"), F.nullif(as_col(den).cast("bigint"), F.lit(0).cast("bigint")))


def truncate(c, digits: int = 0) -> Column:
    """Cut decimals without binary surprises (0.29 * 100 is 29)."""
    scale = 10 ** digits
    exact = as_col(c).cast("decimal(38,15)") * F.lit(scale).cast("decimal(10,0)")
    whole = F.when(exact < 0, F.ceil(exact)).otherwise(F.floor(exact))
    return whole.cast("double") / scale


def round_to_int(c) -> Column:
    """Double to whole number, halves to even."""
    return F.rint(as_col(c)).cast("int")


def round_half_even(c, digits: int = 2) -> Column:
    return F.bround(as_col(c), digits)


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle distance in kilometres."""
    a1, o1, a2, o2 = (F.radians(as_col(c)) for c in (lat1, lng1, lat2, lng2))
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def chargeable_weight(declared, volume, weight) -> Column:
    """The largest of declared, volumetric and measured weight; nulls are skipped."""
    return F.greatest(as_col(declared).cast("double"), as_col(volume).cast("double") / VOLUME_PER_GRAM,
                      as_col(weight).cast("double"))


def metres_to_km(c) -> Column:
    return as_col(c).try_cast("double") / 1000.0


def seconds_to_minutes(c) -> Column:
    return as_col(c).try_cast("double") / 60.0


def money(c) -> Column:
    """Exact two-place amount, so that sums do not depend on row order."""
    return as_col(c).cast("decimal(18,2)")


def exact_sum(c, places: int = 2) -> Column:
    """Sum in whole hundredths: the result does not depend on row or task order."""
    scale = 10 ** places
    return F.sum(F.rint(as_col(c).cast("double") * scale).cast("bigint")) / F.lit(float(scale))
