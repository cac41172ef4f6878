"""Value lookups: decode tables, spelling groups, first-match rule lists."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode(c, mapping: Mapping, default=None) -> Column:
    """``mapping[c]``, or ``default`` (a value or a column) where the key is missing."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), as_col(c))
    if default is None:
        return found
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def canonical(c, groups: Mapping[str, Iterable[str]], contains: Mapping[str, str] | None = None) -> Column:
    """Fold many spellings into one name; values outside every group stay as they are.

    ``contains`` folds by substring and is tried after the exact groups.
    """
    col = as_col(c)
    exact = {spelling: name for name, spellings in groups.items() for spelling in spellings}
    rest = col
    for needle, name in (contains or {}).items():
        rest = F.when(col.contains(needle), F.lit(name)).otherwise(rest)
    return decode(col, exact, rest) if exact else rest


def first_match(arms: Iterable[tuple[Column, object]], default=None) -> Column:
    """Searched CASE from a list: the first true arm wins, no arm gives ``default``."""
    out = None
    for cond, value in arms:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    if out is None:
        return F.lit(default)
    if default is None:
        return out
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))
