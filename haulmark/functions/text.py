"""String helpers with PostgreSQL-compatible results."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from haulmark.functions.lookup import as_col

# The marks that may surround an amount written as text.
MONEY_MARKS = "[₹,\\s]"
CURRENCY_SIGN = "₹"
# Fixed pattern: thousands first, then groups of two (12,34,567).
INDIAN_GROUPS = r"(?<=\d)(?=(\d{2})+\d{3}$)|(?<=\d)(?=\d{3}$)"


def part(c, separator: str, n: int) -> Column:
    """The n-th piece (1-based), trimmed; a missing piece is the empty string."""
    return F.trim(F.split_part(as_col(c), F.lit(separator), F.lit(n)))


def substring(c, start: int, length: int | None = None) -> Column:
    """``substring`` where positions before the first character use up length."""
    col = as_col(c)
    if length is None:
        return F.substring(col, max(start, 1), 2147483647)
    if start < 1:
        length = max(length + start - 1, 0)
        start = 1
    return F.substring(col, start, length)


def position(c, needle: str) -> Column:
    """1-based place of the needle, 0 when absent."""
    return F.instr(as_col(c), needle)


def between_marks(c, opening: str, closing: str, skip: int = 0) -> Column:
    """Text after the first ``opening`` up to the first ``closing``.

    ``skip`` drops further characters after the opening mark. Null when either
    mark is missing or they come in the wrong order.
    """
    col = as_col(c)
    begin = position(col, opening) + len(opening) + skip
    size = position(col, closing) - begin
    both = (position(col, opening) > 0) & (position(col, closing) > 0) & (size >= 0)
    return F.when(both, F.substring(col, begin, size))


def join_skip_null(*cols) -> Column:
    """Concatenation that ignores nulls, as ``concat(...)`` does in PostgreSQL."""
    return F.concat_ws("", *[as_col(c) for c in cols])


def join_strict(*cols) -> Column:
    """Concatenation that is null when any piece is, as ``||`` does."""
    return F.concat(*[as_col(c) for c in cols])


def date_text(c, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(as_col(c), fmt)


def month_start(name, year) -> Column:
    """First day of a month given by its English name and a year."""
    return F.to_date(F.concat(F.initcap(F.trim(as_col(name))), F.lit(" 1, "),
                              as_col(year).cast("string")), "MMMM d, yyyy")


def parse_timestamp_text(c) -> Column:
    """Timestamp held as text, whole seconds only."""
    return F.to_timestamp_ntz(F.substring(as_col(c).cast("string"), 1, 19), F.lit("yyyy-MM-dd HH:mm:ss"))


def percent_text(c) -> Column:
    """Whole percentage right-aligned in four places, then ``%``."""
    whole = F.rint(as_col(c)).cast("bigint").cast("string")
    return F.concat(F.lpad(whole, 4, " "), F.lit("%"))


def indian_digits(c) -> Column:
    """Whole number with Indian digit grouping."""
    return F.regexp_replace(F.round(as_col(c), 0).cast("decimal(38,0)").cast("string"), INDIAN_GROUPS, ",")


def rupees(c) -> Column:
    return F.concat(F.lit(CURRENCY_SIGN), indian_digits(c))


def parse_money(c) -> Column:
    """Amount written as text to decimal: sign, grouping and percent handled, blank is null."""
    bare = F.regexp_replace(as_col(c), MONEY_MARKS, "")
    amount = F.regexp_replace(bare, "%$", "").try_cast("decimal(18,4)")
    return F.when(bare.endswith("%"), amount / 100).otherwise(amount).cast("decimal(18,4)")
