"""Tolerant parsing and text normalisation as Column expressions.

Bad input becomes NULL (``try_*`` functions), never an exception, so one bad
row cannot fail a job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------
PRICE_DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "dd-MM-yyyy", "MM/dd/yyyy", "yyyy-MM-dd HH:mm:ss")
ISSUE_DATE_FORMAT = "MMM-yyyy"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Strip leading/trailing whitespace of any kind (``trim`` only strips spaces)."""
    return F.regexp_replace(_c(c).cast("string"), r"^\s+|\s+$", "")


def to_number(c) -> Column:
    """Tolerant numeric parse; unparseable text -> NULL (the cast trims whitespace)."""
    return _try_double(_c(c).cast("string"))


def _try_double(c: Column) -> Column:
    # the cast alone would also take Java's type suffixes ('10d', '10f')
    return F.when(c.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"), c.try_cast("double"))


def parse_percent(c) -> Column:
    """P4: '13.5%' or 13.5 -> 13.5."""
    return _try_double(F.regexp_replace(strip_ws(c), "%+$", ""))


def parse_term_months(c) -> Column:
    """P5: first integer in the text (' 36 months' -> 36); no digits -> NULL."""
    return F.nullif(F.regexp_extract(_c(c).cast("string"), r"(\d+)", 1), F.lit("")).try_cast("int")


def standardize(c) -> Column:
    """Strip and collapse internal whitespace runs to one space; NULL stays NULL."""
    return F.regexp_replace(strip_ws(c), r"\s+", " ")


def parse_month_year(c) -> Column:
    """P7: 'Dec-2015' -> 2015-12-01."""
    return F.try_to_date(strip_ws(c), ISSUE_DATE_FORMAT)


def parse_date_any(c, formats=PRICE_DATE_FORMATS) -> Column:
    """First format that parses wins; nothing parses -> NULL."""
    s = strip_ws(c)
    return F.coalesce(*[F.try_to_date(s, f) for f in formats])


def strip_policy_prefix(c, pattern: str) -> Column:
    """Remove a retired-policy prefix."""
    return F.regexp_replace(_c(c), pattern, "")


def upper_left(c, n: int | None = None) -> Column:
    """P10: upper-case and keep the first ``n`` characters."""
    u = F.upper(_c(c))
    return F.substring(u, 1, n) if n else u


def round_half_even_long(c) -> Column:
    """Round half-even to a nullable integer."""
    return F.bround(_c(c).cast("double"), 0).cast("bigint")
