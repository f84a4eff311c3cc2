"""Column expressions shared by the operators; all stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tier limits of the case expression.
HIGH_FROM = 1000
MEDIUM_FROM = 100

UNKNOWN = "Unknown"
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(as_column(c), F.lit(""))


def text_to_number(c: str | Column, data_type: str = "double") -> Column:
    """Number from text; blank or malformed text gives NULL instead of an error."""
    return blank_to_null(c).try_cast(data_type)


def text_to_date(c: str | Column) -> Column:
    """Date from the leading ``yyyy-MM-dd``; impossible dates give NULL."""
    return F.try_to_date(F.substring(as_column(c), 1, 10), "yyyy-MM-dd")


def money(c: str | Column) -> Column:
    """Exact amount, so that sums do not depend on row order."""
    return as_column(c).cast("decimal(18,2)")


def money_total(c: str | Column) -> Column:
    return F.sum(money(c)).cast("double")


def cents_to_units(c: str | Column) -> Column:
    return (as_column(c) / F.lit(100)).cast("decimal(10,2)")


def or_unknown(c: str | Column) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(UNKNOWN))


def clamp_negative(c: str | Column) -> Column:
    """Negative becomes zero; NULL stays NULL."""
    c = as_column(c)
    return F.when(c < 0, F.lit(0).cast("double")).otherwise(c)


def tier(c: str | Column) -> Column:
    c = as_column(c)
    return F.when(c >= HIGH_FROM, "high").when(c >= MEDIUM_FROM, "medium").otherwise("low")


def surrogate_key(*parts: str | Column) -> Column:
    """SHA-256 over the parts joined by ``||``, in hexadecimal."""
    return F.sha2(F.concat_ws("||", *[as_column(p).cast("string") for p in parts]), 256)


def group_key(*parts: str | Column) -> Column:
    """SHA-256 over parts of which any may be NULL: each is led by its length, NULL is ``-``."""
    texts = [as_column(p).cast("string") for p in parts]
    return F.sha2(
        F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256
    )


def normalize_text(c: str | Column) -> Column:
    """Lower case, trimmed, inner white space reduced to one blank."""
    return F.trim(F.regexp_replace(F.lower(as_column(c)), r"\s+", " "))


def hide_emails(c: str | Column, replacement: str = "***") -> Column:
    """The pattern is slow on long text, so text without an at sign skips it."""
    c = as_column(c)
    return F.when(F.contains(c, F.lit("@")), F.regexp_replace(c, EMAIL_PATTERN, replacement)).otherwise(c)


def emails(c: str | Column) -> Column:
    """All e-mail addresses in lower case, in order and each once; an empty array if there are none."""
    c = as_column(c)
    found = F.regexp_extract_all(c, F.lit(EMAIL_PATTERN), F.lit(0))
    none = F.array().cast("array<string>")
    return F.when(F.contains(c, F.lit("@")), F.array_distinct(F.transform(found, lambda e: F.lower(e)))).otherwise(none)


def salted_hash(c: str | Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), as_column(c).cast("string")), 256)


def keep_last(c: str | Column, visible: int) -> Column:
    """Star out all but the last ``visible`` characters."""
    c = as_column(c)
    hidden = F.greatest(F.length(c) - visible, F.lit(0))
    return F.concat(F.repeat(F.lit("*"), hidden), F.right(c, F.lit(visible)))


def any_differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True if some pair differs; NULL against a value counts as a difference."""
    return ~F.struct(*left).eqNullSafe(F.struct(*right))
