"""Lenient conversions of control-table values."""

from pyspark.sql import Column, functions as F

from netbaseline.functions.text import _c, is_blank, trimmed

# Words read as true / false (compared without case, trimmed).
TRUE_WORDS = ["true", "yes", "1"]
FALSE_WORDS = ["false", "no", "0"]


def to_int(x) -> Column:
    """Text or number to INT; blank gives NULL, ``12.7`` gives 12, bad text NULL.

    Text with a decimal point is truncated toward zero; other text must be a
    whole number (after trimming).
    """
    c = _c(x)
    s = trimmed(c.cast("string"))
    return (F.when(is_blank(c.cast("string")), F.lit(None).cast("int"))
            .when(s.contains("."), s.try_cast("double").try_cast("int"))
            .otherwise(s.try_cast("int")))


def to_int_or_zero(x) -> Column:
    """:func:`to_int` with 0 in place of NULL."""
    return F.coalesce(to_int(x), F.lit(0))


def to_boolean(x, default: bool = False) -> Column:
    """``true/yes/1`` and ``false/no/0`` (any case); anything else the default."""
    s = F.lower(trimmed(_c(x).cast("string")))
    return (F.when(s.isin(TRUE_WORDS), F.lit(True))
            .when(s.isin(FALSE_WORDS), F.lit(False))
            .otherwise(F.lit(default)))


def round2(x) -> Column:
    """Round to two decimals, halves up: ``floor(v * 100 + 0.5) / 100``; NULL gives 0.

    ``F.round`` rounds the decimal text of a double and so differs for values
    such as 1.005; this form matches arithmetic rounding everywhere.
    """
    return F.coalesce(F.floor(_c(x).cast("double") * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0), F.lit(0.0))
