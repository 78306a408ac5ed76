"""Text predicates: blank test, blank-aware equality, null-to-empty."""

from pyspark.sql import Column, functions as F

# The characters that count as white space (code points 0 to 32).
WHITE = "".join(map(chr, range(33)))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trimmed(x) -> Column:
    """Text without leading and trailing white space (code points up to 32)."""
    return F.btrim(_c(x), F.lit(WHITE))


def is_blank(x) -> Column:
    """True for NULL, for text of only white space, and for the text ``null``."""
    c = _c(x)
    return c.isNull() | (trimmed(c) == F.lit("")) | (c == F.lit("null"))


def blank_aware_equals(a, b) -> Column:
    """Two blanks are equal, a blank and a non-blank are not, else exact match."""
    a, b = _c(a), _c(b)
    ba, bb = is_blank(a), is_blank(b)
    return (F.when(ba & bb, F.lit(True))
            .when(ba | bb, F.lit(False))
            .otherwise(a == b))


def blank_aware_equals_ci(a, b) -> Column:
    """As :func:`blank_aware_equals`, ignoring case."""
    a, b = _c(a), _c(b)
    ba, bb = is_blank(a), is_blank(b)
    return (F.when(ba & bb, F.lit(True))
            .when(ba | bb, F.lit(False))
            .otherwise(F.lower(a) == F.lower(b)))


def blank_to_empty(x) -> Column:
    """NULL, white space and ``null`` become the empty string, so that they are one key."""
    c = _c(x)
    return F.when(is_blank(c), F.lit("")).otherwise(c)


def to_text(x) -> Column:
    """Any value as text; NULL becomes the empty string."""
    return F.coalesce(_c(x).cast("string"), F.lit(""))
