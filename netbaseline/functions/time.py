"""Event time: window lengths, zone conversion, profile slot keys."""

from __future__ import annotations

import re
from statistics import NormalDist

from pyspark.sql import Column, functions as F

from netbaseline.functions.text import _c

# Window lengths chosen by the ``interval`` option.
#   blank          -> level 1: 5 minutes,  level 2: 10 minutes
#   "<N>m"         -> level 1: N minutes,  level 2: 5*N minutes
#   "<N>h"         -> level 1: N hours,    level 2: 2*N hours
#   anything else  -> the text without its last character is N; both levels N days
DEFAULT_LEVEL1_MINUTES = 5
DEFAULT_LEVEL2_MINUTES = 10
MINUTE_FACTOR = 5
HOUR_FACTOR = 2

# The model's display zone and the bound on out-of-order arrival.
MODEL_ZONE = "+08:00"
WATERMARK_DELAY = "5 seconds"

# Two-sided z for the confidence levels offered to users.
Z_TABLE = {0.90: 1.645, 0.95: 1.96, 0.99: 2.576}
DEFAULT_Z = 1.96


def window_lengths(interval: str | None) -> tuple[int, int]:
    """Level-1 and level-2 window lengths, in seconds, for an ``interval`` option."""
    text = (interval or "").strip().lower()
    if not text or text == "null":
        return DEFAULT_LEVEL1_MINUTES * 60, DEFAULT_LEVEL2_MINUTES * 60
    if not re.fullmatch(r"0*[1-9][0-9]*", text[:-1].strip()):
        raise ValueError(f"interval {interval!r}: a whole number of 1 or more and a unit are needed")
    number = int(text[:-1].strip())
    if text.endswith("m"):
        return number * 60, number * MINUTE_FACTOR * 60
    if text.endswith("h"):
        return number * 3600, number * HOUR_FACTOR * 3600
    return number * 86400, number * 86400


def duration(seconds: int) -> str:
    """A Spark window duration string."""
    return f"{int(seconds)} seconds"


def z_for_confidence(level: float | None) -> float:
    """z of a two-sided normal interval; the tabled values where they exist.

    The stored column has two decimals (as a FLOAT, 0.95 is not exact), so the
    level is rounded to two places first.  None gives 1.96.
    """
    if level is None:
        return DEFAULT_Z
    level = round(level, 2)
    for known, z in Z_TABLE.items():
        if abs(level - known) < 1e-9:
            return z
    if not 0.0 < level < 1.0:
        raise ValueError(f"confidence level {level} is not between 0 and 1")
    return NormalDist().inv_cdf((1.0 + level) / 2.0)


_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _fixed_offset_seconds(zone: str) -> int | None:
    """Seconds east of UTC for ``UTC``/``Z``/``+hh:mm``/``-hh:mm``; None for named (DST) zones."""
    z = zone.strip().upper()
    if z in ("UTC", "Z", "GMT", "+00:00", "-00:00"):
        return 0
    m = re.fullmatch(r"([+-])(\d{1,2}):?(\d{2})", z)
    if not m:
        return None
    secs = int(m.group(2)) * 3600 + int(m.group(3)) * 60
    return secs if m.group(1) == "+" else -secs


def instant_from_ntz(x, zone: str = "UTC") -> Column:
    """A wall-clock TIMESTAMP_NTZ read in ``zone``, as an instant (TIMESTAMP).

    Independent of ``spark.sql.session.timeZone``.  Fixed offsets are plain
    microsecond arithmetic; named zones go through ``convert_timezone``.
    """
    off = _fixed_offset_seconds(zone)
    c = _c(x).cast("timestamp_ntz")
    if off is None:
        return F.convert_timezone(F.lit(zone), F.current_timezone(), c).cast("timestamp")
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c) - F.lit(off * 1_000_000)
    return F.timestamp_micros(micros)


def local_ntz(x, zone: str = MODEL_ZONE) -> Column:
    """The wall-clock time of an instant in ``zone`` (TIMESTAMP_NTZ)."""
    off = _fixed_offset_seconds(zone)
    if off is None:
        return F.convert_timezone(F.current_timezone(), F.lit(zone), _c(x).cast("timestamp_ntz"))
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(x)) + F.lit(off * 1_000_000), F.expr(_EPOCH_NTZ))


def zone_date(x, fmt: str = "yyyy-MM-dd", zone: str = MODEL_ZONE) -> Column:
    """An instant formatted in a zone (default: date at +08:00).

    Week-based year patterns (``YYYY``) are refused by Spark; calendar year
    ``yyyy`` is used, which is what a date label means.
    """
    return F.date_format(local_ntz(x, zone), fmt)


def slot_key(x, span, zone: str = MODEL_ZONE) -> Column:
    """Profile slot of an instant: hour (span 1), ISO weekday (2), month (3, 4).

    Other spans raise an error, as an unsupported model period.
    """
    t = local_ntz(x, zone)
    s = _c(span) if not isinstance(span, int) else F.lit(span)
    return (F.when(s == 1, F.hour(t))
            .when(s == 2, F.weekday(t) + 1)
            .when(s.isin(3, 4), F.month(t))
            .otherwise(F.raise_error(F.concat(F.lit("unsupported model_result_span: "),
                                              F.coalesce(s.cast("string"), F.lit("NULL")))).cast("int"))
            ).cast("string")
