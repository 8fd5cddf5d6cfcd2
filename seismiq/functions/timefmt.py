"""Time conversions that do not depend on the session time zone.

Feed times are UTC.  They are held as TIMESTAMP_NTZ (UTC wall clock), so the
result of parsing or formatting is the same whatever the session zone is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_ms_to_ntz(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ in UTC wall clock (null stays null)."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def iso_utc_text(ms: Column | str) -> Column:
    """Epoch ms -> ISO-8601 text with a trailing ``Z``.

    Null or 0 gives null.  The fraction is printed with six digits and only
    when it is non-zero, as Python's ``isoformat`` does.
    """
    m = F.nullif(_c(ms), F.lit(0))
    ts = epoch_ms_to_ntz(m)
    frac = F.pmod(m, F.lit(1000))
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(frac != 0, F.format_string(".%06d", frac * 1000)).otherwise(F.lit("")),
        F.lit("Z"),
    )


def ntz_to_iso_text(ts: Column | str) -> Column:
    """TIMESTAMP_NTZ (UTC) -> ISO text, fraction only when non-zero."""
    t = _c(ts)
    micros = F.unix_micros(t.cast("timestamp"))  # cast is exact under a UTC session
    frac = F.pmod(micros, F.lit(1000000))
    return F.when(t.isNotNull(), F.concat(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(frac != 0, F.format_string(".%06d", frac)).otherwise(F.lit("")),
        F.lit("Z"),
    ))


# ---- fixed values: the shape of a feed time, with or without a fraction -----
FEED_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?Z$"
# -----------------------------------------------------------------------------


def parse_iso_utc(text: Column | str) -> Column:
    """Feed time text (``2024-01-31T05:06:07Z``, fraction optional) -> TIMESTAMP_NTZ in UTC.

    Any other shape, and a date or time that does not exist, gives null.  The
    session time zone plays no part: the text is read as a UTC wall clock.
    """
    t = _c(text)
    return F.when(t.rlike(FEED_TIME), F.rtrim(t, F.lit("Z")).try_cast("timestamp_ntz"))


def now_utc() -> Column:
    """Wall clock of the run as TIMESTAMP_NTZ in UTC, whatever the session zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def hour_of(ts: Column | str) -> Column:
    """Floor to the hour, keeping TIMESTAMP_NTZ."""
    return F.date_trunc("hour", _c(ts)).cast("timestamp_ntz")
