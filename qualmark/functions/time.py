"""Time expressions on TIMESTAMP_NTZ / DATE columns.

All arithmetic is on epoch seconds built from the NTZ date and time-of-day
fields, so nothing passes through the session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86400
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 of a TIMESTAMP_NTZ wall-clock value.

    Built from the date and time-of-day fields, which are zone-free for NTZ
    (``timestampdiff`` on NTZ goes through the session time zone and is off
    by an hour inside a daylight-saving gap).
    """
    t = _c(ts)
    return (F.unix_date(F.to_date(t)).cast("long") * F.lit(DAY_SECONDS)
            + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t))


def from_epoch_seconds(sec) -> Column:
    """TIMESTAMP_NTZ for whole epoch seconds (inverse of ``epoch_seconds``, zone-free)."""
    s = _c(sec).cast("long")
    day = F.floor(s / F.lit(DAY_SECONDS))
    of_day = s - day * F.lit(DAY_SECONDS)
    return (F.date_from_unix_date(day.cast("int")).cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), of_day.cast("decimal(18,6)")))


def bucket_start(ts, seconds: int = 600) -> Column:
    """Start of the fixed bucket of ``seconds`` holding ``ts`` (TIMESTAMP_NTZ).

    The ten-minute bucket is the typed form of cutting the timestamp text to
    15 characters and appending ``'0'``.
    """
    sec = epoch_seconds(ts)
    return from_epoch_seconds(F.floor(sec / F.lit(seconds)).cast("long") * F.lit(seconds))


def day_number(d) -> Column:
    """Days since 1970-01-01 of a DATE (or the date of a timestamp)."""
    return F.unix_date(F.to_date(_c(d)))


def as_date(value) -> _dt.date:
    """Accept ``date``, ``datetime``, ``'YYYY-MM-DD'`` or ``'YYYYMMDD'``."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    text = str(value).strip()
    if len(text) == 8 and text.isdigit():
        return _dt.datetime.strptime(text, "%Y%m%d").date()
    return _dt.date.fromisoformat(text[:10])


def day_bounds(as_of, lo: int, hi: int) -> tuple[_dt.datetime, _dt.datetime]:
    """Half-open ``[as_of+lo, as_of+hi)`` as datetimes at midnight."""
    d = as_date(as_of)
    start = _dt.datetime.combine(d + _dt.timedelta(days=lo), _dt.time())
    end = _dt.datetime.combine(d + _dt.timedelta(days=hi), _dt.time())
    return start, end


def ts_literal(value: _dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (no session time zone involved)."""
    return F.expr(f"TIMESTAMP_NTZ'{value.strftime('%Y-%m-%d %H:%M:%S')}'")


def date_literal(value) -> Column:
    return F.expr(f"DATE'{as_date(value).isoformat()}'")


def registered(regdatetime) -> Column:
    """Registration time stamped on result rows: the given one, or now."""
    if regdatetime is None:
        return F.localtimestamp()
    if isinstance(regdatetime, str):
        regdatetime = _dt.datetime.fromisoformat(regdatetime)
    return ts_literal(regdatetime)
