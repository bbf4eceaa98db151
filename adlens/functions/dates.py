"""Dates and report windows.

One date rule for every source (D4): the marketplace-local date of an
hourly row is the date written in its ISO-8601 text, i.e. its first ten
characters; the session zone never enters.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOWS = ("today", "yesterday", "last7days")


def iso_to_timestamp(text) -> Column:
    """ISO-8601 text with offset -> TIMESTAMP (DT1); bad text -> null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))


def local_date(text) -> Column:
    """Date in the offset of the text itself (DT2)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def date_text(date) -> Column:
    """``yyyy-MM-dd`` text of a date (DT4)."""
    date = F.col(date) if isinstance(date, str) else date
    return F.date_format(date, "yyyy-MM-dd")


def with_event_date(df: DataFrame, text_col: str = "time_window_start") -> DataFrame:
    """Add ``event_ts`` and ``event_date`` to rows keyed by ISO window text."""
    return df.withColumns({"event_ts": iso_to_timestamp(text_col),
                           "event_date": local_date(text_col)})


def _as_date(as_of) -> _dt.date | None:
    if as_of is None or isinstance(as_of, _dt.date):
        return as_of
    return _dt.date.fromisoformat(str(as_of))


def window_bounds(window: str, as_of) -> tuple[_dt.date, _dt.date]:
    """Inclusive (first, last) dates of a named window relative to ``as_of``.

    Unknown names behave as ``today`` (F4).  ``last7days`` reaches back
    seven days, i.e. eight dates including ``as_of`` (F3, D16).
    """
    day = _as_date(as_of)
    if window == "yesterday":
        d = day - _dt.timedelta(days=1)
        return d, d
    if window == "last7days":
        return day - _dt.timedelta(days=7), day
    return day, day


def text_window_filter(window: str, as_of=None, text_col: str = "time_window_start", bounded: bool = False) -> Column:
    """The same window as a range on the ISO text itself.

    ISO text sorts by its first ten characters, so the range holds exactly for
    well-formed text and, unlike a function of the column, reaches the scan.
    """
    base = F.current_date() if as_of is None else F.lit(_as_date(as_of))
    first, last = base, base
    if window == "yesterday":
        first = last = F.date_sub(base, 1)
    elif window == "last7days":
        first, last = F.date_sub(base, 7), base if bounded else None
    text = F.col(text_col)
    inside = text >= date_text(first)
    return inside if last is None else inside & (text < date_text(F.date_add(last, 1)))


def window_filter(window: str = "today", as_of=None, date_col: str = "event_date",
                  bounded: bool = False) -> Column:
    """Predicate for a named report window (F1-F4, DT5, DT6).

    ``as_of=None`` means the current date (the reference's live behaviour).
    ``last7days`` has no upper bound (D16: a marketplace ahead of UTC is already
    in the next day); ``bounded=True`` ends it at ``as_of``, for an ``as_of``
    that lies in the past.
    """
    d = F.col(date_col)
    base = F.current_date() if as_of is None else F.lit(_as_date(as_of))
    if window == "yesterday":
        return d == F.date_sub(base, 1)
    if window == "last7days":
        lower = d >= F.date_sub(base, 7)
        return (lower & (d <= base)) if bounded else lower
    return d == base
