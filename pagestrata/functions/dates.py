"""The three date spellings of the data set, and the run date."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagestrata.functions.text import _col, norm_text

DEFAULT_ZONE = "America/Sao_Paulo"


def portal_date(c: Column | str, days_offset: int = 0) -> Column:
    """Date as ``Nov 5, 2025`` (English month, day not padded)."""
    return F.date_format(F.date_add(_col(c).cast("date"), days_offset), "MMM d, yyyy")


def portal_date_to_iso(c: Column | str) -> Column:
    """``Nov 5, 2025`` to ``2025-11-05``; ``''`` for anything else."""
    text = norm_text(c)
    is_date = text.rlike(r"(?i)^[a-z]{3} \d{1,2}, \d{4}$")
    parsed = F.try_to_date(F.when(is_date, text), "MMM d, yyyy")
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), F.lit(""))


def extraction_date(c: Column | str) -> Column:
    """Date as ``YYYY-DD-MM``: day before month, as stored in the base."""
    return F.date_format(_col(c).cast("date"), "yyyy-dd-MM")


def date_in_zone(instant: Column | str, zone: str = DEFAULT_ZONE) -> Column:
    """The day that an instant (in UTC) falls on in ``zone``."""
    return F.from_utc_timestamp(_col(instant).cast("timestamp"), zone).cast("date")


def resolve_run_date(
    test_date: str | None = None,
    days_offset: int = 0,
    zone: str = DEFAULT_ZONE,
    now: dt.datetime | None = None,
) -> dt.date:
    """Date a run is about: the explicit ``YYYY-MM-DD``, else today in ``zone``.

    ``now`` (aware) makes a run repeatable. An unknown zone falls back to local time.
    """
    if test_date is not None:
        if not test_date.strip():
            raise ValueError("test_date is blank; use YYYY-MM-DD or leave it out")
        day = dt.datetime.strptime(test_date.strip(), "%Y-%m-%d").date()
    else:
        try:
            tz = ZoneInfo(zone)
        except (ZoneInfoNotFoundError, ValueError):
            tz = None
        day = (now.astimezone(tz) if now else dt.datetime.now(tz)).date()
    return day + dt.timedelta(days=days_offset)
