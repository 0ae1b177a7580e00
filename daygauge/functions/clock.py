"""The reporting clock.

A report belongs to one date, ``as_of`` ("today"). Yesterday, the seven-day
window and the printed labels all follow from it; no operator asks the wall
clock.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

WEEK = 7


def today(tz: str = "UTC", now: datetime | None = None) -> date:
    """The calendar date in ``tz``; ``now`` must carry its own time zone."""
    zone = ZoneInfo(tz)
    return (now.astimezone(zone) if now else datetime.now(zone)).date()


def yesterday(as_of: date) -> date:
    return as_of - timedelta(days=1)


def last_days(as_of: date, days: int = WEEK) -> tuple[date, date]:
    """First and last of the ``days`` full days before ``as_of``, both inclusive."""
    return as_of - timedelta(days=days), yesterday(as_of)


def day_text(d: date) -> str:
    return d.strftime("%d-%m-%Y")


def range_label(as_of: date, days: int = WEEK) -> str:
    first, last = last_days(as_of, days)
    return f"{day_text(first)} - {day_text(last)}"
