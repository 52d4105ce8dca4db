"""Season arithmetic for planning a load. Seasons are named by their starting year."""

from __future__ import annotations

from datetime import UTC, date, datetime

ROLLOVER_MONTH = 7


def utc_today() -> date:
    return datetime.now(UTC).date()


def current_season(today: date | None = None) -> int:
    day = today or utc_today()
    return day.year - (day.month < ROLLOVER_MONTH)


def check_range(first: int, last: int) -> None:
    if first > last:
        raise ValueError(f"first season {first} lies after last season {last}")
