"""Period arithmetic of the checks: where does an interval start."""

from __future__ import annotations

import datetime as dt
from calendar import monthrange

QUARTER_MONTHS = 4  # fixed value: a quarter goes four months back


def add_months(day: dt.date, months: int) -> dt.date:
    """``day`` moved by ``months``; the day is clipped to the length of the month."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    month += 1
    return dt.date(year, month, min(day.day, monthrange(year, month)[1]))


def first_day(day: dt.date) -> dt.date:
    return day.replace(day=1)


def last_day(day: dt.date) -> dt.date:
    return day.replace(day=monthrange(day.year, day.month)[1])


def interval_start(
    day: dt.date, unit: str, quantity: int, quarter_months: int = QUARTER_MONTHS
) -> dt.date | None:
    """Start of the interval of ``quantity`` units that ends on ``day``; None for an unknown unit."""
    match unit:
        case "year":
            return add_months(day, -12 * quantity)
        case "quarter":
            return add_months(day, -quarter_months * quantity)
        case "month":
            return add_months(day, -quantity)
        case "month_ld":
            return last_day(add_months(day, -quantity))
        case "month_fd":
            return first_day(add_months(day, -quantity))
        case "week":
            return day - dt.timedelta(days=7 * quantity)
        case "day":
            return day - dt.timedelta(days=quantity)
    return None


def interval_start_sql(day: str, unit: str, quantity: str, quarter_months: int = QUARTER_MONTHS) -> str:
    """The same rule as a Spark SQL expression over columns."""
    return f"""
        case {unit}
            when 'year' then add_months({day}, -12 * {quantity})
            when 'quarter' then add_months({day}, -{quarter_months} * {quantity})
            when 'month' then add_months({day}, -{quantity})
            when 'month_ld' then last_day(add_months({day}, -{quantity}))
            when 'month_fd' then trunc(add_months({day}, -{quantity}), 'MM')
            when 'week' then date_sub({day}, 7 * {quantity})
            when 'day' then date_sub({day}, {quantity})
        end"""
