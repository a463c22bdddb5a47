"""Dates as boards publish them."""

from pyspark.sql import Column, functions as F

from boardtide import fixed
from boardtide.functions.text import FLAGS, _col


def iso_date(c) -> Column:
    """Calendar date of an ISO timestamp in its own offset; null when it cannot be read.

    The date part is taken as written: 23:30-04:00 is that day, not the next one in UTC.
    """
    text = _col(c)
    valid = F.try_to_timestamp(text).isNotNull()
    return F.when(valid, F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))


def epoch_millis_date(c) -> Column:
    """UTC date of milliseconds since the epoch, whatever the session's zone; zero gives null."""
    millis = _col(c).cast("bigint")
    days = F.floor(millis / F.lit(86_400_000)).try_cast("int")
    return F.when(millis != 0, F.date_from_unix_date(days))


def relative_date(text, today) -> Column:
    """"Posted Today / Yesterday / 3 Days Ago" to a date; "30+ Days Ago" stays null."""
    text = F.coalesce(_col(text), F.lit(""))
    today = _col(today)
    grab = lambda group: F.regexp_extract(text, FLAGS + fixed.RELATIVE_DATE, group)
    days = grab(1)
    return (
        F.when(grab(2) != "", today)
        .when(grab(3) != "", F.date_sub(today, 1))
        .when((days != "") & ~F.contains(text, F.lit("+")),
              F.date_sub(today, days.try_cast("int")))
    )


def basis_when(date, basis="published") -> Column:
    return F.when(_col(date).isNotNull(), F.lit(basis))


def shown_date(posted, first_seen) -> Column:
    """The date a reader sees: posted, else first seen, else a plain statement."""
    return F.coalesce(
        F.date_format(F.coalesce(_col(posted), _col(first_seen)), "yyyy-MM-dd"),
        F.lit("date unknown"),
    )
