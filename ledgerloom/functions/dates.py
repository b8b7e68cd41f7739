"""Ages, tenures, months and time parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

AsOf = dt.date | str | Column | None
DAYS_PER_YEAR = 365.25


def as_of_column(as_of: AsOf) -> Column:
    """The date everything is measured from; today when none is given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def age_by_days(born: Column, as_of: Column) -> Column:
    """Age as whole multiples of 365.25 days; can differ from the calendar age around a birthday."""
    return F.floor(F.datediff(as_of, born) / F.lit(DAYS_PER_YEAR)).cast("int")


def completed_years(born: Column, as_of: Column) -> Column:
    """Calendar years completed. A birth on 29 February completes its year on 1 March of a common year."""
    early, late = F.least(born, as_of), F.greatest(born, as_of)

    def month_day(day: Column) -> Column:
        return F.month(day) * 100 + F.dayofmonth(day)

    not_yet = F.when(month_day(late) < month_day(early), 1).otherwise(0)
    years = F.year(late) - F.year(early) - not_yet
    # least() and greatest() skip nulls, so an unknown birth has to be kept unknown here
    return F.when(born.isNull() | as_of.isNull(), F.lit(None)).when(born > as_of, -years).otherwise(years).cast("int")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def months_before(day: Column, months: int) -> Column:
    return F.add_months(day, -months)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def is_weekend(moment: Column) -> Column:
    """Saturday or Sunday; Monday counts as day 0."""
    return F.weekday(moment) >= 5


def hour_of_day(moment: Column) -> Column:
    return F.hour(moment)


def elapsed_seconds(later: Column, earlier: Column) -> Column:
    """Seconds between two timestamps, with their fraction."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / F.lit(1_000_000.0)
