"""Calendar rules: seasons, day-of-year conventions, quarter keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the calendar conventions.
SEASON_START_MONTH = 7        # a plotting season runs July 1 .. June 30
PUBLISHED_AFTER_DAYS = 7  # of July, before a new season is shown
SEASON_DAYS = 365             # positions in a season matrix
CLIMATOLOGY_FIRST_DOY = 182   # July 1 of a common year
NEXT_YEAR_BELOW_DOY = 300     # freeze-up days before this belong to the following year
LABEL_YEAR = 2001             # common year used to turn a day number into month and day


def is_leap(year: Column) -> Column:
    return F.dayofyear(F.make_date(year, F.lit(12), F.lit(31))) == 366


def days_in_year(year: Column) -> Column:
    return F.dayofyear(F.make_date(year, F.lit(12), F.lit(31)))


def season_of(day: Column, cutover_month: int = SEASON_START_MONTH) -> Column:
    """Year whose July opens the season the day belongs to."""
    return F.year(day) - (F.month(day) < cutover_month).cast("int")


def published_season(as_of: Column) -> Column:
    """Season whose forecast is shown on a day: the first seven days of July still show the old one, as the first
    forecast of the new season is issued on the 7th."""
    return season_of(F.date_sub(as_of, PUBLISHED_AFTER_DAYS))


def forecast_season(issued: Column) -> Column:
    """Season an issue date forecasts; NULL in May and June, when nothing is issued."""
    month = F.month(issued)
    return F.when(month <= 4, F.year(issued) - 1).when(month >= 7, F.year(issued))


def season_label(season: Column) -> Column:
    return F.concat_ws("/", season.cast("string"), (season + 1).cast("string"))


def season_position(day: Column, season: Column) -> Column:
    """Days since July 1 of the season; 0..364 are the positions kept."""
    return F.date_diff(day, F.make_date(season, F.lit(SEASON_START_MONTH), F.lit(1)))


def winter_season(day: Column) -> Column:
    """Season of the winter (November 1, May 31]: November 1 is outside, May 31 inside."""
    month = F.month(day)
    late = (month >= 11) & ~((month == 11) & (F.dayofmonth(day) == 1))
    return F.when(month <= 5, F.year(day) - 1).when(late, F.year(day))


def winter_year(day: Column) -> Column:
    """Year of the January in the same winter: December counts to the following year."""
    return F.year(day) + (F.month(day) == 12).cast("int")


def quarter_from_december(day: Column) -> Column:
    """First day of the quarter in a year that starts on December 1."""
    return F.add_months(F.trunc(F.add_months(day, 1), "quarter"), -1)


def climatology_position(doy: Column) -> Column:
    """Day of year on the July-to-June axis; day 366 has no position."""
    return F.when(doy <= SEASON_DAYS, F.pmod(doy - CLIMATOLOGY_FIRST_DOY, F.lit(SEASON_DAYS)))


def fudoy(day: Column, season: Column, fixed_year_length: bool = False) -> Column:
    """Freeze-up day number counted from January 1 of the season's year.

    Days of the following year continue the count by the season's own length. With
    ``fixed_year_length`` the count follows the 365-day convention that
    :func:`fudoy_to_date` reads, so the two are inverse also in leap years.
    """
    doy = F.dayofyear(day)
    counted = doy + F.when(doy < NEXT_YEAR_BELOW_DOY, days_in_year(season)).otherwise(F.lit(0))
    return counted - is_leap(season).cast("int") if fixed_year_length else counted


def fudoy_to_date(value: Column, season: Column) -> Column:
    """Forecast day number to a date; every season counts 365 days, so 360 is December 26."""
    this_year = F.make_date(season, F.lit(1), F.lit(1))
    next_year = F.make_date(season + 1, F.lit(1), F.lit(1))

    def offset(days: Column) -> Column:
        return F.bround(days, 0).cast("int")

    return (
        F.when(value > SEASON_DAYS, F.date_add(next_year, offset(value - 366)))
        .when(is_leap(season), F.date_add(this_year, offset(value)))
        .otherwise(F.date_add(this_year, offset(value - 1)))
    )


def doy_to_monthday(number: Column, pattern: str = "MM-dd") -> Column:
    """Day number on the common-year axis, running on into the next year, as month and day."""
    return F.date_format(F.date_add(F.lit(f"{LABEL_YEAR}-01-01").cast("date"), number.cast("int") - 1), pattern)


def common_year_number(day: Column) -> Column:
    """Day number of the month and day in a common year, January to June counted after December."""
    doy = F.dayofyear(day) - (is_leap(F.year(day)) & (F.month(day) > 2)).cast("int")
    return doy + F.when(doy < CLIMATOLOGY_FIRST_DOY, SEASON_DAYS).otherwise(0)


def shift_minutes(ts: Column, minutes: int) -> Column:
    return ts + F.make_dt_interval(mins=F.lit(minutes))


def day_grid(first: Column, last: Column) -> Column:
    """Every day from first to last, one row each."""
    return F.explode(F.sequence(first, last))
