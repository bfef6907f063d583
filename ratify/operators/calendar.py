"""Calendar dimension (C20), business time (C6) and worked days.

The calendar is generated from ``spark.range`` over a date span, so its row
count is exactly the number of days (at most 366 per year): that is the size
bound that allows broadcasting it in every join below.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratify.functions.dates import duration_text, iso_year_week, weekday_number
from ratify.sources import rules as R


def recurring_holidays(spark: SparkSession, first_year: int, last_year: int,
                       rules: list[tuple[str, str]]) -> DataFrame:
    """(holiday_date, label) for each 'MM-dd' rule in each year of the span."""
    rule_structs = F.array(*[F.struct(F.lit(md).alias("month_day"), F.lit(lb).alias("label"))
                             for md, lb in rules])
    years = spark.range(first_year, last_year + 1).select(
        F.col("id").cast("int").alias("y"), F.explode(rule_structs).alias("r"))
    return (years.select(
                F.to_date(F.format_string("%04d-%s", F.col("y"), F.col("r.month_day")))
                .alias("holiday_date"), F.col("r.label").alias("label"))
            .filter(F.col("holiday_date").isNotNull()))


def build_calendar(spark: SparkSession, start: dt.date, end: dt.date,
                   holidays: DataFrame | None = None) -> DataFrame:
    """ReferenceDate, YearWeek (ISO), WeekDayNumber (Mon=0), HolidayOrBridge."""
    n_days = (end - start).days + 1
    days = spark.range(n_days).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("ReferenceDate"))
    cal = days.select(
        "ReferenceDate",
        iso_year_week("ReferenceDate").alias("YearWeek"),
        weekday_number("ReferenceDate").alias("WeekDayNumber"),
    )
    if holidays is None:
        return _with_span(cal.withColumn("HolidayOrBridge", F.lit(None).cast("string")), start, end)
    hol = holidays.select(F.col("holiday_date").alias("ReferenceDate"),
                          F.col("label").alias("HolidayOrBridge"))
    # several labels on one day: a bridge gives way to any other label, so that the day stays free
    hol = hol.groupBy("ReferenceDate").agg(
        F.coalesce(F.min(F.when(F.col("HolidayOrBridge") != R.BRIDGE_LABEL, F.col("HolidayOrBridge"))),
                   F.min("HolidayOrBridge")).alias("HolidayOrBridge"))
    return _with_span(cal.join(F.broadcast(hol), "ReferenceDate", "left"), start, end)


# Calendars built here remember their span, so callers need no aggregate job to find it.
def _with_span(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    df._calendar_span = (start, end)
    return df


def known_span(df: DataFrame):
    """(first, last) day of a calendar built by ``build_calendar``, else None."""
    return getattr(df, "_calendar_span", None)


def is_approval_day(holiday: Column | str = "HolidayOrBridge") -> Column:
    """Not a holiday; bridge days count as working days."""
    h = F.col(holiday) if isinstance(holiday, str) else holiday
    return h.isNull() | (h == R.BRIDGE_LABEL)


def is_business_day(calendar_prefix: str = "") -> Column:
    wd = F.col(f"{calendar_prefix}WeekDayNumber")
    return (wd <= R.LAST_WEEKDAY) & is_approval_day(f"{calendar_prefix}HolidayOrBridge")


def business_minutes_table(calendar: DataFrame,
                           day_start: int = R.WORKDAY_START_MINUTE,
                           day_end: int = R.WORKDAY_END_MINUTE) -> DataFrame:
    """Per day: is it a business day, and business minutes before the day starts.

    The running total is a window over the whole calendar; the calendar is
    bounded by its day span, so a single ordered partition is fine here.
    """
    per_day = day_end - day_start
    day_minutes = F.when(is_business_day(), F.lit(per_day)).otherwise(F.lit(0))
    w = Window.orderBy("ReferenceDate").rowsBetween(Window.unboundedPreceding, -1)
    return calendar.select(
        "ReferenceDate",
        is_business_day().alias("is_business"),
        F.coalesce(F.sum(day_minutes).over(w), F.lit(0)).cast("long").alias("minutes_before"),
    )


def _minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def business_time(df: DataFrame, start_col: str, end_col: str, calendar: DataFrame,
                  minutes_col: str = "sla_minutes", text_col: str | None = "sla_text",
                  day_start: int = R.WORKDAY_START_MINUTE,
                  day_end: int = R.WORKDAY_END_MINUTE) -> DataFrame:
    """Business minutes between two timestamps (weekends and holidays excluded).

    position(t) = business minutes before t's day + clamp(t's minute of day to
    working hours) on business days.  Result = position(end) - position(start),
    signed; NULL when either side is NULL or outside the calendar.  Two
    broadcast equi-joins with the bounded calendar; no per-row expansion.
    """
    table = business_minutes_table(calendar, day_start, day_end)
    per_day = day_end - day_start

    def side(tag: str):
        return F.broadcast(table.select(F.col("ReferenceDate").alias(f"_{tag}_d"),
                                        F.col("is_business").alias(f"_{tag}_b"),
                                        F.col("minutes_before").alias(f"_{tag}_m")))

    def position(col: str, tag: str) -> Column:
        inside = F.least(F.greatest(_minute_of_day(F.col(col)) - day_start, F.lit(0)),
                         F.lit(per_day))
        return F.col(f"_{tag}_m") + F.when(F.col(f"_{tag}_b"), inside).otherwise(F.lit(0))

    keep = df.columns
    j = (df.join(side("s"), F.to_date(F.col(start_col)) == F.col("_s_d"), "left")
         .join(side("e"), F.to_date(F.col(end_col)) == F.col("_e_d"), "left"))
    minutes = (position(end_col, "e") - position(start_col, "s")).cast("long")
    extra = [minutes.alias(minutes_col)]
    if text_col:
        extra.append(duration_text(minutes).alias(text_col))
    return j.select(*keep, *extra)


def worked_days(pairs: DataFrame, calendar: DataFrame, roster: DataFrame | None,
                approver_col: str = "_aprovador") -> DataFrame:
    """Business days in each (YearWeek, approver) pair: Mon-Fri, plus Saturday
    for roster members, never holidays.

    Week totals come from one aggregate over the calendar (bounded), and the
    person side is an equi-join on the week: no person x calendar product.
    """
    cal = calendar.filter(is_approval_day())
    week = cal.groupBy("YearWeek").agg(
        F.sum(F.when(F.col("WeekDayNumber") <= R.LAST_WEEKDAY, 1).otherwise(0))
         .cast("long").alias("weekdays"),
        F.sum(F.when(F.col("WeekDayNumber") == R.LAST_WEEKDAY_ROSTER, 1).otherwise(0))
         .cast("long").alias("saturdays"),
    )
    people = pairs.select("YearWeek", approver_col).distinct()
    if roster is not None:
        r = roster.select(F.col("web_user_name").alias("_r_name")).distinct()
        people = (people.join(r, people[approver_col] == r["_r_name"], "left")
                  .withColumn("works_saturday", F.col("_r_name").isNotNull()).drop("_r_name"))
    else:
        people = people.withColumn("works_saturday", F.lit(False))
    out = people.join(F.broadcast(week), "YearWeek", "left")
    return out.select(
        "YearWeek", approver_col, "works_saturday",
        (F.coalesce(F.col("weekdays"), F.lit(0))
         + F.when(F.col("works_saturday"), F.coalesce(F.col("saturdays"), F.lit(0)))
         .otherwise(F.lit(0))).cast("long").alias("worked_days"),
    )
