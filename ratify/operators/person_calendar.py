"""Working time by person (C6, C26): calendar classes, and who follows which class from when to when.

A class says up to which weekday it works and between which minutes of the
day.  Running totals of days and minutes are kept for each class and day, a
table bounded by the calendar's days times the classes, so it is broadcast.
A person's assignments, with the gaps between them filled by the default
class, tile all days; each piece carries the difference that makes the running
total of its class go on where the piece before ended.  So a person has one
running total over all changes of class, and days or minutes between any two
dates are a subtraction: no row is multiplied by days.

Defined results: a person without assignments, and a null person, follow the
default class; an assignment without a first or last day is open on that side;
one whose last day lies before its first, and one without a person, count as
none; two that share a day, and one of an unknown class, stop the job with a
message.  A moment outside the calendar gives null minutes.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratify.functions.dates import duration_text, iso_year_week
from ratify.operators.calendar import is_approval_day, known_span
from ratify.sources import rules as R

#: Open sides.
FIRST_DAY, LAST_DAY = "0001-01-01", "9999-12-31"


@dataclass(frozen=True)
class WorkClass:
    """Works Monday (0) to ``last_weekday``, from ``day_start`` to ``day_end`` (minutes of the day)."""

    last_weekday: int = R.LAST_WEEKDAY
    day_start: int = R.WORKDAY_START_MINUTE
    day_end: int = R.WORKDAY_END_MINUTE


#: The two classes of the roster rule.
CLASSES = {"weekdays": WorkClass(), "saturdays": WorkClass(last_weekday=R.LAST_WEEKDAY_ROSTER)}
DEFAULT_CLASS = "weekdays"


def roster_assignments(roster: DataFrame) -> DataFrame:
    """The Saturday roster as assignments: its members work Saturdays on all days."""
    none = F.lit(None).cast("date")
    return (roster.select("web_user_name").where(F.col("web_user_name").isNotNull()).distinct()
            .select("web_user_name", none.alias("valid_from"), none.alias("valid_to"), F.lit("saturdays").alias("calendar_class")))


def class_days(calendar: DataFrame, classes: dict[str, WorkClass] = CLASSES) -> DataFrame:
    """_cd_class, _cd_day, _cd_open, _cd_start, _cd_end, _cd_days, _cd_minutes: for each class and day whether and
    when it works, and its days and minutes before that day.  The day after the calendar's last one ends the totals."""
    after = calendar.agg(F.date_add(F.max("ReferenceDate"), 1).alias("ReferenceDate")).select(
        "ReferenceDate", F.lit(None).cast("int").alias("WeekDayNumber"), F.lit(False).alias("_free"))
    days = calendar.select("ReferenceDate", "WeekDayNumber", is_approval_day().alias("_free")).unionByName(after)
    listed = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(c.last_weekday).alias("last"),
                                F.lit(c.day_start).alias("start"), F.lit(c.day_end).alias("end"))
                       for name, c in sorted(classes.items())])
    rows = days.withColumn("c", F.explode(listed))
    works = F.coalesce(F.col("_free") & (F.col("WeekDayNumber") <= F.col("c.last")), F.lit(False))
    before = Window.partitionBy("c.name").orderBy("ReferenceDate").rowsBetween(Window.unboundedPreceding, -1)

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(F.when(works, value).otherwise(0)).over(before), F.lit(0)).cast("long")

    return rows.select(
        F.col("c.name").alias("_cd_class"), F.col("ReferenceDate").alias("_cd_day"), works.alias("_cd_open"),
        F.col("c.start").alias("_cd_start"), F.col("c.end").alias("_cd_end"),
        total(F.lit(1)).alias("_cd_days"), total(F.col("c.end") - F.col("c.start")).alias("_cd_minutes"))


def _span(calendar: DataFrame) -> tuple[dt.date, dt.date]:
    """First day and the day after the last."""
    span = known_span(calendar)
    if span is None:
        row = calendar.agg(F.min("ReferenceDate").alias("lo"), F.max("ReferenceDate").alias("hi")).first()
        span = row["lo"], row["hi"]
    return span[0], span[1] + dt.timedelta(days=1)


def _within(day: Column, span: tuple[dt.date, dt.date]) -> Column:
    return F.when(day.isNotNull(), F.least(F.greatest(day, F.lit(span[0])), F.lit(span[1])))


def person_pieces(assignments: DataFrame, days: DataFrame, span: tuple[dt.date, dt.date],
                  classes: dict[str, WorkClass] = CLASSES, default: str = DEFAULT_CLASS) -> DataFrame:
    """_pp_person, _pp_from, _pp_to, _pp_class, _pp_days, _pp_minutes: the pieces that tile all days of each
    assigned person, and what to add to the class's running totals in each."""
    known = F.col("calendar_class").isin(*classes)
    a = assignments.select(
        F.col("web_user_name").alias("_pp_person"),
        F.coalesce("valid_from", F.lit(FIRST_DAY).cast("date")).alias("first"), F.coalesce("valid_to", F.lit(LAST_DAY).cast("date")).alias("last"),
        F.when(F.coalesce(known, F.lit(False)), F.col("calendar_class")).otherwise(
            F.raise_error(F.concat(F.lit("unknown calendar class of "), "web_user_name"))).alias("class"))
    a = a.where(F.col("_pp_person").isNotNull() & (F.col("first") <= F.col("last")))
    in_order = Window.partitionBy("_pp_person").orderBy("first", "last")
    a = a.withColumns({"previous": F.lag("last").over(in_order), "following": F.lead("first").over(in_order)})
    start = F.when(F.col("first") <= F.col("previous"), F.raise_error(
        F.concat(F.lit("two calendar classes on one day: "), "_pp_person"))).otherwise(F.col("first"))
    gap = F.struct(F.coalesce(F.date_add("previous", 1), F.lit(FIRST_DAY).cast("date")).alias("first"),
                   F.date_sub(start, 1).alias("last"), F.lit(default).alias("class"))
    own = F.struct(start.alias("first"), F.col("last"), F.col("class"))
    tail = F.struct(F.when(F.col("following").isNull(), F.date_add("last", 1)).alias("first"),
                    F.lit(LAST_DAY).cast("date").alias("last"), F.lit(default).alias("class"))
    pieces = a.select("_pp_person", F.explode(F.array(gap, own, tail)).alias("p")).select("_pp_person", "p.*")
    pieces = pieces.where(F.col("first") <= F.col("last")).withColumn(
        "before", F.lag("class").over(Window.partitionBy("_pp_person").orderBy("first")))

    def totals(name: str) -> DataFrame:
        return F.broadcast(days.select(F.col("_cd_class").alias(f"{name}_class"), F.col("_cd_day").alias(f"{name}_day"),
                                       F.col("_cd_days").alias(f"{name}_days"), F.col("_cd_minutes").alias(f"{name}_minutes")))

    at = _within(F.col("first"), span)
    pieces = (pieces.join(totals("_new"), (F.col("class") == F.col("_new_class")) & (at == F.col("_new_day")), "left")
              .join(totals("_old"), (F.col("before") == F.col("_old_class")) & (at == F.col("_old_day")), "left"))
    so_far = Window.partitionBy("_pp_person").orderBy("first").rowsBetween(Window.unboundedPreceding, 0)

    def offset(unit: str) -> Column:
        step = F.when(F.col("before").isNull(), F.lit(0)).otherwise(F.col(f"_old_{unit}") - F.col(f"_new_{unit}"))
        return F.sum(step).over(so_far).cast("long").alias(f"_pp_{unit}")

    return pieces.select("_pp_person", F.col("first").alias("_pp_from"), F.col("last").alias("_pp_to"),
                         F.col("class").alias("_pp_class"), offset("days"), offset("minutes"))


class PersonCalendar:
    """Running totals by person over ``calendar`` (one row a day, bounded by its span)."""

    def __init__(self, calendar: DataFrame, assignments: DataFrame, classes: dict[str, WorkClass] = CLASSES,
                 default: str = DEFAULT_CLASS):
        if default not in classes:
            raise ValueError(f"unknown calendar class {default!r}")
        self.span, self.default = _span(calendar), default
        self.days = class_days(calendar, classes)
        self.pieces = person_pieces(assignments, self.days, self.span, classes, default)

    def _place(self, df: DataFrame, person: str, day: Column, tag: str) -> DataFrame:
        """``df`` with the columns of the class day that ``day`` is for the person, and the person's offsets, under ``tag``."""
        p = self.pieces.toDF(*[f"{tag}{c}" for c in self.pieces.columns])
        d = F.broadcast(self.days.toDF(*[f"{tag}{c}" for c in self.days.columns]))
        # pieces are the size of the governed assignments; no hint: Spark broadcasts them if they are small
        out = df.withColumn(f"{tag}_on", day)
        out = out.join(p, (F.col(person) == F.col(f"{tag}_pp_person"))
                       & F.col(f"{tag}_on").between(F.col(f"{tag}_pp_from"), F.col(f"{tag}_pp_to")), "left")
        followed = F.coalesce(F.col(f"{tag}_pp_class"), F.lit(self.default))
        return out.join(d, (followed == F.col(f"{tag}_cd_class")) & (F.col(f"{tag}_on") == F.col(f"{tag}_cd_day")), "left")

    @staticmethod
    def _total(tag: str, unit: str) -> Column:
        return F.col(f"{tag}_cd_{unit}") + F.coalesce(F.col(f"{tag}_pp_{unit}"), F.lit(0))

    def business_time(self, df: DataFrame, start: str, end: str, person: str, minutes_col: str = "sla_minutes",
                      text_col: str | None = "sla_text") -> DataFrame:
        """Working minutes of ``person`` from ``start`` to ``end``, signed, as ``calendar.business_time`` has them."""
        keep = df.columns
        last = F.lit(self.span[1])
        for tag, moment in (("_s", start), ("_e", end)):
            day = F.to_date(F.col(moment))
            df = self._place(df, person, F.when(day < last, day), tag)  # the day that ends the totals is none

        def position(tag: str, moment: str) -> Column:
            of_day = F.hour(F.col(moment)) * 60 + F.minute(F.col(moment))
            inside = F.least(F.greatest(of_day, F.col(f"{tag}_cd_start")), F.col(f"{tag}_cd_end")) - F.col(f"{tag}_cd_start")
            return self._total(tag, "minutes") + F.when(F.col(f"{tag}_cd_open"), inside).otherwise(F.lit(0))

        minutes = (position("_e", end) - position("_s", start)).cast("long")
        extra = [minutes.alias(minutes_col)] + ([duration_text(minutes).alias(text_col)] if text_col else [])
        return df.select(*keep, *extra)

    def worked_days(self, periods: DataFrame, first: str, after: str, person: str, out: str = "worked_days") -> DataFrame:
        """Working days of ``person`` from day ``first`` up to the day before ``after``, inside the calendar."""
        keep = periods.columns
        df = self._place(periods, person, _within(F.col(first), self.span), "_s")
        df = self._place(df, person, _within(F.col(after), self.span), "_e")
        return df.select(*keep, (self._total("_e", "days") - self._total("_s", "days")).cast("long").alias(out))

    def worked_weeks(self, orders: DataFrame, person: str = "_aprovador", day: str = "data_aprovacao") -> DataFrame:
        """YearWeek, person, worked_days of every ISO week from a person's first approval to the last,
        weeks without approvals included."""
        people = orders.groupBy(person).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi")).where(F.col("_lo").isNotNull())
        monday = lambda c: F.date_sub(F.col(c), F.weekday(F.col(c)))
        weeks = people.select(person, F.explode(F.sequence(monday("_lo"), monday("_hi"), F.expr("INTERVAL 7 DAYS"))).alias("_week"))
        weeks = weeks.withColumns({"_after": F.date_add("_week", 7), "YearWeek": iso_year_week("_week")})
        return self.worked_days(weeks, "_week", "_after", person).select("YearWeek", person, "worked_days")
