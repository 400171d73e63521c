"""Calendar cohorts: a label for each trip, and the time windows the labels cover.

A label is one look-up: windows are whole days, so the day of the trip, counted from the first window,
is the place of its label in an array. The timestamp stands once in that expression, which matters
where it is computed: Catalyst copies a computed column into each place that names it, filters
included. A filter by ranges is added only where the timestamp is a stored column (``stored``), for
there it is plain number comparison that reaches the Parquet scan. Tables laid out by month (see
``sinks.monthly``) need neither, if the cohorts say so (``in_month_folders``): windows of whole
months are folder names there, and the timestamp is not read at all.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Window = tuple[date, date]  # start inclusive, end exclusive

MONTH_PARTITION = "trip_month"  # yyyymm, the folders of trip tables laid out by month


def merge_windows(windows: Iterable[Window]) -> list[Window]:
    """Sort windows and join those that touch or overlap."""
    merged: list[Window] = []
    for start, end in sorted(windows):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def months_touched(windows: Iterable[Window]) -> list[int]:
    """The yyyymm numbers of all months that share a day with a window."""
    found = set()
    for start, end in windows:
        day = start.replace(day=1)
        while day < end:
            found.add(day.year * 100 + day.month)
            day = _next_month(day)
    return sorted(found)


def in_windows(column: str, windows: Iterable[Window]) -> Column:
    """True where the timestamp lies in a window; NULL timestamps are not in any.

    The bounds are text, so Catalyst folds them to the column's own timestamp type (with or
    without zone) and the comparison stays a plain, pushable one.
    """
    ts = F.col(column)
    ranges = [
        (ts >= F.lit(f"{start} 00:00:00")) & (ts < F.lit(f"{end} 00:00:00"))
        for start, end in windows
    ]
    return reduce(or_, ranges)


def whole_months(windows: Iterable[Window]) -> bool:
    return all(start.day == 1 and end.day == 1 for start, end in windows)


def member(column: str, windows: list[Window], month_column: str | None = None) -> Column:
    """In-window test, on the yyyymm column where there is one for the same timestamp."""
    if month_column is None:
        return in_windows(column, windows)
    in_months = F.col(month_column).isin(*months_touched(windows))
    return in_months if whole_months(windows) else in_months & in_windows(column, windows)


def label_by_day(timestamp: str, windows: Mapping[str, Sequence[Window]]) -> Column:
    """The first label with the timestamp's day in its windows, NULL without one, by one look-up.

    A number for each day from the first window to the last, 366 a year: a literal that the optimizer
    makes once. It takes half the time of a search among the windows' bounds, which only
    higher-order functions can express without naming the timestamp again.
    """
    if not any(windows.values()):
        return F.lit(None).cast("string")
    first = min(start for spans in windows.values() for start, _ in spans)
    last = max(end for spans in windows.values() for _, end in spans)
    places = ["-1"] * (last - first).days
    for place, spans in reversed(list(enumerate(windows.values()))):
        for start, end in spans:
            places[(start - first).days : (end - first).days] = [str(place)] * (end - start).days
    by_day = F.split(F.lit(",".join(places)), ",").cast("array<int>")
    day = F.unix_date(F.to_date(timestamp)) - (first - date(1970, 1, 1)).days
    return F.get(F.array(*map(F.lit, windows)), F.get(by_day, day))


@dataclass(frozen=True)
class MonthCohorts:
    """Cohorts as sets of calendar months, inside whole calendar years.

    January belongs to the same calendar year as the filter says: the first year's January
    counts although the December before it does not.
    """

    months: Mapping[str, tuple[int, ...]]
    years: tuple[int, ...]
    column: str = "study_period"
    other: str = "Other"
    month_column: str | None = None
    stored: bool = True

    @property
    def labels(self) -> tuple[str, ...]:
        return tuple(self.months)

    def label(self, timestamp: str) -> Column:
        of_month = [next((name for name, group in self.months.items() if m in group), self.other) for m in range(1, 13)]
        return F.coalesce(F.get(F.array(*map(F.lit, of_month)), F.month(timestamp) - 1), F.lit(self.other))

    def windows(self, label: str) -> list[Window]:
        firsts = [date(year, month, 1) for year in self.years for month in self.months[label]]
        return merge_windows((first, _next_month(first)) for first in firsts)


@dataclass(frozen=True)
class DateCohorts:
    """Cohorts as date ranges that include both end dates, up to their last instant."""

    ranges: Mapping[str, tuple[date, date]]
    column: str = "period"
    other: str = "Outside Study Period"
    month_column: str | None = None
    stored: bool = True

    @property
    def labels(self) -> tuple[str, ...]:
        return tuple(self.ranges)

    def label(self, timestamp: str) -> Column:
        return F.coalesce(label_by_day(timestamp, _by_label(self)), F.lit(self.other))

    def windows(self, label: str) -> list[Window]:
        first, last = self.ranges[label]
        return [(first, last + timedelta(days=1))]


Cohorts = MonthCohorts | DateCohorts


def in_month_folders(cohorts: Cohorts) -> Cohorts:
    """The same cohorts, for a table that ``sinks.monthly`` laid out."""
    return replace(cohorts, month_column=MONTH_PARTITION)


def all_windows(cohorts: Cohorts) -> list[Window]:
    return merge_windows(window for label in cohorts.labels for window in cohorts.windows(label))


def _by_label(cohorts: Cohorts) -> dict[str, list[Window]]:
    return {label: cohorts.windows(label) for label in cohorts.labels}


def select_cohorts(trips: DataFrame, timestamp: str, cohorts: Cohorts) -> DataFrame:
    """Keep the trips of the cohorts and add the cohort column.

    Gives the labels of ``cohorts.label`` for the trips it keeps. The look-up filters and labels; by
    month folders the folder does both, unless a window covers a part of a month only.
    """
    windows, month = all_windows(cohorts), cohorts.month_column
    if month and whole_months(windows):
        by_label = {label: F.col(month).isin(*months_touched(spans)) for label, spans in _by_label(cohorts).items()}
        label = F.coalesce(*[F.when(inside, name) for name, inside in by_label.items()])
        return trips.filter(member(timestamp, windows, month)).withColumn(cohorts.column, label)
    if month or cohorts.stored:
        trips = trips.filter(member(timestamp, windows, month))
    label = label_by_day(timestamp, _by_label(cohorts))
    return trips.filter(label.isNotNull()).withColumn(cohorts.column, label)


def _next_month(day: date) -> date:
    return date(day.year + day.month // 12, day.month % 12 + 1, 1)
