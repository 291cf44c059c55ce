"""Latest-snapshot and report-date filters (OP-02, OP-03, OP-29)."""

from __future__ import annotations

import datetime as _dt
import threading
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.sources.sinks import Workspace, materialise, run_concurrently


def scalar_value(df: DataFrame, expr: Column) -> Column:
    """Uncorrelated scalar subquery: one value, NULL on empty input, error on >1 row."""
    return df.select(expr).scalar()


SUBQUERY = object()  # default of ``latest``: plan the maximum as a scalar subquery


def period_start(value: _dt.date, grain: str) -> _dt.date:
    return _dt.date(value.year, 1 if grain == "year" else value.month, 1)


def period_after(period: _dt.date, grain: str, steps: int = 1) -> _dt.date | None:
    """Start of the calendar year or month ``steps`` after ``period`` (None beyond the calendar)."""
    months = (period.year * 12 + period.month - 1) + steps * (12 if grain == "year" else 1)
    return _dt.date(months // 12, months % 12 + 1, 1) if months // 12 <= _dt.MAXYEAR else None


@dataclass
class DateColumn:
    """A date column of a table, and the latest calendar year or month that its rows reach.

    The latest period is found from file statistics: a few rows give a period
    that exists, and rows of later ones are asked for by range filters that
    the scan checks against the statistics of its row groups, the furthest
    range first.  Row groups without later rows are skipped unread, so where
    the first rows already tell the latest period only these are read.  A
    source without statistics is scanned by the same filters, and the answer
    is the same.  Found once per bound and shared by all sources of the column.
    """

    table: DataFrame
    date: str
    grain: str
    probe_rows: int = 1000
    steps: tuple[int, ...] = (16, 4, 1)     # periods after the known one, asked for in this order
    _known: dict = field(default_factory=dict)
    _lock: threading.Lock = field(default_factory=threading.Lock)

    def latest(self, before: _dt.date | None = None) -> _dt.date | None:
        """Start of the latest period (of those before ``before``), None without dates."""
        with self._lock:
            if before not in self._known:
                self._known[before] = self._find(before)
            return self._known[before]

    def _find(self, before: _dt.date | None) -> _dt.date | None:
        dates = self.table.where(f"{self.date} IS NOT NULL").selectExpr(f"{self.date} AS _at")
        if before is not None:
            dates = dates.where(f"_at < DATE'{before}'")
        probe = dates.limit(self.probe_rows).selectExpr("CAST(max(_at) AS DATE)").first()[0]
        if probe is None:
            return None
        known = period_start(probe, self.grain)
        for start in (period_after(known, self.grain, n) for n in self.steps):
            if start is None or before is not None and start >= before:
                continue
            later = dates.where(f"_at >= DATE'{start}'").selectExpr("CAST(max(_at) AS DATE)").first()[0]
            if later is not None:       # the greatest of all dates
                return period_start(later, self.grain)
        return known


class Periodic:
    """A source with a ``period`` column that can be read one period at a time."""

    def frame(self) -> DataFrame:
        """All periods."""
        raise NotImplementedError

    def at(self, period: _dt.date) -> DataFrame:
        """The rows of one period."""
        raise NotImplementedError

    def latest(self) -> _dt.date | None:
        """The latest period that has rows."""
        return self.frame().selectExpr("max(period)").first()[0]


@dataclass(frozen=True)
class PeriodSource(Periodic):
    """A source whose ``period`` is the calendar year or month of a date column of its base table.

    ``rows(predicate)`` builds the source from the base rows that satisfy an SQL
    predicate; it may join and aggregate.  A period read with ``at`` is also
    stated as a range of the base column, which reaches the scan (pushed
    filter, row-group pruning) below any join of the builder; the period itself
    is an expression and never could.

    With ``column`` the latest period comes from that column of the base table.
    Set ``complete`` to False where the builder may drop base rows (an inner
    join, a filter): a period is then taken only if it has rows.
    """

    rows: Callable[[str], DataFrame]
    date: str
    grain: str
    column: DateColumn | None = None
    complete: bool = True

    def frame(self) -> DataFrame:
        return self.rows("TRUE")

    def at(self, period: _dt.date) -> DataFrame:
        end = period_after(period, self.grain)
        below = f" AND {self.date} < DATE'{end}'" if end else ""
        return self.rows(f"{self.date} >= DATE'{period}'{below}").where(F.col("period") == F.lit(period))

    def latest(self) -> _dt.date | None:
        if self.column is None:
            return super().latest()
        return latest_with_rows(self.column, None if self.complete else self.at)


def latest_with_rows(column: DateColumn, at: Callable[[_dt.date], DataFrame] | None) -> _dt.date | None:
    """The latest period of ``column`` whose rows (``at``, if given) are not empty."""
    period = column.latest()
    while period is not None and at is not None and at(period).isEmpty():
        period = column.latest(before=period)
    return period


@dataclass(frozen=True)
class StagedPeriods(Periodic):
    """A ``PeriodSource`` whose periods are written to the shared folder when they are first asked for.

    For builders with an expensive join that several sources read
    (``DerivedPeriods``): only the periods in use are joined and written.
    """

    source: PeriodSource
    name: str
    work: Workspace
    _tables: dict = field(default_factory=dict)
    _lock: threading.RLock = field(default_factory=threading.RLock)

    def frame(self) -> DataFrame:
        return self.source.frame()

    def at(self, period: _dt.date) -> DataFrame:
        with self._lock:
            if period not in self._tables:
                self._tables[period] = materialise(self.source.at(period), "table", self.name, self.work)
            return self._tables[period]

    def latest(self) -> _dt.date | None:
        if self.source.column is None:
            return self.source.latest()
        return latest_with_rows(self.source.column, None if self.source.complete else self.at)


@dataclass(frozen=True)
class DerivedPeriods(Periodic):
    """A source made from the rows of another one, period by period."""

    of: Periodic
    make: Callable[[DataFrame], DataFrame]

    def frame(self) -> DataFrame:
        return self.make(self.of.frame())

    def at(self, period: _dt.date) -> DataFrame:
        return self.make(self.of.at(period))

    def latest(self) -> _dt.date | None:
        return self.of.latest()


def rows_of(source) -> DataFrame:
    """A source as one DataFrame."""
    return source if isinstance(source, DataFrame) else source.frame()


def latest_in_grain(df: DataFrame, date_col: str, grain: str) -> DataFrame:
    """Rows of the latest calendar year or month of a date column, as a lower bound on that column.

    The bound is a scalar subquery; Spark fills in its value before the scan
    starts and pushes it down.
    """
    start = df.selectExpr(f"CAST(trunc(to_date(max({date_col})), '{grain}') AS {df.schema[date_col].dataType.simpleString()})")
    return df.where(F.col(date_col) >= start.scalar())


def latest_snapshot(df: DataFrame | Periodic, period_col: str, latest=SUBQUERY) -> DataFrame:
    """Rows whose period equals the table's own maximum period.

    Without ``latest`` it is planned as a scalar subquery in the filter, not as
    a window: the max is one partial/final aggregate over the pruned period
    column, and on a period-partitioned table the filter becomes a runtime
    partition filter.  With ``latest`` (the same maximum, computed beforehand
    for several sources at once by ``latest_periods``) the filter is a literal:
    statically pruned and pushed down.  A NULL maximum (empty source) keeps no
    rows either way.  Apply it to the table as read, before any other
    predicate, because the maximum is taken over whatever ``df`` contains.
    """
    if isinstance(df, Periodic):
        if latest is SUBQUERY and isinstance(df, DerivedPeriods):
            latest = df.latest()        # its join is made for that period only
        df = df.frame() if latest is SUBQUERY or latest is None else df.at(latest)
    if latest is SUBQUERY:
        latest = df.selectExpr(f"max({period_col})").scalar()
        return df.where(F.col(period_col) == latest)
    if latest is None:
        return df.where(F.lit(False))
    return df.where(F.col(period_col) == F.lit(latest))


def latest_periods(sources: Mapping[str, tuple[DataFrame | Periodic, str]]) -> dict:
    """The maximum period of several sources, found side by side.

    A source with a ``DateColumn`` asks its statistics; any other is one global
    aggregate (one row, NULL when empty).  Each is its own small job, all
    submitted together from driver threads; every maximum keeps its column's
    type.  As many values reach the driver as there are sources.
    """
    def latest(source, period_col: str):
        if isinstance(source, Periodic):
            return source.latest()
        return source.selectExpr(f"max({period_col})").first()[0]

    names = list(sources)
    return dict(zip(names, run_concurrently([lambda n=n: latest(*sources[n]) for n in names], max_workers=8)))


def _date(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, (_dt.date, _dt.datetime)):
        return F.lit(value).cast("date")
    return F.to_date(F.lit(str(value)))


def as_of(df: DataFrame, end_col: str, report_date) -> DataFrame:
    """Rows that ended on or before the report date (inclusive bound)."""
    return df.where(F.col(end_col) <= _date(report_date))
