"""Which columns of an event log play which part, and how durations are written."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Window, WindowSpec

_DAYS = {"day": 1.0, "week": 7.0, "month": 30.45, "quarter": 91.0, "year": 365.0}


@dataclass(frozen=True)
class Roles:
    """Column names of an event log: who, when, and what breaks ties within a moment."""

    id: str
    date: str
    event: str

    def past(self) -> WindowSpec:
        """Rows of one id in order of time, up to the current one."""
        return self.ordered().rowsBetween(Window.unboundedPreceding, 0)

    def future(self) -> WindowSpec:
        """Rows of one id after the current one."""
        return self.ordered().rowsBetween(1, Window.unboundedFollowing)

    def ordered(self) -> WindowSpec:
        return Window.partitionBy(self.id).orderBy(self.date, self.event)

    def whole(self) -> WindowSpec:
        return Window.partitionBy(self.id)


@dataclass(frozen=True)
class PanelRoles:
    """Column names of a panel: one row for each id and period; period 0 is the newest and numbers grow into the past."""

    id: str = "id"
    period: str = "period"

    def ordered(self) -> WindowSpec:
        from pyspark.sql import functions as F

        return Window.partitionBy(self.id).orderBy(F.desc(self.period))

    def rows(self, k: int) -> WindowSpec:
        """The current period and the k - 1 before it."""
        return self.ordered().rowsBetween(1 - k, 0)


@dataclass(frozen=True)
class Duration:
    """A number of calendar units, as in "2month"."""

    count: int
    unit: str

    @staticmethod
    def parse(text: str) -> "Duration":
        m = re.fullmatch(r"\s*(\d+)\s*(day|week|month|quarter|year)s?\s*", text.lower())
        if not m:
            raise ValueError(f"not a duration: {text!r}")
        return Duration(int(m[1]), m[2])

    @property
    def days(self) -> int:
        return round(self.count * _DAYS[self.unit])

    def in_units(self, unit: str) -> float:
        """How many of another unit this is; a month has four weeks and a year twelve months."""
        if unit == self.unit:
            return float(self.count)
        weeks = {"week": 1.0, "month": 4.0, "quarter": 12.0, "year": 48.0}
        if unit in weeks and self.unit in weeks:
            return self.count * weeks[self.unit] / weeks[unit]
        return self.count * _DAYS[self.unit] / _DAYS[unit]
