"""The 28-day run window.

The run date names the window's END; the start is four weeks earlier. Facts are kept when their
timestamp lies BETWEEN the two dates, which for a timestamp means from midnight of the first day up
to and including midnight (only) of the last day. Date columns include the whole last day.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW_WEEKS = 4


@dataclass(frozen=True)
class RunWindow:
    start: dt.date
    end: dt.date

    @classmethod
    def ending(cls, run_date: str | dt.date, weeks: int = WINDOW_WEEKS) -> "RunWindow":
        end = dt.date.fromisoformat(run_date) if isinstance(run_date, str) else run_date
        return cls(start=end - dt.timedelta(weeks=weeks), end=end)

    @property
    def start_iso(self) -> str:
        return self.start.isoformat()

    @property
    def end_iso(self) -> str:
        return self.end.isoformat()

    def timestamps(self, column: str | Column) -> Column:
        """Inclusive BETWEEN on a timestamp column: [start 00:00:00, end 00:00:00]."""
        c = F.col(column) if isinstance(column, str) else column
        return c.between(
            F.to_timestamp(F.lit(f"{self.start_iso} 00:00:00")),
            F.to_timestamp(F.lit(f"{self.end_iso} 00:00:00")),
        )

    def days(self, column: str | Column) -> Column:
        """The days whose rows can lie in the window, one more at each end: a day folder may follow another time zone."""
        c = F.col(column) if isinstance(column, str) else column
        day = dt.timedelta(days=1)
        return c.between(F.lit(self.start - day), F.lit(self.end + day))

    def dates(self, column: str | Column) -> Column:
        """Inclusive BETWEEN on a date column: both end days count whole."""
        c = F.col(column) if isinstance(column, str) else column
        return c.between(F.lit(self.start), F.lit(self.end))


# Run date of the test bindings (FIXTURES.md): window 2024-01-01 .. 2024-01-29.
TEST_RUN_DATE = "2024-01-29"
