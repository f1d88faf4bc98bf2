"""Run parameters: nothing in the library reads the wall clock."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class RunParams:
    """One daily run: ``run_date`` is the day processed, ``as_of`` the day after."""

    run_date: dt.date = dt.date(2024, 1, 15)
    run_ts: dt.datetime | None = None
    lenient: bool = False
    as_of: dt.date = field(init=False)

    def __post_init__(self) -> None:
        if isinstance(self.run_date, str):
            object.__setattr__(self, "run_date", dt.date.fromisoformat(self.run_date))
        object.__setattr__(self, "as_of", self.run_date + dt.timedelta(days=1))

    def days_back(self, days: int) -> dt.date:
        """First day of an open look-back of ``days`` days before ``as_of``."""
        return self.as_of - dt.timedelta(days=days)

    @property
    def shard(self) -> str:
        return self.run_date.strftime("%Y%m%d")
