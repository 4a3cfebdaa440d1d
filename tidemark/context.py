"""Parameters of one load run."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime

# Start of history and the lookback of the pulled sources.
DEFAULT_LSET = datetime(2026, 1, 1)
DEFAULT_LOOKBACK_DAYS = 3


@dataclass(frozen=True)
class RunContext:
    """Passed to operators explicitly instead of global job variables.

    ``lset`` is the last successful extraction time, ``cet`` the current one.
    """

    load_run_id: str
    started_at: datetime
    cet: datetime
    lset: datetime = DEFAULT_LSET
    lookback_days: int = DEFAULT_LOOKBACK_DAYS
    month: str = "ALL"
    # Ends of the training, validation and test periods, where a run checks for leakage.
    splits: tuple[datetime, datetime, datetime] | None = None

    @classmethod
    def start(cls, now: datetime, **over) -> RunContext:
        """Open a run at ``now``; the run id is the start time in text form."""
        run_id = over.pop("load_run_id", now.strftime("%Y%m%dT%H%M%S"))
        return cls(load_run_id=run_id, started_at=now, cet=over.pop("cet", now), **over)

    def with_watermark(self, lset: datetime, lookback_days: int | None = None) -> RunContext:
        days = self.lookback_days if lookback_days is None else lookback_days
        return replace(self, lset=lset, lookback_days=days)
