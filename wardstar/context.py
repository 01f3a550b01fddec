"""What one batch needs to know, fixed before it starts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

# Fixed value: the watermark before any load, meaning "take everything".
FIRST_WATERMARK = datetime(1900, 1, 1)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def ticking_clock(start: datetime, step: timedelta = timedelta(seconds=1)) -> Callable[[], datetime]:
    """A clock that moves one step per reading, for runs whose log must be repeatable."""
    state = {"now": start - step}

    def read() -> datetime:
        state["now"] += step
        return state["now"]

    return read


@dataclass(frozen=True)
class BatchContext:
    """Replaces session variables: every job reads dates from here, never from the clock.

    strict=True takes only encounters after the high watermark; strict=False also
    takes late ones and repairs the readmission flags they change.
    """

    batch_id: int
    as_of: date
    started_at: datetime
    strict: bool = True
    clock: Callable[[], datetime] = field(default=utc_now, compare=False)

    @classmethod
    def now(cls, batch_id: int, strict: bool = True) -> "BatchContext":
        started = utc_now()
        return cls(batch_id, started.date(), started, strict)
