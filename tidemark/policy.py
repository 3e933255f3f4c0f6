"""Parameters of the event-time policy, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass

# Default policy in seconds and the normal heart-rate band.
OUT_OF_ORDERNESS_SECONDS = 300
ALLOWED_LATENESS_SECONDS = 3600
WINDOW_SECONDS = 86_400
FLUSH_INTERVAL_SECONDS = 30
NORMAL_MIN = 60
NORMAL_MAX = 100
EXTREME_LATE_SECONDS = 3600


@dataclass(frozen=True)
class EventTimePolicy:
    """How far the watermark trails, how long windows wait, how wide they are.

    Windows are aligned to the epoch, so a width of one day means UTC midnight
    to UTC midnight whatever the session time zone is.
    """

    out_of_orderness: int = OUT_OF_ORDERNESS_SECONDS
    allowed_lateness: int = ALLOWED_LATENESS_SECONDS
    window: int = WINDOW_SECONDS

    def __post_init__(self) -> None:
        if self.out_of_orderness < 0 or self.allowed_lateness < 0:
            raise ValueError("out_of_orderness and allowed_lateness must not be negative")
        if self.window <= 0:
            raise ValueError("window must be positive")
