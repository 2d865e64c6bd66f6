"""Feature parameters shared by batch and streaming code paths."""

from __future__ import annotations

from dataclasses import dataclass, replace

_UNIT_SECONDS = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60,
                 "hour": 3600, "hours": 3600, "day": 86400, "days": 86400}


def interval_seconds(interval: str) -> int:
    """'15 minutes' -> 900 (the interval strings used for window geometry)."""
    n, unit = interval.split()
    return int(n) * _UNIT_SECONDS[unit]


@dataclass(frozen=True)
class FeatureSpec:
    """What counts as a click / view / engagement, and the window geometry.

    ``case_sensitive=False`` is the streaming rule (event types compared
    ignoring case); the pandas batch job compares them exactly, which is
    ``case_sensitive=True``.
    """

    click_types: tuple[str, ...] = ("click",)
    view_types: tuple[str, ...] = ("view",)
    engagement_types: tuple[str, ...] = ("like", "share")
    case_sensitive: bool = False
    user_window: str = "1 hour"
    content_window: str = "15 minutes"
    content_slide: str = "5 minutes"
    affinity_window: str = "1 hour"
    watermark_delay_s: int = 30
    affinity_prefix: str = "category_affinity_"
    unknown_category: str = "unknown"

    def batch(self) -> "FeatureSpec":
        """The batch job's variant: exact (case-sensitive) type matching."""
        return replace(self, case_sensitive=True)

    def with_delay(self, seconds: int) -> "FeatureSpec":
        return replace(self, watermark_delay_s=int(seconds))


# The wire contract's event types (click/view/like/share).
WIRE_SPEC = FeatureSpec()

# The driver tables carry no like/share; purchase and signup stand in.
DRIVER_SPEC = FeatureSpec(engagement_types=("purchase", "signup"))
