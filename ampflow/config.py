"""Parameters of the models. Everything that a run may vary is passed in, never read from a clock."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

ALL_CITIES = "_ALL_CITIES_"


@dataclass(frozen=True)
class BoundingBox:
    """Inclusive box a charger must lie in. Switzerland."""

    lat_min: float = 45.817995
    lat_max: float = 47.808455
    lon_min: float = 5.955911
    lon_max: float = 10.492294


@dataclass(frozen=True)
class Band:
    """Ordered thresholds: the first ``value < limit`` wins, otherwise ``default``."""

    limits: tuple[tuple[float, str], ...]
    default: str


# Labels and limits of the lifecycle bands.
TENURE_BAND = Band(
    ((30, "New (< 30 days)"), (90, "Recent (30-90 days)"), (365, "Established (90-365 days)")),
    "Veteran (1+ year)",
)
AGE_BAND = Band(
    ((90, "New (< 90 days)"), (365, "Recent (90-365 days)"), (730, "Established (1-2 years)")),
    "Mature (2+ years)",
)
MARKET_BAND = Band(
    ((2, "Emerging Market"), (5, "Small Market"), (10, "Medium Market")),
    "Large Market",
)


@dataclass(frozen=True)
class Run:
    """One run: ``as_of`` is "today" for relative attributes, ``run_ts`` stamps audit columns."""

    as_of: date
    run_ts: datetime
    box: BoundingBox = field(default_factory=BoundingBox)

    def today(self) -> Column:
        return F.lit(self.as_of)

    def stamp(self) -> Column:
        return F.lit(self.run_ts.isoformat(sep=" ")).cast("timestamp_ntz")


@dataclass(frozen=True)
class Reporting:
    """Date windows of the dashboard, all derived from the last day with data."""

    data_end: date

    @property
    def current_start(self) -> date:
        return self.data_end.replace(day=1)

    @property
    def previous_end(self) -> date:
        return self.current_start - timedelta(days=1)

    @property
    def previous_start(self) -> date:
        return self.previous_end.replace(day=1)

    @property
    def trend_start(self) -> date:
        return self.data_end - timedelta(days=89)


# Default calendar span (end exclusive) and last day with data.
SPINE_START = date(2020, 1, 1)
SPINE_END = date(2030, 12, 31)
DEFAULT_DATA_END = date(2025, 5, 31)
