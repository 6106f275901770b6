"""Thresholds and city parameters shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

# The thresholds results depend on.
SEGMENT_LENGTH_M = 200.0
TIMESLOT_MINUTES = 15
EARTH_RADIUS_M = 6371000.0
MAX_TIME_GAP_SEC = 600
MIN_GAP_CADENCE_FRACTION = 0.5
MAX_SPEED_KMH = 100.0
BACKWARD_TOLERANCE_M = 50.0
SEARCH_MARGIN_M = 300.0
VALIDATION_DIFF_KMH = 20.0
PERIOD_TOLERANCE_PCT = 0.5
REDUCED_SERVICE_PCT = 80.0
MIN_SAMPLES = 2
COORD_DECIMALS = 5
SIMPLIFY_TOLERANCE_M = 5.0
SLOWDOWN_RATIO_MAX = 0.7
SLOWDOWN_ABS_MIN_KMH = 4.0
BASELINE_MIN_SLOTS = 15
INCOMPLETE_COVERAGE_PCT = 99.0
GAP_MULTIPLIER = 3.0
HEARTBEAT_PARTIAL_SEC = 120
BBOX_MARGIN_DEG = 0.04
MANIFEST_SCHEMA_VERSION = 2
KMH_PER_MS = 3.6

# Windows of the time-of-day analysis, local HH:MM, inclusive.
MORNING_PEAK = "08:00"
MIDDAY = "12:00"
EVENING_PEAK = "17:15"
NIGHT_WINDOW = ("00:00", "03:45")
DAY_WINDOW = ("07:00", "18:45")
CORE_WINDOW = ("07:00", "19:00")
PERSISTENCE_CUTS_KMH = (10.0, 15.0, 20.0)
SOLID_MIN_SEGMENTS = 1000


@dataclass(frozen=True)
class WalkParams:
    """Parameters of the trip walk; defaults are the fixed values above."""

    poll_interval_sec: float = 45.0
    min_gap_fraction: float = MIN_GAP_CADENCE_FRACTION
    max_gap_sec: float = MAX_TIME_GAP_SEC
    max_speed_kmh: float = MAX_SPEED_KMH
    backward_tolerance_m: float = BACKWARD_TOLERANCE_M
    search_margin_m: float = SEARCH_MARGIN_M
    segment_length_m: float = SEGMENT_LENGTH_M
    timezone: str = "UTC"
    speed_field_unit: str = "kmh"

    @property
    def min_gap_sec(self) -> float:
        return self.poll_interval_sec * self.min_gap_fraction

    @property
    def max_speed_ms(self) -> float:
        return self.max_speed_kmh / KMH_PER_MS


@dataclass(frozen=True)
class City:
    """One network's parameters; `operators.quality.city_violations` checks many."""

    slug: str
    timezone: str
    poll_interval_sec: int
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float
    speed_field_unit: str = "kmh"

    def walk_params(self) -> WalkParams:
        return WalkParams(
            poll_interval_sec=self.poll_interval_sec,
            timezone=self.timezone,
            speed_field_unit=self.speed_field_unit,
        )
