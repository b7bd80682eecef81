"""Parameters of the batch and live paths, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# The weekly grid and the formats' constants.
SLOTS_PER_WEEK = 2016
SLOTS_PER_DAY = 288
SLOT_MINUTES = 5
COEFFICIENTS = 200
UNKNOWN_RAW_SPEED = 127
MAX_CONGESTION = 63
INVALID_RECORD = (1 << 28) - 1
TILE_VERSION = 4
EARTH_RADIUS_KM = 6378.1
WGS84_FLATTENING = 1 / 298.257223563


@dataclass(frozen=True)
class Params:
    # cleaning
    start_reference: str = "2025-02-03 00:00:00"
    utc_shift_s: int = 28_800
    fare_upper_bound: float = 700.0
    near_same_deg: float = 0.001
    coordinate_digits: int = 5
    outlier_columns: tuple[str, ...] = ("fare", "distance")
    # trips and speeds
    min_points: int = 10
    min_kph: float = 5.0
    max_kph: float = 150.0
    max_gap_s: float = 10.0
    sampling_rate: float = 1.0
    # filling and profiles
    neighbor_size: int = 3
    hampel_window: int = 15
    hampel_sigmas: float = 2.5
    mad_scale: float = 1.4826
    iqr_factor: float = 1.5
    default_speed_factor: float = 0.8
    freeflow_kph: float = 50.0
    constrained_kph: float = 40.0
    percentile: float = 0.95
    off_peak_hours: tuple[int, ...] = (0, 1, 2, 3, 4, 5, 22, 23)
    exclude_tunnels: bool = False
    strict_edges: bool = False
    encode: bool = True
    # live
    interval_s: int = 5
    window_s: int = 60
    weight_floor: float = 0.1
    csv_window_s: int = 300
    lat_range: tuple[float, float] = (22.0, 22.6)
    lon_range: tuple[float, float] = (113.8, 114.3)
    top_kph: float = 150.0
    speed_clamp: int = 126
    fade_s: int = 3600
    min_archive_bytes: int = 512
    # rule-based speeds by road type: (free flow, constrained)
    road_speeds: dict[str, tuple[float, float]] = field(
        default_factory=lambda: {"motorway": (100.0, 80.0), "primary": (70.0, 50.0), "secondary": (60.0, 45.0), "residential": (40.0, 30.0)}
    )
