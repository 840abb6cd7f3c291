"""Settings shared by the jobs. Plain values, no cluster role."""

from __future__ import annotations

from dataclasses import dataclass

# Classes in order of pressure.
CLASS_LABELS = ("Low", "Medium", "High")

# Weather assumed for a scenario, by preset name.
WEATHER_FIELDS = (
    "temperature_2m", "relative_humidity_2m", "precipitation", "surface_pressure",
    "wind_speed_10m", "wind_speed_max", "wind_gusts_10m", "cloud_cover",
    "is_severe_weather", "is_raining",
)
WEATHER_PRESETS = {
    "clear": (18.0, 55.0, 0.0, 1018.0, 8.0, 14.0, 18.0, 15.0, 0, 0),
    "windy": (14.0, 60.0, 0.0, 1010.0, 28.0, 42.0, 55.0, 50.0, 0, 0),
    "rain": (11.0, 85.0, 6.5, 1005.0, 18.0, 28.0, 35.0, 95.0, 0, 1),
    "storm": (9.0, 92.0, 22.0, 995.0, 42.0, 65.0, 85.0, 100.0, 1, 1),
}
DEFAULT_PRESET = "clear"
PRESET_WIND_DIRECTION = 220.0

# Yearly public holidays without the movable feasts.
HOLIDAYS = (
    ("01-01", "New Year's Day"),
    ("01-06", "Epiphany"),
    ("05-01", "Labour Day"),
    ("08-15", "Assumption of Mary"),
    ("10-12", "Hispanic Day"),
    ("11-01", "All Saints Day"),
    ("12-06", "Constitution Day"),
    ("12-08", "Immaculate Conception"),
    ("12-25", "Christmas Day"),
)

# Columns of a positional state vector with their Spark types.
STATE_VECTOR_FIELDS = (
    ("icao24", "string"), ("callsign", "string"), ("origin_country", "string"),
    ("time_position", "bigint"), ("last_contact", "bigint"),
    ("longitude", "double"), ("latitude", "double"), ("baro_altitude", "double"),
    ("on_ground", "boolean"), ("velocity", "double"), ("true_track", "double"),
    ("vertical_rate", "double"), ("sensors", "string"), ("geo_altitude", "double"),
    ("squawk", "string"), ("spi", "boolean"), ("position_source", "int"),
)


@dataclass(frozen=True)
class Settings:
    movement_weight: float = 0.6
    pressure_weight: float = 0.4
    low_percentile: float = 0.60
    high_percentile: float = 0.85
    fixed_low: float = 65.0
    fixed_high: float = 75.0
    score_digits: int = 6

    hourly_lags: tuple[int, ...] = (1, 2, 3, 6, 12, 24, 48, 168)
    hourly_mean_windows: tuple[int, ...] = (3, 6, 24)
    hourly_std_windows: tuple[int, ...] = (24,)
    daily_lags: tuple[int, ...] = (1, 2, 3, 7, 14, 28, 365)
    daily_exempt_lags: tuple[int, ...] = (365,)
    daily_mean_windows: tuple[int, ...] = (7, 14, 28)
    daily_std_windows: tuple[int, ...] = (28,)
    year_lag: int = 365
    horizons: tuple[int, ...] = (1, 3)

    train_share: float = 0.70
    valid_share: float = 0.15

    centre_lat: float = 40.4936
    centre_lon: float = -3.5668
    box_north: float = 41.21
    box_south: float = 39.78
    box_east: float = -2.63
    box_west: float = -4.50
    bands_km: tuple[tuple[str, float, float], ...] = (
        ("inner", 0.0, 15.0), ("middle", 15.0, 40.0), ("outer", 40.0, 80.0),
    )

    error_steps: tuple[float, ...] = (0.25, 0.5, 1.0, 1.5, 2.0, 3.0)
    interval_factor: float = 1.96


DEFAULTS = Settings()

# The lighter of the two known settings of boosted trees (``models.boosted_regressor`` defaults to the
# other), the columns that days are clustered by, the outside series of the autoregression.
LIGHT = {"rounds": 100, "depth": 3, "step": 0.1, "leaf": 2}
CLUSTERED = ("total_movements", "arrivals", "departures", "dow", "month", "is_weekend", "is_holiday")
EXOG = ("temperature_2m", "wind_speed_10m", "precipitation")
