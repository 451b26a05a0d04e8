"""Fixed domain values: pollutants, plausibility limits, index breakpoints."""

from __future__ import annotations

from typing import NamedTuple


class Spec(NamedTuple):
    """Expected unit and inclusive plausible range of one pollutant."""

    unit: str
    low: float
    high: float


class Band(NamedTuple):
    """One breakpoint row: concentrations c_low..c_high map to index i_low..i_high."""

    c_low: float
    c_high: float
    i_low: int
    i_high: int


# Fixed values, must equal the published rules: unit and plausible range per pollutant.
SPECS: dict[str, Spec] = {
    "pm25": Spec("µg/m³", 0.0, 1000.0),
    "pm10": Spec("µg/m³", 0.0, 2000.0),
    "no2": Spec("µg/m³", 0.0, 3000.0),
    "o3": Spec("µg/m³", 0.0, 1000.0),
    "so2": Spec("µg/m³", 0.0, 3000.0),
    "co": Spec("mg/m³", 0.0, 100.0),
}

PARAMETERS: tuple[str, ...] = tuple(SPECS)

# Fixed values, must equal the published rules: AQI breakpoints per pollutant.
AQI_BANDS: dict[str, list[Band]] = {
    "pm25": [
        Band(0.0, 12.0, 0, 50),
        Band(12.1, 35.4, 51, 100),
        Band(35.5, 55.4, 101, 150),
        Band(55.5, 150.4, 151, 200),
        Band(150.5, 250.4, 201, 300),
        Band(250.5, 500.4, 301, 500),
    ],
    "pm10": [
        Band(0.0, 54.0, 0, 50),
        Band(55.0, 154.0, 51, 100),
        Band(155.0, 254.0, 101, 150),
        Band(255.0, 354.0, 151, 200),
        Band(355.0, 424.0, 201, 300),
        Band(425.0, 604.0, 301, 500),
    ],
    "o3": [
        Band(0.0, 100.0, 0, 50),
        Band(101.0, 160.0, 51, 100),
        Band(161.0, 215.0, 101, 150),
        Band(216.0, 265.0, 151, 200),
        Band(266.0, 800.0, 201, 300),
    ],
    "no2": [
        Band(0.0, 100.0, 0, 50),
        Band(101.0, 200.0, 51, 100),
        Band(201.0, 700.0, 101, 150),
        Band(701.0, 1200.0, 151, 200),
        Band(1201.0, 2350.0, 201, 300),
    ],
    "so2": [
        Band(0.0, 100.0, 0, 50),
        Band(101.0, 200.0, 51, 100),
        Band(201.0, 500.0, 101, 150),
        Band(501.0, 1000.0, 151, 200),
        Band(1001.0, 2000.0, 201, 300),
    ],
    "co": [
        Band(0.0, 5.0, 0, 50),
        Band(5.1, 10.0, 51, 100),
        Band(10.1, 14.0, 101, 150),
        Band(14.1, 17.0, 151, 200),
        Band(17.1, 34.0, 201, 300),
    ],
}

UNKNOWN_AQI = -1

# Inclusive upper index of each health category, in order.
AQI_CATEGORIES: list[tuple[int, str]] = [
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
]
TOP_CATEGORY = "Hazardous"
UNKNOWN_CATEGORY = "Unknown"

# Validation codes and their messages, 0 is a valid reading.
REASONS: dict[int, str] = {
    0: "valid",
    1: "unknown pollutant parameter",
    2: "value is NaN, infinite or negative",
    3: "value outside plausible range for pollutant",
    4: "unit does not match expected unit",
    5: "latitude/longitude outside WGS84 bounds",
}
UNKNOWN_REASON = "unknown reason"

LATITUDE_LIMIT = 90.0
LONGITUDE_LIMIT = 180.0

# Defaults of the collector and of the stream reader.
WINDOW_SIZE = "10 seconds"
ROLLING_SPAN = "5 minutes"
RECENT_BATCHES = 64
TOP_STATIONS = 10
