"""Air-quality index expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbsight.functions.common import band

# PM2.5 segments as (concentration from, to, index from, to). The last one is open.
PM25_SEGMENTS = (
    (0.0, 12.0, 0.0, 50.0),
    (12.0, 35.4, 50.0, 100.0),
    (35.4, 55.4, 100.0, 150.0),
    (55.4, 150.4, 150.0, 200.0),
)

# Published EPA PM10 breakpoints (24 h, whole micrograms).
PM10_SEGMENTS = (
    (0, 54, 0, 50),
    (55, 154, 51, 100),
    (155, 254, 101, 150),
    (255, 354, 151, 200),
    (355, 424, 201, 300),
    (425, 504, 301, 400),
    (505, 604, 401, 500),
)

# Index category limits.
CATEGORY_LIMITS = (
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
)
ABOVE_ALL_CATEGORIES = "Very Unhealthy"

# Six-step report bands.
REPORT_LIMITS = (*CATEGORY_LIMITS, (300, "Very Unhealthy"))
ABOVE_ALL_REPORT_BANDS = "Hazardous"


def pm25_index(pm25: Column) -> Column:
    """Piecewise-linear index, cut to a whole number towards zero."""
    index: Column | None = None
    for low, high, index_low, index_high in reversed(PM25_SEGMENTS):
        slope = (index_high - index_low) / (high - low)
        line = F.lit(index_low) + F.lit(slope) * (pm25 - F.lit(low))
        index = line if index is None else F.when(pm25 <= F.lit(high), line).otherwise(index)
    return index.try_cast("int")


def pm10_index(pm10: Column) -> Column:
    """EPA index of the concentration cut to whole micrograms; the last segment goes on above the published table."""
    whole = F.floor(pm10)
    index: Column | None = None
    for low, high, index_low, index_high in reversed(PM10_SEGMENTS):
        slope = (index_high - index_low) / (high - low)
        line = F.lit(float(index_low)) + F.lit(slope) * (whole - F.lit(low))
        index = line if index is None else F.when(whole <= F.lit(high), line).otherwise(index)
    return F.floor(F.when(pm10 >= 0, index) + F.lit(0.5)).try_cast("int")


def overall_index(*indices: Column) -> Column:
    """The worst of the pollutant indices; NULLs are skipped."""
    return F.greatest(*indices)


def index_category(index: Column) -> Column:
    """Five categories."""
    return band(index, CATEGORY_LIMITS, ABOVE_ALL_CATEGORIES)


def report_category(index: Column) -> Column:
    """Six categories, as the weekly report uses them."""
    return band(index, REPORT_LIMITS, ABOVE_ALL_REPORT_BANDS)
