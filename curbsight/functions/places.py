"""The two small dimensions: air-quality zones and road intersections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Zone, latitude, longitude.
ZONES = (
    ("downtown", 40.7128, -74.0060),
    ("midtown", 40.7589, -73.9851),
    ("uptown", 40.7831, -73.9712),
    ("industrial", 40.6782, -73.9442),
    ("residential", 40.7489, -73.9680),
)

# Intersection, latitude, longitude, road type.
INTERSECTIONS = (
    ("Main_St_5th_Ave", 40.7128, -74.0060, "major"),
    ("Broadway_42nd_St", 40.7589, -73.9851, "major"),
    ("Park_Ave_23rd_St", 40.7399, -73.9850, "arterial"),
    ("Amsterdam_96th_St", 40.7946, -73.9697, "arterial"),
    ("West_Houston_St", 40.7280, -74.0020, "local"),
    ("FDR_Drive_23rd", 40.7350, -73.9750, "highway"),
    ("Brooklyn_Bridge", 40.7061, -73.9969, "major"),
    ("Queens_Midtown_Tunnel", 40.7434, -73.9694, "highway"),
)

CITY = "New_York"
COUNTRY = "USA"


def intersection_dimension(spark: SparkSession) -> DataFrame:
    """Eight constant rows: safe to broadcast, because the size does not depend on the data."""
    return spark.createDataFrame(
        list(INTERSECTIONS),
        "intersection string, site_latitude double, site_longitude double, site_road_type string",
    )
