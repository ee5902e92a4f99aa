"""Traffic classification expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbsight.functions.common import over, under

LEVELS = ("severe", "high", "moderate", "low")

# Vehicles above which a level starts.
LEVEL_FLOORS = ((70, "severe"), (50, "high"), (25, "moderate"))

# Weight of one reading in the 0-100 congestion score.
LEVEL_WEIGHTS = {"severe": 100, "high": 70, "moderate": 40, "low": 10}

# Free-flow speed per road type, and for every other type.
EXPECTED_SPEED = {"highway": 65.0, "arterial": 45.0}
EXPECTED_SPEED_ELSEWHERE = 35.0


def congestion_level(vehicles: Column) -> Column:
    return over(vehicles, LEVEL_FLOORS, "low")


def congestion_ordinal(level: Column) -> Column:
    """The level as a share from 0 to 1: its score weight over 100."""
    pairs = [F.lit(x) for name, weight in LEVEL_WEIGHTS.items() for x in (name, weight / 100)]
    return F.try_element_at(F.create_map(*pairs), level)


def flow_band(vehicles: Column, speed: Column) -> Column:
    """Excellent, Good, Fair or Poor flow by count and speed."""
    return (
        F.when((speed > 40) & (vehicles < 30), "Excellent")
        .when((speed > 25) & (vehicles < 50), "Good")
        .when(speed > 15, "Fair")
        .otherwise("Poor")
    )


def incident_candidate(vehicles: Column, speed: Column) -> Column:
    """Slow and crowded at once."""
    return (speed < 8) & (vehicles > 60)


def incident_severity(vehicles: Column, speed: Column) -> Column:
    """Severity as the incident table stores it: both conditions have to hold."""
    grades = (("Critical", 5, 60), ("High", 10, 50))
    return F.coalesce(
        *(F.when((speed < limit) & (vehicles > crowd), F.lit(name)) for name, limit, crowd in grades),
        F.lit("Moderate"),
    )


def documented_severity(congestion: Column, speed: Column) -> Column:
    """Severity as the data dictionary states it: either condition is enough."""
    grades = (("critical", 0.9, 5), ("high", 0.7, 15))
    return F.coalesce(
        *(F.when((congestion > share) | (speed < limit), F.lit(name)) for name, share, limit in grades),
        F.lit("moderate"),
    )


# Severity as a number from 0 to 1. The dictionary names the range only; these steps are ours.
SEVERITY_SCORES = {"critical": 1.0, "high": 0.7, "moderate": 0.4}


def severity_score(severity: Column) -> Column:
    pairs = [F.lit(x) for pair in SEVERITY_SCORES.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), severity)


def expected_speed(road_type: Column) -> Column:
    pairs = [F.lit(x) for pair in EXPECTED_SPEED.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), road_type), F.lit(EXPECTED_SPEED_ELSEWHERE))


def speed_status(speed: Column) -> Column:
    """Traffic light for a mean speed."""
    # Labels and the speeds they start below.
    steps = ((15, "🔴 Severe Congestion"), (25, "🟠 Heavy Traffic"), (35, "🟡 Moderate Traffic"))
    return under(speed, steps, "🟢 Free Flow")


# Commuter hours.
MORNING_RUSH = (7, 9)
EVENING_RUSH = (17, 19)
NIGHT = (22, 5)


def rush_period(hour: Column) -> Column:
    """Part of the day; the night wraps around midnight."""
    return (
        F.when(hour.between(*MORNING_RUSH), "Morning Rush")
        .when(hour.between(*EVENING_RUSH), "Evening Rush")
        .when((hour >= NIGHT[0]) | (hour <= NIGHT[1]), "Night")
        .otherwise("Off-Peak")
    )


def is_peak(hour: Column) -> Column:
    return hour.between(*MORNING_RUSH) | hour.between(*EVENING_RUSH)
