"""Column helpers shared by every job: bands, calendars, look-back bounds, mergeable means."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def band(value: Column, limits: Sequence[tuple[float, str]], above: str) -> Column:
    """Label of the first limit that ``value`` does not exceed; ``above`` beyond all, or for NULL."""
    return reduce(
        lambda rest, step: F.when(value <= F.lit(step[0]), F.lit(step[1])).otherwise(rest),
        reversed(limits),
        F.lit(above),
    )


def grade(value: Column, floors: Sequence[tuple[float, str]], below: str) -> Column:
    """Label of the first floor that ``value`` reaches; ``below`` under all, or for NULL."""
    return reduce(
        lambda rest, step: F.when(value >= F.lit(step[0]), F.lit(step[1])).otherwise(rest),
        reversed(floors),
        F.lit(below),
    )


def under(value: Column, ceilings: Sequence[tuple[float, object]], otherwise: object) -> Column:
    """Label of the first ceiling that ``value`` stays strictly below."""
    return reduce(
        lambda rest, step: F.when(value < F.lit(step[0]), F.lit(step[1])).otherwise(rest),
        reversed(ceilings),
        F.lit(otherwise),
    )


def over(value: Column, floors: Sequence[tuple[float, object]], otherwise: object) -> Column:
    """Label of the first floor that ``value`` strictly exceeds."""
    return reduce(
        lambda rest, step: F.when(value > F.lit(step[0]), F.lit(step[1])).otherwise(rest),
        reversed(floors),
        F.lit(otherwise),
    )


# --- calendar -------------------------------------------------------------------------------


def calendar(stamp: str | Column, *, hour: bool = False) -> dict[str, Column]:
    """Year, month and day (and hour) of a date or timestamp, as partition columns."""
    c = F.col(stamp) if isinstance(stamp, str) else stamp
    parts = {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)}
    return {**parts, "hour": F.hour(c)} if hour else parts


#: Tasks that share the rows of a day at most, where these are dealt by day.
LANES = 8
_DEALT = ("year", "month", "day", "_lane")


def dealt_by_day(frame: DataFrame, stamp: str, *key: str | Column) -> DataFrame:
    """Rows of a day brought to at most ``LANES`` tasks, rows that agree in ``key`` to the same one.

    An aggregate that groups by ``day_keys`` as well needs no exchange of its own then, and neither does a write with
    folders by day, so rows travel once and before they are widened to parts. ``key`` has to follow from the
    aggregate's own keys, so that groups stay whole.
    """
    lane = F.pmod(F.xxhash64(*key), F.lit(LANES))
    return frame.withColumns({**calendar(stamp), "_lane": lane}).repartition(*_DEALT)


def day_keys(frame: DataFrame) -> tuple[str, ...]:
    """What to group by besides the own keys: calendar and lane of dealt rows, nothing for others."""
    return _DEALT if "_lane" in frame.columns else ()


def day_of_week(stamp: str) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(stamp) - F.lit(1)


def distinct_hours(hour: Column) -> Column:
    """Number of distinct hours of the day in a group, from a bit set.

    A long buffer merges in a hash aggregate, where a distinct count costs a shuffle of its own.
    """
    return F.coalesce(F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1), hour))), F.lit(0)).cast("bigint")


# --- times and look-back bounds -----------------------------------------------------------------------


def moment(value: dt.date | dt.datetime) -> Column:
    """A date, or a wall-clock time in the session's zone, as a constant.

    A bare ``lit(datetime)`` would be read in the zone of the Python process.
    """
    if isinstance(value, dt.datetime):
        return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp")
    return F.lit(value)


def processing_time(run_at: dt.datetime | None) -> Column:
    """Time of the run; without one the time of the micro-batch, which a retry repeats."""
    return F.current_timestamp() if run_at is None else moment(run_at)


def partitions_since(frame: DataFrame, first: dt.date) -> DataFrame:
    """Restrict a table laid out by year, month, day to partitions on or after ``first``.

    A filter on a date column does not prune integer partition columns by itself.
    """
    y, m, d = F.col("year"), F.col("month"), F.col("day")
    from_month = (y > first.year) | ((y == first.year) & (m > first.month))
    return frame.filter(from_month | ((y == first.year) & (m == first.month) & (d >= first.day)))


def on_or_after(frame: DataFrame, column: str, bound: dt.date | dt.datetime) -> DataFrame:
    """Rows from ``bound`` on, with the matching partition predicate where the layout has one."""
    kept = frame.filter(F.col(column) >= moment(bound))
    if {"year", "month", "day"} <= set(frame.columns):
        kept = partitions_since(kept, bound.date() if isinstance(bound, dt.datetime) else bound)
    return kept


def on_day(frame: DataFrame, column: str, day: dt.date) -> DataFrame:
    """Rows whose timestamp or date falls on ``day``."""
    c = F.col(column)
    if isinstance(frame.schema[column].dataType, T.DateType):
        kept = frame.filter(c == moment(day))
    else:
        start = dt.datetime.combine(day, dt.time())
        kept = frame.filter((c >= moment(start)) & (c < moment(start + dt.timedelta(days=1))))
    if {"year", "month", "day"} <= set(frame.columns):
        kept = kept.filter(
            (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)
        )
    return kept


def months_back(day: dt.date, months: int) -> dt.date:
    """First day of the month ``months`` before the month of ``day``."""
    index = day.year * 12 + day.month - 1 - months
    return dt.date(index // 12, index % 12 + 1, 1)


def week_start(day: dt.date) -> dt.date:
    """Monday of the week ``day`` lies in."""
    return day - dt.timedelta(days=day.weekday())


def days_predicate(days: Iterable[dt.date | None]) -> Column:
    """Partition predicate for a set of days; None stands for rows without a readable time."""
    by_month: dict[tuple[int, int], list[int]] = {}
    undated = False
    for d in days:
        if d is None:
            undated = True
        else:
            by_month.setdefault((d.year, d.month), []).append(d.day)
    clauses = [
        (F.col("year") == y) & (F.col("month") == m) & F.col("day").isin(sorted(set(dd)))
        for (y, m), dd in sorted(by_month.items())
    ]
    if undated:
        clauses.append(F.col("year").isNull())
    return reduce(lambda a, b: a | b, clauses, F.lit(False))


# --- aggregates -----------------------------------------------------------------------------


def averages(spec: Mapping[str, str]) -> list[Column]:
    """``{result: source}`` as plain averages."""
    return [F.avg(source).alias(name) for name, source in spec.items()]


def mean_parts(columns: Iterable[str]) -> list[Column]:
    """Sum and count of a single reading per column: the finest parts of a mean."""
    return [
        F.expr(part)
        for c in columns
        for part in (f"{c} as {c}__sum", f"cast({c} is not null as bigint) as {c}__n")
    ]


def merged_parts(columns: Iterable[str]) -> list[Column]:
    """Merge mean parts to a coarser grain, still as parts."""
    return [F.expr(f"sum({c}__{part}) as {c}__{part}") for c in columns for part in ("sum", "n")]


def finished_means(spec: Mapping[str, str]) -> list[Column]:
    """``{result: source}`` means from parts; NULL when nothing was counted."""
    return [
        F.expr(f"try_divide(cast(sum({source}__sum) as double), sum({source}__n)) as {name}")
        for name, source in spec.items()
    ]


def squares(column: str) -> Column:
    """The third part of a deviation beside sum and count: the summed squares about the own mean of a group of readings."""
    return F.coalesce(F.var_pop(column) * F.count(column), F.lit(0.0))


def merged_deviation(parts: DataFrame, keys: Sequence[str], column: str) -> tuple[DataFrame, Column]:
    """Parts with what is needed to merge their deviations, and the sample deviation as an aggregate over ``keys``.

    The squares of a union are the squares of its parts and what the parts' means are off the common mean (Chan's rule
    for many parts). Differences of large sums, which lose all digits where readings are nearly alike, don't occur.
    The common mean is brought to each part by a window over the same keys as the aggregate, so it is one shuffle.
    """
    total, n, own = F.col(f"{column}__sum"), F.col(f"{column}__n"), F.col(f"{column}__m2")
    group = Window.partitionBy(*keys)
    off = F.try_divide(total, n) - F.try_divide(F.sum(total).over(group), F.sum(n).over(group))
    about = parts.withColumn("_about", own + F.coalesce(n * off * off, F.lit(0.0)))
    return about, F.when(F.sum(n) > 1, F.sqrt(F.sum("_about") / (F.sum(n) - 1)))


def with_deviation(rows: DataFrame, parts: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """``rows``, one per ``keys``, with the sample deviation of ``column`` from their parts in the column ``name``.

    Parts of equally many readings are merged first, by a variance of their means, which a hash aggregate combines before
    anything is sent. The common mean is then brought to the few merged parts of each row and not to all parts, which
    would have to be sorted for it.
    """
    total, n, own = (F.col(f"{column}__{part}") for part in ("sum", "n", "m2"))
    alike = parts.groupBy(*keys, n.alias("_each")).agg(
        *merged_parts([column]),
        (F.sum(own) + F.coalesce(F.var_pop(F.try_divide(total, n)) * F.sum(n), F.lit(0.0))).alias(f"{column}__m2"),
    )
    about, deviation = merged_deviation(alike, keys, column)
    found = about.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(deviation.alias("_found"))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    return rows.join(found, same, "left").select(*(F.col("_found").alias(c) if c == name else c for c in rows.columns))


def rounded(value: Column | str, digits: int) -> Column:
    """Half-up rounding that does not depend on the order in which doubles were added.

    A mean that lies exactly between two results comes out a hair above or below it, depending on
    the partitions. Nine digits first take that hair away.
    """
    return F.round(F.round(value, 9), digits)


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent; NULL when ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)
