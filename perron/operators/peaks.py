"""Departures per station in the morning and evening peak."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.functions import planned_time_column

# ---- fixed values: peak windows [from, to) and their result columns ---------
MORNING = (7, 9)
EVENING = (17, 19)
MORNING_COLUMN = "morning_avg_departures (7-9)"
EVENING_COLUMN = "evening_avg_departures (17-19)"
# ---- end of fixed values ----------------------------------------------------


def in_hours(ts: Column, window: tuple[int, int]) -> Column:
    """Half-open hour range."""
    return (F.hour(ts) >= window[0]) & (F.hour(ts) < window[1])


def _departures(timetables: DataFrame) -> DataFrame:
    return timetables.where(F.col("event_type") == "departure").select(
        "station", planned_time_column(timetables).alias("planned_time")
    )


def peak_average(timetables: DataFrame, window: tuple[int, int], column: str) -> DataFrame:
    """Mean number of departures per day; days without any do not count."""
    per_day = (
        _departures(timetables)
        .where(in_hours(F.col("planned_time"), window))
        .groupBy("station", F.to_date("planned_time").alias("date"))
        .agg(F.count("*").alias("n"))
    )
    return per_day.groupBy("station").agg(F.avg("n").alias(column))


def outer_join_peaks(morning: DataFrame, evening: DataFrame) -> DataFrame:
    return morning.join(evening, "station", "full_outer")


def peak_hours_report(timetables: DataFrame) -> DataFrame:
    """Both peaks side by side, by station, from a single scan without a join."""
    ts = F.col("planned_time")
    morning, evening = in_hours(ts, MORNING), in_hours(ts, EVENING)
    per_day = (
        _departures(timetables)
        .where(morning | evening)
        .groupBy("station", F.to_date(ts).alias("date"))
        .agg(F.count_if(morning).alias("n_morning"), F.count_if(evening).alias("n_evening"))
    )

    def mean_of_days(count: str) -> Column:
        return F.avg(F.when(F.col(count) > 0, F.col(count)))

    return (
        per_day.groupBy("station")
        .agg(mean_of_days("n_morning").alias(MORNING_COLUMN), mean_of_days("n_evening").alias(EVENING_COLUMN))
        .orderBy("station")
    )
