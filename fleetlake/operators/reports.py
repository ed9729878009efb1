"""The two shipped Gold reports and their parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TOP_VEHICLES = 10


def _day_of_month() -> Column:
    return F.dayofmonth("timestamp").cast("bigint")


def _hour() -> Column:
    return F.hour("timestamp").cast("bigint")


def hourly_max_velocity(silver: DataFrame, by_calendar_date: bool = False) -> DataFrame:
    """Highest velocity per vehicle and hour; null readings are skipped.

    ``date`` is the day of the month, so equal day numbers of different months share a group;
    ``by_calendar_date`` groups by the full date instead.
    """
    date = F.to_date("timestamp") if by_calendar_date else _day_of_month()
    return silver.groupBy("vin", date.alias("date"), _hour().alias("hour")).agg(
        F.max("velocity").alias("max_velocity_per_vin")
    )


def fastest_vehicles_per_hour(
    silver: DataFrame, k: int = TOP_VEHICLES, by_calendar_date: bool = False
) -> DataFrame:
    """Top ``k`` vehicles of every hour, ties broken by VIN.

    The rank filter is planned as a group limit in each task ahead of the shuffle, so an hour
    sends at most ``k`` rows per task however many vehicles it has.
    """
    by_speed = W.partitionBy("date", "hour").orderBy(
        F.col("max_velocity_per_vin").desc_nulls_last(), F.col("vin").asc_nulls_last()
    )
    return (
        hourly_max_velocity(silver, by_calendar_date)
        .withColumn("rank", F.row_number().over(by_speed))
        .filter(F.col("rank") <= k)
        .select("vin", "date", "hour", "max_velocity_per_vin", F.col("rank").cast("bigint").alias("rank"))
        .orderBy(
            F.col("date").desc_nulls_last(), F.col("hour").desc_nulls_last(), F.col("rank").asc()
        )
    )


def vin_last_timestamp(silver: DataFrame) -> DataFrame:
    return silver.groupBy("vin").agg(F.max("timestamp").alias("max_timestamp"))


def last_value_per_vin(silver: DataFrame, column: str) -> DataFrame:
    """Latest non-null value per vehicle, by window; the greater value wins a tie in time.

    Keeping only the first row is planned as a limit in each task before the shuffle, so a
    vehicle with a third of all rows still sends one row per task.
    """
    latest = W.partitionBy("vin").orderBy(F.col("timestamp").desc(), F.col(column).desc())
    return (
        silver.filter(F.col(column).isNotNull())
        .select("vin", column, "timestamp")
        .withColumn("row_num", F.row_number().over(latest))
        .filter(F.col("row_num") == 1)
        .select("vin", column, "timestamp")
    )


def vin_last_state(silver: DataFrame) -> DataFrame:
    """Last time seen, door state and wipers state of every vehicle; each looks back on its own.

    First the last time of every (vehicle, door, wipers) combination: a hash aggregation on a
    fixed-width buffer, which shrinks the rows in each task before anything is shuffled. Then
    the three answers per vehicle from those few rows.
    """
    combinations = silver.groupBy("vin", "front_left_door_state", "wipers_state").agg(
        F.max("timestamp").alias("timestamp")
    )

    def latest(column: str) -> Column:
        seen = F.when(F.col(column).isNotNull(), F.struct("timestamp", column))
        return F.max(seen)[column].alias(column)

    return combinations.groupBy("vin").agg(
        F.max("timestamp").alias("max_timestamp"),
        latest("front_left_door_state"),
        latest("wipers_state"),
    )


def vin_last_state_joined(silver: DataFrame) -> DataFrame:
    """The same report as two left joins, each right side holding one row per vehicle."""
    door = last_value_per_vin(silver, "front_left_door_state").drop("timestamp")
    wipers = last_value_per_vin(silver, "wipers_state").drop("timestamp")
    return (
        vin_last_timestamp(silver)
        .join(door, "vin", "left")
        .join(wipers, "vin", "left")
        .select("vin", "max_timestamp", "front_left_door_state", "wipers_state")
    )
