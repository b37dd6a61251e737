"""What the file layout itself says: feed, period and snapshot time.

Files lie at ``<feed>/<period>/<YYMMDDHHMM>/<station>_timetable.xml``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.functions import parse_time_folder, station_from_filename
from perron.operators.joins import semi_join

PLANNED_FEED = "timetables"
CHANGE_FEED = "timetable_changes"
FEEDS = (PLANNED_FEED, CHANGE_FEED)

def _part_from_end(path: Column, n: int) -> Column:
    return F.substring_index(F.substring_index(path, "/", -n), "/", 1)


def feed_of(path: Column) -> Column:
    return _part_from_end(path, 4)


def period_of(path: Column) -> Column:
    return _part_from_end(path, 3)


def folder_of(path: Column) -> Column:
    return _part_from_end(path, 2)


def day_of(path: Column) -> Column:
    """The ``YYMMDD`` prefix of the snapshot folder."""
    return F.substring(folder_of(path), 1, 6)


def unit_of(path: Column) -> Column:
    """Period and snapshot day: the files whose stops and changes belong together."""
    return F.concat_ws("_", period_of(path), day_of(path))


def snapshot_time_of(path: Column) -> Column:
    return parse_time_folder(folder_of(path))


def list_files(spark: SparkSession, root: str, feed: str, pattern: str = "*.xml") -> DataFrame:
    """Paths of one feed; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(f"{root.rstrip('/')}/{feed}")
        .select(F.col("path").alias("file_path"))
    )


def file_inventory(files: DataFrame) -> DataFrame:
    """One row per file with the facts encoded in its path."""
    path = F.col("file_path")
    return files.where(path.endswith(".xml")).select(
        feed_of(path).alias("feed"),
        period_of(path).alias("period"),
        folder_of(path).alias("folder"),
        snapshot_time_of(path).alias("snapshot_ts"),
        station_from_filename(path).alias("file_station"),
        "file_path",
    )


def in_planned_periods(changes: DataFrame, planned: DataFrame) -> DataFrame:
    """Change rows of the periods that the planned feed has; both sides need ``period``."""
    return semi_join(changes, planned, "period")


def files_per_period(planned: DataFrame, changes: DataFrame) -> DataFrame:
    """File counts per feed and planned period, with a total row per feed.

    Counts are kept per period first, so the total adds up a handful of rows.
    """
    listed = planned.select("feed", "period").unionByName(
        in_planned_periods(changes.select("feed", "period"), planned)
    )
    per_period = listed.groupBy("feed", "period").agg(F.count("*").alias("n_files"))
    return per_period.rollup("feed", "period").agg(F.sum("n_files").alias("n_files")).where("feed is not null")


def snapshot_times(*file_sets: DataFrame) -> DataFrame:
    """Distinct snapshot times over the folders of any number of feeds."""
    folders = None
    for files in file_sets:
        # distinct before the union: each file list shrinks to its folders first
        one = files.select(folder_of(F.col("file_path")).alias("folder")).distinct()
        folders = one if folders is None else folders.union(one)
    times = folders.select(parse_time_folder(F.col("folder")).alias("timestamp"))
    return times.where("timestamp is not null").distinct()
