"""Members of the station, train and time dimensions."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perron.functions import calendar_columns, code_label, train_id_dim, trim_to_null
from perron.functions.text import CATEGORY_LABELS, CLASS_LABELS, OPERATOR_NAMES, TYPE_LABELS
from perron.operators.joins import new_members
from perron.operators.keys import add_keys, minute_key

# ---- stations ---------------------------------------------------------------

STATION_NATURAL = ["station_number", "station_name", "eva_number"]


def dim_station(flat: DataFrame) -> DataFrame:
    """Keyed stations; a reload replaces the table instead of appending to it."""
    keyed = add_keys(flat, STATION_NATURAL, "station_key")
    return keyed.select("station_key", *flat.columns)


def _same_station(left: DataFrame, right: DataFrame) -> Column:
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in STATION_NATURAL])


def newest_stations(loads: DataFrame) -> DataFrame:
    """Each station as its newest ``load`` has it; of equal ones the least as text."""
    attributes = [c for c in loads.columns if c != "load"]
    order = Window.partitionBy(*STATION_NATURAL).orderBy(F.desc("load"), F.to_json(F.struct(*attributes)))
    return loads.withColumn("__place", F.row_number().over(order)).where("__place = 1").select(*attributes)


def added_station_keys(stations: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Natural and surrogate keys of the stations that ``existing`` lacks."""
    natural = stations.select(*STATION_NATURAL)
    if existing is not None:
        natural = natural.join(existing.hint("merge"), _same_station(natural, existing), "left_anti")
    return add_keys(natural, STATION_NATURAL, "station_key", existing)


def keyed_stations(stations: DataFrame, keys: DataFrame) -> DataFrame:
    """Stations with their keys. Lists of stations are merged: Spark guesses their size from that of compressed files."""
    return stations.join(keys.hint("merge"), _same_station(stations, keys)).select(keys["station_key"], *[stations[c] for c in stations.columns])


# ---- trains -----------------------------------------------------------------


def train_members(rows: DataFrame) -> DataFrame:
    """Distinct trains; the first row of a train id (by file, then place) wins."""
    attributes = ["category", "number", "operator", "type", "class"]
    cleaned = rows.select(
        "file_path",
        "stop_pos",
        train_id_dim(F.col("category"), F.col("number"), F.col("operator")).alias("train_id"),
        *[trim_to_null(F.col(a)).alias(a) for a in attributes],
    )
    first = cleaned.groupBy("train_id").agg(
        F.min_by(F.struct(*attributes), F.struct("file_path", "stop_pos")).alias("t")
    )
    return first.select(
        "train_id",
        F.col("t.number").alias("train_number"),
        F.col("t.operator").alias("operator_code"),
        code_label(F.col("t.operator"), OPERATOR_NAMES).alias("operator_name"),
        F.col("t.category").alias("train_category"),
        code_label(F.col("t.category"), CATEGORY_LABELS).alias("train_category_desc"),
        F.col("t.class").alias("train_class"),
        code_label(F.col("t.class"), CLASS_LABELS).alias("train_class_desc"),
        F.col("t.type").alias("train_type"),
        code_label(F.col("t.type"), TYPE_LABELS).alias("train_type_desc"),
    )


def new_dim_train(members: DataFrame) -> DataFrame:
    return add_keys(members, ["train_id"], "train_key").select("train_key", *members.columns)


def added_trains(existing: DataFrame, members: DataFrame) -> DataFrame:
    """The members whose train id ``existing`` lacks, in its columns."""
    added = add_keys(new_members(members, existing, "train_id"), ["train_id"], "train_key", existing)
    return added.select(*[F.col(c) if c in added.columns else F.lit(None).cast(t).alias(c) for c, t in existing.dtypes])


def upsert_dim_train(existing: DataFrame, members: DataFrame) -> DataFrame:
    """``existing`` plus the members whose train id it lacks."""
    added = add_keys(new_members(members, existing, "train_id"), ["train_id"], "train_key", existing)
    return existing.unionByName(added, allowMissingColumns=True)


def infer_trains(existing: DataFrame, movements: DataFrame) -> DataFrame:
    """``existing`` plus bare rows for train ids that only movements mention."""
    return upsert_dim_train(existing, movements.select("train_id").distinct())


# ---- time -------------------------------------------------------------------


def time_members(timestamps: DataFrame) -> DataFrame:
    """Full ``dim_time`` rows of distinct, non-null ``timestamp`` values."""
    ts = F.col("timestamp")
    return timestamps.select(
        minute_key(ts).alias("time_key"), ts, *[c.alias(name) for name, c in calendar_columns(ts).items()]
    )


def upsert_dim_time(existing: DataFrame, timestamps: DataFrame) -> DataFrame:
    added = new_members(timestamps.select("timestamp").distinct(), existing, "timestamp")
    return existing.unionByName(time_members(added))


def infer_times(existing: DataFrame, movements: DataFrame) -> DataFrame:
    """``existing`` plus rows for planned times no snapshot folder has."""
    return upsert_dim_time(existing, movements.select(F.col("planned_time").alias("timestamp")))
