"""Column-to-column functions; all of them stay inside the JVM."""

from perron.functions.geo import haversine_km, unit_sphere
from perron.functions.similarity import indel_ratio
from perron.functions.text import (
    actual_platform,
    cancelled_flag,
    code_label,
    disruption_flag,
    first_element,
    normalize_station,
    station_from_filename,
    train_id_dim,
    train_id_fact,
    trim_to_null,
)
from perron.functions.timeparse import (
    calendar_columns,
    delay_minutes_floor,
    delay_minutes_fractional,
    epoch_seconds,
    parse_time_dayfirst,
    parse_time_folder,
    parse_time_lake,
    parse_time_warehouse,
    planned_time_column,
)

__all__ = [
    "actual_platform",
    "calendar_columns",
    "cancelled_flag",
    "code_label",
    "delay_minutes_floor",
    "delay_minutes_fractional",
    "disruption_flag",
    "epoch_seconds",
    "first_element",
    "haversine_km",
    "indel_ratio",
    "normalize_station",
    "parse_time_dayfirst",
    "parse_time_folder",
    "parse_time_lake",
    "parse_time_warehouse",
    "planned_time_column",
    "station_from_filename",
    "train_id_dim",
    "train_id_fact",
    "trim_to_null",
    "unit_sphere",
]
