"""Schemas of the feeds and of the lake and warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _document(stop_fields: list[T.StructField], event: T.StructType) -> T.StructType:
    stop = T.StructType(
        [
            T.StructField("_id", T.StringType()),
            *stop_fields,
            T.StructField("ar", T.ArrayType(event)),
            T.StructField("dp", T.ArrayType(event)),
        ]
    )
    return T.StructType(
        [
            T.StructField("_station", T.StringType()),
            T.StructField("s", T.ArrayType(stop)),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )


# XML attributes are fields with a leading underscore.
PLANNED_DOCUMENT = _document(
    [T.StructField("tl", _strings("_c", "_n", "_o", "_t", "_f"))],
    _strings("_pt", "_pp", "_l", "_ppth", "_pdest", "_status"),
)
CHANGE_DOCUMENT = _document([], _strings("_ct", "_clt", "_cs", "_cp", "_l", "_pp", "_cpth", "_dis"))

STATION_FILE = (
    "result array<struct<"
    "number int, name string, ifopt string, category int, priceCategory int, federalState string, "
    "mailingAddress struct<street string, zipcode string, city string>, "
    "hasParking boolean, hasBicycleParking boolean, hasLocalPublicTransport boolean, hasPublicFacilities boolean, "
    "hasLockerSystem boolean, hasTaxiRank boolean, hasTravelNecessities boolean, hasSteplessAccess string, "
    "hasMobilityService string, hasWiFi boolean, hasTravelCenter boolean, hasRailwayMission boolean, "
    "hasDBLounge boolean, hasLostAndFound boolean, hasCarRental boolean, "
    "evaNumbers array<struct<number int, geographicCoordinates struct<coordinates array<decimal(10,7)>>>>, "
    "ril100Identifiers array<struct<rilIdentifier string, primaryLocationCode string, steamPermission string>>, "
    "regionalbereich struct<number int, name string, shortName string>, "
    "aufgabentraeger struct<shortName string, name string>, "
    "szentrale struct<number int, name string, publicPhoneNumber string>, "
    "stationManagement struct<number int, name string>, "
    "productLine struct<productLine string, segment string>>>"
)

TIMETABLES = (
    "sid string, station string, event_type string, category string, number string, owner string, line string, "
    "planned_time timestamp_ntz, planned_platform string, planned_path string"
)
TIMETABLE_CHANGES = (
    "sid string, station string, event_type string, line string, changed_time timestamp_ntz, "
    "cancellation_time timestamp_ntz, cancellation_status string, planned_platform string, changed_path string"
)

DIM_TRAIN = (
    "train_key bigint, train_id string, train_number string, operator_code string, operator_name string, "
    "train_category string, train_category_desc string, train_class string, train_class_desc string, "
    "train_type string, train_type_desc string"
)
DIM_TIME = (
    "time_key bigint, timestamp timestamp_ntz, date date, year int, month int, day int, hour int, minute int, "
    "weekday int, is_weekend boolean"
)
DIM_MESSAGE = (
    "message_key bigint, message_id string, message_type string, message_category string, message_code string, "
    "priority int, timestamp timestamp_ntz, timestamp_tts string, valid_from timestamp_ntz, valid_to timestamp_ntz"
)
BRIDGE_MOVEMENT_MESSAGES = "movement_id string, message_key bigint, message_sequence smallint"
FACT_TRAIN_MOVEMENT = (
    "movement_id string, station_key bigint, train_key bigint, time_key bigint, event_type string, "
    "event_status string, planned_time timestamp_ntz, actual_time timestamp_ntz, planned_platform string, "
    "actual_platform string, delay_minutes int, is_cancelled boolean, cancellation_time timestamp_ntz, "
    "is_hidden boolean, has_disruption boolean, distance_change int, line_number string, planned_path string, "
    "actual_path string, planned_destination string, sid string"
)
