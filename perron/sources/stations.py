"""Station master data from JSON files ``{"result": [station, ...]}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.functions import first_element
from perron.schemas import STATION_FILE


def read_station_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per station of the files at ``path``."""
    files = spark.read.schema(STATION_FILE).option("multiLine", "true").json(path)
    return files.select(F.inline("result"))


def parse_station_documents(documents: DataFrame) -> DataFrame:
    """The same for (file_path, json) rows; a null ``result`` has no stations."""
    parsed = documents.select(F.from_json("json", STATION_FILE).alias("file"))
    return parsed.select(F.inline("file.result"))


def _station_columns() -> dict[str, Column]:
    col = F.col
    eva = first_element(col("evaNumbers"))
    coordinates = eva["geographicCoordinates"]["coordinates"]
    ril = first_element(col("ril100Identifiers"))
    return {
        "station_id": col("number"),
        "station_number": col("number"),
        "station_name": col("name"),
        "eva_number": eva["number"],
        "ifopt": col("ifopt"),
        "street": col("mailingAddress.street"),
        "zipcode": col("mailingAddress.zipcode"),
        "city": col("mailingAddress.city"),
        "federal_state": col("federalState"),
        "category": col("category"),
        "price_category": col("priceCategory"),
        "has_parking": col("hasParking"),
        "has_bicycle_parking": col("hasBicycleParking"),
        "has_local_public_transport": col("hasLocalPublicTransport"),
        "has_public_facilities": col("hasPublicFacilities"),
        "has_locker_system": col("hasLockerSystem"),
        "has_taxi_rank": col("hasTaxiRank"),
        "has_travel_necessities": col("hasTravelNecessities"),
        "has_stepless_access": col("hasSteplessAccess"),
        "has_mobility_service": col("hasMobilityService"),
        "has_wifi": col("hasWiFi"),
        "has_travel_center": col("hasTravelCenter"),
        "has_railway_mission": col("hasRailwayMission"),
        "has_db_lounge": col("hasDBLounge"),
        "has_lost_and_found": col("hasLostAndFound"),
        "has_car_rental": col("hasCarRental"),
        "longitude": F.get(coordinates, F.lit(0)).cast("decimal(10,7)"),
        "latitude": F.get(coordinates, F.lit(1)).cast("decimal(10,7)"),
        "regional_number": col("regionalbereich.number"),
        "regional_name": col("regionalbereich.name"),
        "regional_shortname": col("regionalbereich.shortName"),
        "aufgabentraeger_shortname": col("aufgabentraeger.shortName"),
        "aufgabentraeger_name": col("aufgabentraeger.name"),
        "szentrale_number": col("szentrale.number"),
        "szentrale_name": col("szentrale.name"),
        "szentrale_phone": col("szentrale.publicPhoneNumber"),
        "station_mgmt_number": col("stationManagement.number"),
        "station_mgmt_name": col("stationManagement.name"),
        "product_line": col("productLine.productLine"),
        "segment": col("productLine.segment"),
        "ril100_identifier": ril["rilIdentifier"],
        "primary_location_code": ril["primaryLocationCode"],
        "steam_permission": ril["steamPermission"],
    }


def flatten_stations(stations: DataFrame) -> DataFrame:
    """Nested station records as the flat columns of ``dim_station``."""
    return stations.select(*[c.alias(name) for name, c in _station_columns().items()])
