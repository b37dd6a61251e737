"""Text clean-up, train ids, code labels, status flags and station names."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: code lists of the timetable feed -------------------------
OPERATOR_NAMES = {
    "08": "S-Bahn Berlin GmbH",
    "OWRE": "Ostdeutsche Eisenbahn GmbH (ODEG)",
    "DB": "DB Regio AG",
    "800165": "DB Regio AG Nordost",
    "SNCF": "French National Railways",
    "BVG": "Berliner Verkehrsbetriebe",
}
CATEGORY_LABELS = {
    "S": "S-Bahn",
    "RE": "Regional Express",
    "RB": "Regionalbahn",
    "IC": "Intercity",
    "ICE": "Intercity Express",
}
CLASS_LABELS = {"N": "Normal", "S": "Special"}
TYPE_LABELS = {"p": "Passenger", "g": "Freight"}
# ---- end of fixed values ----------------------------------------------------

UNKNOWN_OPERATOR = "UNK"
MISSING_TEXT = "None"
FILE_SUFFIX = "_timetable.xml"


def trim_ws(text: Column) -> Column:
    """Strip every kind of white space at both ends (``trim`` strips blanks only)."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def trim_to_null(text: Column) -> Column:
    return F.nullif(trim_ws(text), F.lit(""))


def first_element(array: Column) -> Column:
    """First element, or null for an empty or missing array (also in ANSI mode)."""
    return F.get(array, F.lit(0))


def code_label(code: Column, labels: dict[str, str]) -> Column:
    """Case-sensitive code lookup; unknown and null codes give null."""
    literal_map = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return F.when(code.isNotNull(), F.try_element_at(literal_map, code))


def train_id_dim(category: Column, number: Column, operator: Column) -> Column:
    """Train id of the dimension: trimmed parts, blank operator is ``UNK``."""
    return F.concat_ws(
        "_",
        F.coalesce(trim_to_null(category), F.lit(MISSING_TEXT)),
        F.coalesce(trim_to_null(number), F.lit(MISSING_TEXT)),
        F.coalesce(trim_to_null(operator), F.lit(UNKNOWN_OPERATOR)),
    )


def train_id_fact(category: Column, number: Column, operator: Column) -> Column:
    """Train id of a movement: parts as sent, empty operator is ``UNK``."""
    return F.concat_ws(
        "_",
        F.coalesce(category, F.lit(MISSING_TEXT)),
        F.coalesce(number, F.lit(MISSING_TEXT)),
        F.coalesce(F.nullif(operator, F.lit("")), F.lit(UNKNOWN_OPERATOR)),
    )


def cancelled_flag(status: Column) -> Column:
    return F.coalesce(F.lower(trim_ws(status)) == "c", F.lit(False))


def disruption_flag(dis: Column) -> Column:
    return F.coalesce(dis == "1", F.lit(False))


def actual_platform(changed: Column, line: Column, line_fallback: bool = True) -> Column:
    """Changed platform; where it is missing, the feed's ``l`` attribute.

    ``line_fallback=False`` leaves a missing platform null instead.
    """
    platform = F.nullif(changed, F.lit(""))
    return F.coalesce(platform, line) if line_fallback else platform


def station_from_filename(path: Column) -> Column:
    """``…/berlin_x_timetable.xml`` -> ``berlin x``."""
    name = F.substring_index(path, "/", -1)
    return F.replace(F.replace(name, F.lit(FILE_SUFFIX), F.lit("")), F.lit("_"), F.lit(" "))


# ---- fixed values: German letters and their spelled-out forms ---------------
GERMAN_LETTERS = {"ß": "ss", "ä": "ae", "ö": "oe", "ü": "ue", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue"}
# ---- end of fixed values ----------------------------------------------------


def normalize_station(name: Column) -> Column:
    """Comparison form of a station name; null and empty become ``''``."""
    text = F.coalesce(name, F.lit(""))
    for letter, spelled in GERMAN_LETTERS.items():
        text = F.replace(text, F.lit(letter), F.lit(spelled))
    for pattern, replacement in (
        (r"(?i)\Aberlin ", ""),
        (r"(?i)(?:str\.|stra_e)", "strasse"),
        (r"\s*\(.*\)", ""),
        (r"[ .\-_]+", "_"),
    ):
        text = F.regexp_replace(text, pattern, replacement)
    return F.btrim(F.lower(text), F.lit("_"))
