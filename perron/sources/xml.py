"""Timetable and change XML as DataFrames.

A scan is a lazy plan: documents (``file_path``, ``xml``) are parsed by the
native XML expression in the task that reads them. A document that cannot be
parsed yields no stops and is listed by :func:`corrupt_documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perron.functions import first_element, parse_time_lake, parse_time_warehouse
from perron.functions.text import actual_platform, cancelled_flag, disruption_flag, station_from_filename, train_id_fact
from perron.schemas import CHANGE_DOCUMENT, CORRUPT, PLANNED_DOCUMENT
from perron.sources import layout

_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "ignoreSurroundingSpaces": "false"}


def decoded_path() -> Column:
    """The path of the file being read; the metadata column holds it as a URI."""
    # '+' is literal in a path but a blank to url_decode
    uri = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(uri).alias("file_path")


def read_documents(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """(file_path, xml): every ``*.xml`` below the feed, one row per file."""
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.xml")
        .text(f"{root.rstrip('/')}/{feed}", wholetext=True)
    )
    return files.select(decoded_path(), F.col("value").alias("xml"))


# Tags and the text between them; quoted attribute values may contain '>'.
_TOKENS = r"""<(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>|[^<]++"""
_STOP, _STOP_END = r"^<s[\s/>]", r"^</s\s*>"
_NO_ELEMENTS = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"


def _flat_stops(document: Column) -> Column:
    """All stop elements of a document in the order they begin, each without the stops inside it.

    Tokens are read once with a stack of open stops; a token belongs to the innermost.
    """
    tokens = F.regexp_extract_all(F.regexp_replace(document, _NO_ELEMENTS, ""), F.lit(_TOKENS), F.lit(0))

    def read(tokens: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            token, stack = F.get(tokens, i), state["stack"]
            begins = token.rlike(_STOP)
            opens = begins & ~token.endswith("/>")
            inner = F.when(begins, i).otherwise(F.coalesce(F.try_element_at(stack, F.lit(-1)), F.lit(-1)))
            after = F.when(opens, F.concat(stack, F.array(i)))
            after = after.when(token.rlike(_STOP_END), F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0)))).otherwise(stack)
            return F.struct(after.alias("stack"), F.concat(state["stops"], F.array(inner)).alias("stops"))

        none = F.array().cast("array<int>")
        places = F.when(F.size(tokens) > 0, F.sequence(F.lit(0), F.size(tokens) - 1)).otherwise(none)
        stops = F.aggregate(places, F.struct(none.alias("stack"), none.alias("stops")), step, lambda state: state["stops"])
        owned = F.zip_with(tokens, stops, lambda token, stop: F.struct(token.alias("token"), stop.alias("stop")))
        begun = F.filter(places, lambda i: F.get(tokens, i).rlike(_STOP))

        def texts(both: Column) -> Column:
            def one(i: Column) -> Column:
                return F.array_join(F.transform(F.filter(both, lambda x: x["stop"] == i), lambda x: x["token"]), "")

            return F.array_join(F.transform(begun, one), "")

        # a one-element array binds what is used more than once
        return F.get(F.transform(F.array(owned), texts), F.lit(0))

    return F.get(F.transform(F.array(tokens), read), F.lit(0))


def _parse(documents: DataFrame, schema: T.StructType, any_depth: bool) -> DataFrame:
    """(file_path, doc). ``any_depth`` also takes stops that stand below other elements, other stops included.

    The parser reads stops that are children of the root. Only where a document may name
    more of them (a count of ``<s`` without patterns tells) its stops are cut out in their order and
    parsed as children of one root; all other documents are parsed once.
    """
    read = F.from_xml("xml", schema, _OPTIONS).alias("doc")
    if not any_depth:
        return documents.select("file_path", read)
    flat = F.from_xml(F.concat(F.lit("<timetable>"), _flat_stops(F.col("xml")), F.lit("</timetable>")), schema, _OPTIONS)
    children = F.greatest(F.coalesce(F.size("doc.s"), F.lit(0)), F.lit(0))
    named = (F.octet_length("xml") - F.octet_length(F.replace("xml", F.lit("<s"), F.lit("")))) / 2
    nested = F.col(f"doc.{CORRUPT}").isNull() & (named > children)
    return documents.select("file_path", "xml", read).select(
        "file_path", F.col("doc").withField("s", F.when(nested, flat["s"]).otherwise(F.col("doc.s"))).alias("doc")
    )


def parse_planned(documents: DataFrame, any_depth: bool = False) -> DataFrame:
    return _parse(documents, PLANNED_DOCUMENT, any_depth)


def parse_changes(documents: DataFrame, any_depth: bool = False) -> DataFrame:
    return _parse(documents, CHANGE_DOCUMENT, any_depth)


def corrupt_documents(parsed: DataFrame) -> DataFrame:
    """Quarantine: files whose XML could not be read."""
    return parsed.where(F.col(f"doc.{CORRUPT}").isNotNull()).select(
        "file_path", F.col(f"doc.{CORRUPT}").alias("content")
    )


def stops_of(parsed: DataFrame, *path_facts: Column) -> DataFrame:
    """One row per stop: file_path, station, stop_pos, the stop ``s``, path facts.

    Facts about the file are computed here, once per document. The outer forms
    of the explodes matter: the inner ones make the optimizer add a filter on
    the exploded array, for which every document would be parsed once more.
    """
    stops = parsed.select(
        "file_path",
        *path_facts,
        F.col("doc._station").alias("station"),
        F.posexplode_outer("doc.s").alias("stop_pos", "s"),
    )
    return stops.where("s is not null")


# ---- lake rows --------------------------------------------------------------


def _first_events(stops: DataFrame) -> DataFrame:
    """First arrival and first departure of each stop."""
    pairs = F.array(
        F.struct(F.lit("arrival").alias("event_type"), first_element(F.col("s.ar")).alias("el")),
        F.struct(F.lit("departure").alias("event_type"), first_element(F.col("s.dp")).alias("el")),
    )
    return stops.select("*", F.inline_outer(pairs)).where("el is not null")


def _or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def lake_timetables(parsed: DataFrame, source: bool = False) -> DataFrame:
    """Planned documents as rows of the ``timetables`` table, with ``source`` also their file."""

    def train(attribute: str) -> Column:
        # '' where the stop has no train element, null where only the attribute is missing
        return F.when(F.col("s.tl").isNull(), F.lit("")).otherwise(F.col(f"s.tl.{attribute}"))

    return _first_events(stops_of(parsed)).select(
        F.col("s._id").alias("sid"),
        "station",
        "event_type",
        train("_c").alias("category"),
        train("_n").alias("number"),
        train("_o").alias("owner"),
        F.col("el._l").alias("line"),
        parse_time_lake(F.col("el._pt")).alias("planned_time"),
        F.col("el._pp").alias("planned_platform"),
        F.col("el._ppth").alias("planned_path"),
        *(["file_path"] if source else []),
    )


def lake_changes(parsed: DataFrame, snapshot: bool = False, source: bool = False) -> DataFrame:
    """Change documents as rows of the ``timetable_changes`` table.

    ``snapshot=True`` adds the snapshot time, which "newest change" queries
    need, ``source=True`` the file.
    """
    facts = [layout.snapshot_time_of(F.col("file_path")).alias("snapshot_ts")] if snapshot else []
    return _first_events(stops_of(parsed, *facts)).select(
        F.col("s._id").alias("sid"),
        "station",
        "event_type",
        _or_empty(F.col("el._l")).alias("line"),
        parse_time_lake(F.col("el._ct")).alias("changed_time"),
        parse_time_lake(F.col("el._clt")).alias("cancellation_time"),
        _or_empty(F.col("el._cs")).alias("cancellation_status"),
        _or_empty(F.col("el._pp")).alias("planned_platform"),
        _or_empty(F.col("el._cpth")).alias("changed_path"),
        *(["snapshot_ts"] if snapshot else []),
        *(["file_path"] if source else []),
    )


# ---- warehouse rows ---------------------------------------------------------


def _all_events(stops: DataFrame) -> DataFrame:
    """Every arrival and departure element of each stop."""

    def tagged(tag: str) -> Column:
        elements = F.transform(
            F.col(f"s.{tag}"),
            lambda el, i: F.struct(F.lit(tag.upper()).alias("event_type"), i.alias("event_pos"), el.alias("el")),
        )
        return F.coalesce(elements, F.array())

    return stops.select("*", F.inline_outer(F.concat(tagged("ar"), tagged("dp")))).where("el is not null")


def _has_id() -> Column:
    return F.coalesce(F.col("s._id"), F.lit("")) != ""


def planned_stops(parsed: DataFrame) -> DataFrame:
    """Planned stops with the facts of their file; the form the warehouse stages."""
    path = F.col("file_path")
    return stops_of(
        parsed,
        layout.period_of(path).alias("period"),
        layout.day_of(path).alias("day"),
        station_from_filename(path).alias("file_station"),
    )


def warehouse_planned(stops: DataFrame) -> DataFrame:
    """One row per arrival/departure element of stops that have an id and a train."""
    return _all_events(stops.where(_has_id() & F.col("s.tl").isNotNull())).select(
        "period",
        "day",
        "file_path",
        "stop_pos",
        "event_pos",
        _or_empty(F.col("station")).alias("xml_station"),
        "file_station",
        F.col("s._id").alias("sid"),
        train_id_fact(F.col("s.tl._c"), F.col("s.tl._n"), F.col("s.tl._o")).alias("train_id"),
        "event_type",
        F.col("el._status").alias("event_status"),
        parse_time_warehouse(F.col("el._pt")).alias("planned_time"),
        F.col("el._pp").alias("planned_platform"),
        F.col("el._l").alias("line_number"),
        F.col("el._ppth").alias("planned_path"),
        F.col("el._pdest").alias("planned_destination"),
    )


def warehouse_changes(parsed: DataFrame, line_fallback: bool = True) -> DataFrame:
    """One row per changed arrival/departure element of stops that have an id."""
    path = F.col("file_path")
    stops = stops_of(
        parsed,
        layout.period_of(path).alias("period"),
        layout.day_of(path).alias("day"),
        layout.snapshot_time_of(path).alias("snapshot_ts"),
    )
    return _all_events(stops.where(_has_id())).select(
        "period",
        "day",
        "snapshot_ts",
        "file_path",
        "stop_pos",
        "event_pos",
        F.col("s._id").alias("sid"),
        "event_type",
        parse_time_warehouse(F.col("el._ct")).alias("actual_time"),
        actual_platform(F.col("el._cp"), F.col("el._l"), line_fallback).alias("actual_platform"),
        F.col("el._cpth").alias("actual_path"),
        cancelled_flag(F.col("el._cs")).alias("is_cancelled"),
        parse_time_warehouse(F.col("el._clt")).alias("cancellation_time"),
        disruption_flag(F.col("el._dis")).alias("has_disruption"),
    )


def train_rows(stops: DataFrame) -> DataFrame:
    """Train attributes of every stop whose category and number are not empty."""
    given = (F.coalesce(F.col("s.tl._c"), F.lit("")) != "") & (F.coalesce(F.col("s.tl._n"), F.lit("")) != "")
    return stops.where(given).select(
        "file_path",
        "stop_pos",
        F.col("s.tl._c").alias("category"),
        F.col("s.tl._n").alias("number"),
        F.col("s.tl._o").alias("operator"),
        F.col("s.tl._t").alias("type"),
        F.col("s.tl._f").alias("class"),
    )
