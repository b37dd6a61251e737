"""Rail inputs derived from the generic test tables.

The column lists below are written once and rendered for two SQL dialects, so
that a check engine can start from the same raw attributes. Only *inputs* are
shared that way: documents are rendered, parsed and processed by Spark, while
the checks compute their answers from the attributes.

``events`` gives the stops (one event = one stop of one train), ``supplier``
the stations, ``customer`` the search points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Dialect:
    """The few spellings in which Spark SQL and DuckDB differ."""

    pattern: str
    styles: dict
    truncate: str
    add_minutes: str
    integer_divide: str

    def text(self, ts: str, style: str) -> str:
        return self.pattern.format(ts=ts, style=self.styles[style])

    def trunc(self, unit: str, ts: str) -> str:
        return self.truncate.format(unit=unit, ts=ts)

    def plus(self, ts: str, minutes: str) -> str:
        return self.add_minutes.format(ts=ts, n=minutes)

    def div(self, a: str, b: int) -> str:
        return self.integer_divide.format(a=a, b=b)


SPARK = Dialect(
    "date_format({ts}, '{style}')",
    {"ten": "yyMMddHHmm", "twelve": "yyyyMMddHHmm", "day": "yyMMdd", "date": "yyyyMMdd", "dayfirst": "ddMMyyHHmm"},
    "cast(date_trunc('{unit}', {ts}) as timestamp_ntz)",
    "timestampadd(MINUTE, cast({n} as int), {ts})",
    "({a} div {b})",
)
DUCKDB = Dialect(
    "strftime({ts}, '{style}')",
    {"ten": "%y%m%d%H%M", "twelve": "%Y%m%d%H%M", "day": "%y%m%d", "date": "%Y%m%d", "dayfirst": "%d%m%y%H%M"},
    "date_trunc('{unit}', {ts})",
    "({ts} + to_minutes(cast({n} as integer)))",
    "({a} // {b})",
)


def station_name(k: str) -> str:
    """Name of station number ``k``; spellings cover every normalisation rule."""
    word = f"translate(substr(md5(cast({k} as string)), 1, 10), '0123456789abcdef', 'bdfgklmnprstaeio')"
    word = f"(upper(substr({word}, 1, 1)) || substr({word}, 2))"
    return (
        f"case when {k} = 0 then 'Berlin Anhalter Bf' when {k} % 4 = 1 then 'Berlin ' || {word} || 'straße' "
        f"when {k} % 4 = 2 then 'Berlin ' || {word} || ' Süd' when {k} % 4 = 3 then {word} || ' (tief)' "
        f"else 'Berlin-' || {word} || ' Str.' end"
    )


def file_name_form(name: str) -> str:
    return f"replace(replace(replace(lower({name}), ' ', '_'), 'ü', '_'), 'ß', '_')"


# ---- stops ------------------------------------------------------------------

# One document holds at most this many stops, however hot its station is.
PART_ROWS = 4096


def stop_layers(d: Dialect) -> list[dict[str, str]]:
    """Column lists over ``events``, each one reading the one before it."""
    minute = {
        "e": "event_id",
        "u": "user_id",
        "et": "event_type",
        "m": d.trunc("minute", "ts"),
    }
    place = {
        **{c: c for c in minute},
        "h6": "hour(m) - hour(m) % 6",
        "part": d.div("e", PART_ROWS),
        "period": d.text(d.trunc("week", "m"), "date"),
        "name": station_name("u"),
    }
    stop = {
        **{c: c for c in place},
        "folder": d.text("m", "day") + " || lpad(cast(h6 as string), 2, '0') || '01'",
        "xml_station": (
            "case (u + h6) % 4 when 2 then substr(name, 1, 8) || substr(name, 10) "
            "when 3 then cast(null as string) else name end"
        ),
        "file_station": file_name_form("name"),
        "truncated": "(u * 5 + h6) % 47 = 0",
        "sid": "case when e % 101 = 0 then null else 's' || cast(e as string) end",
        "has_tl": "e % 37 <> 0",
        "c": (
            "case when e % 59 = 1 then null when e % 53 = 1 then '' when e % 53 = 2 then '  ' "
            "when e % 7 = 0 then 'S' when e % 7 = 1 then 'RE' when e % 7 = 2 then 'RB' when e % 7 = 3 then 'IC' "
            "when e % 7 = 4 then 'ICE' when e % 7 = 5 then ' S ' else 'XX' end"
        ),
        "n": (
            "case when e % 61 = 1 then null when e % 43 = 1 then ' ' || cast(u % 40 as string) || ' ' "
            "else cast(u % 40 as string) end"
        ),
        "o": (
            "case e % 8 when 0 then '08' when 1 then 'OWRE' when 2 then 'DB' when 3 then '800165' "
            "when 4 then 'SNCF' when 5 then ' BVG' when 6 then '' else null end"
        ),
        "t": "case e % 4 when 0 then 'p' when 1 then 'g' when 2 then '' else null end",
        "f": "case e % 5 when 0 then 'N' when 1 then 'S' when 2 then '' when 3 then null else 'Q' end",
        "n_ar": "case when e % 3 <> 0 then 1 else 0 end",
        "n_dp": "case when e % 3 = 1 then 0 when e % 41 = 0 then 2 else 1 end",
        "pp": "case when e % 11 = 0 then null else cast(e % 12 + 1 as string) end",
        "l": "case e % 9 when 0 then null when 1 then '' else 'S' || cast(u % 9 as string) end",
        "ppth": "'Halt ' || cast(u as string) || '|Bahn & Hof <' || cast(u % 5 as string) || '>'",
        "pdest": "case when e % 6 = 0 then null else 'Ziel ' || cast(u % 20 as string) end",
        "status": "case when e % 4 = 0 then null else 'p' end",
    }
    return [minute, place, stop]


# Offset in minutes of each possible element of a stop from the event time.
ELEMENTS = {("AR", 0): 0, ("DP", 0): 2, ("DP", 1): 5}


def planned_time_text(d: Dialect, tag: str, index: int) -> str:
    """The ``pt`` attribute, including every malformed form the parsers meet."""
    ts = d.plus("m", str(ELEMENTS[tag, index]))
    ten = d.text(ts, "ten")
    return (
        f"case when e % 89 = 1 then null when e % 67 = 1 then '' when e % 71 = 1 then substr({ten}, 1, 9) "
        f"when e % 73 = 1 then {d.text(ts, 'twelve')} when e % 79 = 1 then substr({ten}, 1, 4) || 'a' || substr({ten}, 6) "
        f"when e % 83 = 1 then '2402301200' when e % 97 = 1 then '99' || substr({ten}, 3) else {ten} end"
    )


def snapshot_layers(d: Dialect) -> list[dict[str, str]]:
    """Column lists over stops x snapshot number ``k`` (1 to 3)."""
    late = "case when e % 13 = 0 and k = 3 then 1440 else 0 end"
    seen = {"snap": d.plus(d.trunc("hour", "m"), f"k * 15 + {late}")}
    change = {
        "snap": "snap",
        "snap_folder": d.text("snap", "ten"),
        "change_period": "case when u % 50 = 7 then 'extra' else period end",
        "change_truncated": "(u * 3 + k) % 53 = 0",
        "clt": f"case when et = 'error' then {d.text(d.plus('m', 'k * 15'), 'ten')} end",
        "cs": (
            "case e % 10 when 0 then 'c' when 1 then ' C ' when 2 then 'p' when 3 then '' "
            "when 4 then null else 'a' end"
        ),
        "cp": "case e % 5 when 0 then '' when 1 then null else cast((e + k) % 14 + 1 as string) end",
        "cl": "case when e % 8 = 0 then null else 'S' || cast(u % 9 as string) end",
        "cpp": "case when e % 7 = 0 then null else cast(e % 12 + 1 as string) end",
        "cpth": "case when e % 4 = 0 then null else 'Halt ' || cast((u + k) % 30 as string) || '|Umweg' end",
        "dis": "case e % 6 when 0 then '1' when 1 then '0' else null end",
    }
    return [seen, change]


# Stops are seen in one or three snapshots.
SNAPSHOTS = "case when e % 3 = 0 then 1 else 3 end"


def changed_time_text(d: Dialect, tag: str, index: int) -> str:
    delay = f"(e * 7 + k * 3 + {index}) % 45 - 5 + {ELEMENTS[tag, index]}"
    return (
        f"case when e % 17 = 0 then null when e % 19 = 1 then '' else {d.text(d.plus('m', delay), 'ten')} end"
    )


def folder_text(d: Dialect) -> str:
    """Snapshot folder names, with folders that are no time among them."""
    ten = d.text("m", "ten")
    return (
        f"case when e % 31 = 1 then 'tmp' when e % 31 = 2 then substr({ten}, 1, 9) when e % 31 = 3 then '2413011200' "
        f"when e % 31 = 4 then '2401012400' when e % 31 = 5 then '2402301200' else {ten} end"
    )


def dayfirst_text(d: Dialect) -> str:
    text = d.text("m", "dayfirst")
    return (
        f"case when e % 31 = 1 then null when e % 31 = 2 then substr({text}, 1, 9) when e % 31 = 3 then '3002241200' "
        f"when e % 31 = 4 then '' else {text} end"
    )


# ---- delays to the second ---------------------------------------------------


def delay_columns(d: Dialect) -> dict[str, str]:
    """Planned and actual times with delays from about -3 to +4 minutes."""
    return {
        "event_id": "event_id",
        "planned": f"case when event_id % 19 = 0 then null else {d.trunc('minute', 'ts')} end",
        "actual": f"case when event_id % 17 = 0 then null else {d.plus(d.trunc('second', 'ts'), 'event_id % 7 - 3')} end",
    }


# ---- messages ---------------------------------------------------------------


def message_columns(d: Dialect) -> dict[str, str]:
    """``dim_message`` over ``orders``: one message per order."""
    return {
        "message_key": "cast(o_orderkey as bigint)",
        "message_id": "'m' || cast(o_orderkey as string)",
        "message_type": "case when o_orderkey % 3 = 0 then 'h' else 'd' end",
        "message_category": "o_orderstatus",
        "message_code": "cast(o_orderkey % 90 as string)",
        "priority": "cast(substr(o_orderpriority, 1, 1) as int)",
        "timestamp": "o_orderdate",
        "timestamp_tts": d.text("o_orderdate", "ten"),
        "valid_from": "o_orderdate",
        "valid_to": d.plus("o_orderdate", "1440"),
    }


def bridge_columns() -> dict[str, str]:
    """One to three messages per movement, spread by the stop number in ``sid``."""
    number = "cast(substr(sid, 2) as bigint)"
    return {
        "movement_id": "movement_id",
        "message_key": f"cast({number} * 3 + k as bigint)",
        "message_sequence": "cast(k as smallint)",
    }


# Movements carry one to three messages.
MESSAGES = "cast(substr(sid, 2) as bigint) % 3 + 1"


# ---- lake tables ------------------------------------------------------------

EVENT_KIND = "case when event_type in ('click', 'view', 'error') then 'departure' else 'arrival' end"


def lake_planned_columns(d: Dialect) -> dict[str, str]:
    return {
        "sid": "cast(event_id as string)",
        "station": station_name("user_id"),
        "event_type": EVENT_KIND,
        "category": "case event_id % 3 when 0 then 'S' when 1 then 'RE' else 'RB' end",
        "number": "cast(user_id % 40 as string)",
        "owner": "case when event_id % 5 = 0 then null else '08' end",
        "line": "'S' || cast(user_id % 9 as string)",
        "planned_time": f"case when event_id % 97 = 0 then null else {d.trunc('minute', 'ts')} end",
        "planned_platform": "cast(event_id % 12 + 1 as string)",
        "planned_path": "'Halt ' || cast(user_id as string) || '|Halt ' || cast(user_id % 7 as string)",
    }


def lake_change_columns(d: Dialect) -> dict[str, str]:
    minute = d.trunc("minute", "ts")
    return {
        "sid": "cast(event_id as string)",
        "station": station_name("user_id"),
        "event_type": EVENT_KIND,
        "line": "'S' || cast(user_id % 9 as string)",
        "changed_time": (
            f"case when event_id % 29 = 0 then null else {d.plus(minute, '(event_id * 7 + k * 3) % 45 - 5')} end"
        ),
        "cancellation_time": f"case when event_type = 'error' then {d.plus(minute, 'k * 15')} end",
        "cancellation_status": "case when event_type = 'error' then 'c' else '' end",
        "planned_platform": "cast(event_id % 12 + 1 as string)",
        "changed_path": "''",
        "snapshot_ts": d.plus(d.trunc("hour", "ts"), "k * 15"),
    }


LAKE_SNAPSHOTS = "case when event_id % 3 = 0 then 1 else 3 end"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores where the input has fewer splits than there are cores.

    Test tables are one small file each; a table of many splits stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _layer(df: DataFrame, columns: dict[str, str], keep: bool = False) -> DataFrame:
    kept = [f"`{c}`" for c in df.columns if keep and c not in columns]
    return df.selectExpr(*kept, *[f"{sql} as {name}" for name, sql in columns.items()])


def _numbered(df: DataFrame, count: str) -> DataFrame:
    """Each row ``count`` times, numbered ``k`` from 1."""
    return df.withColumn("k", F.explode(F.expr(f"sequence(1, cast({count} as int))")))


def timetables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spread(table(spark, sf_dir, "events")), lake_planned_columns(SPARK))


def timetable_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change snapshots; ``snapshot_ts`` is the time of the snapshot folder."""
    seen = _numbered(spread(table(spark, sf_dir, "events")), LAKE_SNAPSHOTS)
    return _layer(seen, lake_change_columns(SPARK))


def _stop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type"))


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _stop_events(spark, sf_dir)
    for columns in stop_layers(SPARK):
        df = _layer(df, columns)
    return df


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _numbered(stops(spark, sf_dir), SNAPSHOTS)
    for columns in snapshot_layers(SPARK):
        df = _layer(df, columns, keep=True)
    return df


# ---- XML documents ----------------------------------------------------------


def _attribute(name: str, value: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = F.replace(value, F.lit(raw), F.lit(entity))
    return F.coalesce(F.concat(F.lit(f' {name}="'), value, F.lit('"')), F.lit(""))


def _element(tag: str, attributes: dict[str, Column], *children: Column) -> Column:
    opening = F.concat(F.lit(f"<{tag}"), *[_attribute(k, v) for k, v in attributes.items()], F.lit(">"))
    return F.concat(opening, *children, F.lit(f"</{tag}>"))


def _when(condition: Column, text: Column) -> Column:
    return F.when(condition, text).otherwise(F.lit(""))


# Events whose documents one task should render.
EVENTS_PER_TASK = 20_000


def _by_document(rows: DataFrame, layers: list[dict[str, str]], folder: str, events: int) -> DataFrame:
    """The rows with all columns of ``layers``, those of one document in one task.

    Raw values, names and the document's place are shuffled, all other texts computed afterwards. A row of few
    bytes makes a long text, so the number of tasks follows the number of events.
    """
    keys = ["part", folder, "file_station"]

    def layered(df: DataFrame, known: list[str]) -> DataFrame:
        for columns in layers:
            df = _layer(df, {c: sql for c, sql in columns.items() if c not in known}, keep=True)
        return df

    placed = layered(rows, []).select(*rows.columns, "name", *keys)
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-events // EVENTS_PER_TASK))
    return layered(placed.repartition(tasks, *keys), placed.columns)


def _documents(fragments: DataFrame, feed: str) -> DataFrame:
    """Assemble stop fragments into one document per (part, folder, station)."""
    path = F.concat_ws(
        "/",
        F.concat(F.lit("/part="), F.col("part")),
        F.lit(feed),
        F.col("doc_period"),
        F.col("doc_folder"),
        F.concat(F.col("file_station"), F.lit("_timetable.xml")),
    )
    body = F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("e", "fragment"))), lambda x: x["fragment"]))
    grouped = fragments.groupBy(
        "part", "doc_period", "doc_folder", "file_station", "doc_station", "doc_truncated"
    ).agg(body.alias("body"))
    whole = _element("timetable", {"station": F.col("doc_station")}, F.col("body"))
    return grouped.select(
        path.alias("file_path"),
        F.when(F.col("doc_truncated"), F.substring(whole, F.lit(1), F.length(whole) - 15)).otherwise(whole).alias("xml"),
    )


def planned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_path, xml) of the planned feed."""
    train = _element("tl", {a: F.col(a) for a in ("f", "t", "o", "c", "n")})

    def element(tag: str, index: int) -> Column:
        attributes = {"pt": F.expr(planned_time_text(SPARK, tag, index))}
        attributes.update({a: F.col(a) for a in ("pp", "l", "ppth", "pdest", "status")})
        return _element(tag.lower(), attributes)

    fragment = _element(
        "s",
        {"id": F.col("sid")},
        _when(F.col("has_tl"), train),
        _when(F.col("n_ar") > 0, element("AR", 0)),
        _when(F.col("n_dp") > 0, element("DP", 0)),
        _when(F.col("n_dp") > 1, element("DP", 1)),
    )
    raw, *layers = stop_layers(SPARK)
    rows = _layer(_stop_events(spark, sf_dir), raw)
    return _documents(
        _by_document(rows, layers, "folder", table(spark, sf_dir, "events").count()).select(
            "e", "part", F.col("period").alias("doc_period"), F.col("folder").alias("doc_folder"), "file_station",
            F.col("xml_station").alias("doc_station"), F.col("truncated").alias("doc_truncated"),
            fragment.alias("fragment"),
        ),
        "timetables",
    )


def change_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_path, xml) of the change feed."""

    def element(tag: str, index: int) -> Column:
        attributes = {"ct": F.expr(changed_time_text(SPARK, tag, index))}
        attributes.update({"l": F.col("cl"), "pp": F.col("cpp")})
        attributes.update({a: F.col(a) for a in ("clt", "cs", "cp", "cpth", "dis")})
        return _element(tag.lower(), attributes)

    fragment = _element(
        "s",
        {"id": F.col("sid")},
        _when(F.col("e") % 4 == 0, F.lit('<m id="m"/>')),
        _when(F.col("n_ar") > 0, element("AR", 0)),
        _when(F.col("n_dp") > 0, element("DP", 0)),
        _when(F.col("n_dp") > 1, element("DP", 1)),
    )
    raw, *layers = stop_layers(SPARK)
    rows = _numbered(_layer(_stop_events(spark, sf_dir), raw), SNAPSHOTS)
    return _documents(
        _by_document(rows, layers + snapshot_layers(SPARK), "snap_folder", table(spark, sf_dir, "events").count()).select(
            "e", "part", F.col("change_period").alias("doc_period"), F.col("snap_folder").alias("doc_folder"),
            "file_station", F.col("name").alias("doc_station"), F.col("change_truncated").alias("doc_truncated"),
            fragment.alias("fragment"),
        ),
        "timetable_changes",
    )


# ---- stations ---------------------------------------------------------------

STATIONS_PER_FILE = 500


def station_columns() -> dict[str, str]:
    """Raw station attributes over ``supplier``, spelled alike in both engines."""
    k = "s_suppkey"
    return {
        "k": k,
        "number": f"cast({k} as int)",
        "name": station_name(k),
        "ifopt": f"case when {k} % 6 = 0 then null else 'de:' || cast({k} as string) end",
        "street": f"case when {k} % 10 = 6 then null else 'Weg ' || cast({k} % 30 as string) end",
        "zipcode": f"case when {k} % 10 = 6 then null else '0' || cast(1000 + {k} % 900 as string) end",
        "city": f"case when {k} % 10 = 6 then null else 'Berlin' end",
        "category": f"cast({k} % 7 + 1 as int)",
        "price_category": f"cast({k} % 5 as int)",
        "flag_a": f"{k} % 2 = 0",
        "flag_b": f"case when {k} % 9 = 0 then null else {k} % 3 = 0 end",
        "stepless": f"case {k} % 3 when 0 then 'yes' when 1 then 'no' else 'partial' end",
        "mobility": f"case when {k} % 4 = 0 then null else 'Ja, um Voranmeldung unter ' || cast({k} as string) end",
        "eva": f"case when {k} % 10 in (3, 4) then null else cast(8000000 + {k} as int) end",
        "lon": f"case when {k} % 10 in (3, 4, 5) then null else cast(13.0 + cast({k} % 100 as int) * 0.008 as decimal(10,7)) end",
        "lat": f"case when {k} % 10 in (3, 4, 5) then null else cast(52.3 + cast({k} % 97 as int) * 0.004 as decimal(10,7)) end",
        "region_number": f"cast({k} % 8 as int)",
        "region": f"'Region ' || cast({k} % 8 as string)",
        "carrier": f"case when {k} % 11 = 0 then null else 'VBB' end",
        "phone": f"'030/' || cast({k} as string)",
        "product_line": f"case when {k} % 5 = 0 then null else 'Metropolbahnhof' end",
        "ril": f"case when {k} % 7 = 0 then null else 'B' || cast({k} as string) end",
        "state": "'Berlin'",
    }


def station_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_path, json) station files; one of them has a null ``result``."""
    s = _layer(table(spark, sf_dir, "supplier"), station_columns())
    col = F.col
    coordinates = F.when(col("lon").isNotNull(), F.struct(F.array("lon", "lat").alias("coordinates")))
    evas = F.array(F.struct(col("eva").alias("number"), coordinates.alias("geographicCoordinates")))
    rils = F.array(
        F.struct(
            col("ril").alias("rilIdentifier"),
            F.lit("1").alias("primaryLocationCode"),
            F.lit("entryAllowed").alias("steamPermission"),
        )
    )
    station = F.struct(
        "number", "name", "ifopt", "category", col("price_category").alias("priceCategory"),
        F.when(col("street").isNotNull(), F.struct("street", "zipcode", "city")).alias("mailingAddress"),
        col("flag_a").alias("hasParking"), col("flag_b").alias("hasBicycleParking"),
        col("flag_a").alias("hasLocalPublicTransport"), col("flag_b").alias("hasPublicFacilities"),
        col("flag_a").alias("hasLockerSystem"), col("flag_b").alias("hasTaxiRank"),
        col("flag_a").alias("hasTravelNecessities"), col("stepless").alias("hasSteplessAccess"),
        col("mobility").alias("hasMobilityService"), col("flag_b").alias("hasWiFi"),
        col("flag_a").alias("hasTravelCenter"), col("flag_b").alias("hasRailwayMission"),
        col("flag_a").alias("hasDBLounge"), col("flag_b").alias("hasLostAndFound"),
        col("flag_a").alias("hasCarRental"), col("state").alias("federalState"),
        F.when(col("k") % 10 == 3, F.lit(None)).when(col("k") % 10 == 4, F.array_repeat(evas[0], 0)).otherwise(evas).alias("evaNumbers"),
        F.when(col("ril").isNotNull(), rils).alias("ril100Identifiers"),
        F.struct(col("region_number").alias("number"), col("region").alias("name"), F.lit("RB").alias("shortName")).alias("regionalbereich"),
        F.when(col("carrier").isNotNull(), F.struct(col("carrier").alias("shortName"), F.lit("Verkehrsverbund").alias("name"))).alias("aufgabentraeger"),
        F.struct(col("region_number").alias("number"), F.lit("3-S Zentrale").alias("name"), col("phone").alias("publicPhoneNumber")).alias("szentrale"),
        F.struct(col("region_number").alias("number"), col("region").alias("name")).alias("stationManagement"),
        F.when(col("product_line").isNotNull(), F.struct(col("product_line").alias("productLine"), F.lit("A").alias("segment"))).alias("productLine"),
    )
    files = s.groupBy(F.expr(SPARK.div("k", STATIONS_PER_FILE)).alias("file")).agg(
        F.sort_array(F.collect_list(F.struct("k", F.to_json(station).alias("text")))).alias("stations")
    )
    body = F.array_join(F.transform("stations", lambda x: x["text"]), ",")
    full = files.select(
        F.concat(F.lit("/stations/"), "file", F.lit(".json")).alias("file_path"),
        F.concat(F.lit('{"result":['), body, F.lit("]}")).alias("json"),
    )
    empty = files.where("file = 0").select(F.lit("/stations/empty.json"), F.lit('{"result":null}'))
    return full.union(empty)


def delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(table(spark, sf_dir, "events"), delay_columns(SPARK))


def messages(spark: SparkSession, sf_dir: str):
    """(movements -> bridge, dim_message)."""

    def bridge(movements: DataFrame) -> DataFrame:
        return _layer(_numbered(movements, MESSAGES), bridge_columns())

    return bridge, _layer(table(spark, sf_dir, "orders"), message_columns(SPARK))


# ---- search points ----------------------------------------------------------


def point_columns() -> dict[str, str]:
    """Search coordinates over ``customer``, inside and around the station area; every fifth on another continent."""
    far = "case when c_custkey % 5 = 0 then {} else {} end"
    return {
        "point_id": "c_custkey",
        "lat": f"{far.format(-33.9, 52.2)} + cast(c_custkey * 37 % 601 as double) * 0.001",
        "lon": f"{far.format(150.7, 12.9)} + cast(c_custkey * 53 % 1009 as double) * 0.001",
    }


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(table(spark, sf_dir, "customer"), point_columns())
