from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from perron import functions as fn
from perron.functions.text import CATEGORY_LABELS, OPERATOR_NAMES
from perron.operators import delays


def values(spark, inputs, column, kind="string"):
    """``column(F.col('x'))`` for each input, in order."""
    rows = list(enumerate(inputs))
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


TIMES = ["2509221939", "9909221939", "6009221939", "5909221939", "250922193", "25a9221939", "2513221939",
         "2502301200", "2509222400", "202509221939", "", None, " 509221939", "2509221939\n"]


def test_parse_time_lake(spark):
    good = {0: datetime(2025, 9, 22, 19, 39), 1: datetime(2099, 9, 22, 19, 39), 2: datetime(2060, 9, 22, 19, 39),
            3: datetime(2059, 9, 22, 19, 39)}
    expected = [good.get(i) for i in range(len(TIMES))]
    assert values(spark, TIMES, fn.parse_time_lake) == expected
    assert values(spark, TIMES, fn.parse_time_folder) == expected


def test_parse_time_warehouse(spark):
    good = {0: datetime(2025, 9, 22, 19, 39), 1: datetime(1999, 9, 22, 19, 39), 2: datetime(1960, 9, 22, 19, 39),
            3: datetime(2059, 9, 22, 19, 39), 9: datetime(2025, 9, 22, 19, 39)}
    assert values(spark, TIMES, fn.parse_time_warehouse) == [good.get(i) for i in range(len(TIMES))]


def test_parse_time_dayfirst_only_for_text(spark):
    assert values(spark, ["2209251939", "3002251200", "22092519", None], fn.parse_time_dayfirst) == [
        datetime(2025, 9, 22, 19, 39), None, None, None
    ]
    stamped = spark.sql("select timestamp_ntz'2025-09-22 19:39:00' as planned_time")
    assert stamped.select(fn.planned_time_column(stamped)).first()[0] == datetime(2025, 9, 22, 19, 39)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_delays_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "select * from values (1, timestamp_ntz'2025-03-30 01:00:00', timestamp_ntz'2025-03-30 01:01:30'), "
            "(2, timestamp_ntz'2025-03-30 01:01:30', timestamp_ntz'2025-03-30 01:00:00'), "
            "(3, timestamp_ntz'2025-03-30 01:00:00', timestamp_ntz'2025-03-30 04:00:00'), "
            "(4, timestamp_ntz'2025-03-30 01:00:00', null), (5, null, timestamp_ntz'2025-03-30 01:00:00') t(i, p, a)"
        ).orderBy("i")
        assert [r[0] for r in df.select(fn.delay_minutes_floor(F.col("p"), F.col("a"))).collect()] == [
            1, -2, 180, None, None
        ]
        assert [r[0] for r in df.select(fn.delay_minutes_fractional(F.col("p"), F.col("a"))).collect()] == [
            1.5, -1.5, 180.0, None, None
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_calendar(spark):
    df = spark.sql("select timestamp_ntz'2025-09-21 23:59:00' ts")
    row = df.select(*[c.alias(n) for n, c in fn.calendar_columns(F.col("ts")).items()]).first()
    assert tuple(row) == (date(2025, 9, 21), 2025, 9, 21, 23, 59, 6, True)


def test_trim_and_labels(spark):
    assert values(spark, [" a ", "\t b\n", "  ", "", None, "x y", " z"], fn.trim_to_null) == [
        "a", "b", None, None, None, "x y", "z"
    ]
    assert values(spark, ["08", "8", "", None, "BVG"], lambda c: fn.code_label(c, OPERATOR_NAMES)) == [
        "S-Bahn Berlin GmbH", None, None, None, "Berliner Verkehrsbetriebe"
    ]
    assert values(spark, ["S", "s"], lambda c: fn.code_label(c, CATEGORY_LABELS)) == ["S-Bahn", None]


def test_train_ids(spark):
    df = spark.createDataFrame(
        [(0, " S ", "12", " "), (1, "RE", None, "DB"), (2, None, "1", ""), (3, "IC", "7", None)],
        "i int, c string, n string, o string",
    ).orderBy("i")
    args = F.col("c"), F.col("n"), F.col("o")
    assert [r[0] for r in df.select(fn.train_id_dim(*args)).collect()] == [
        "S_12_UNK", "RE_None_DB", "None_1_UNK", "IC_7_UNK"
    ]
    assert [r[0] for r in df.select(fn.train_id_fact(*args)).collect()] == [
        " S _12_ ", "RE_None_DB", "None_1_UNK", "IC_7_UNK"
    ]


def test_flags(spark):
    assert values(spark, ["c", " C ", "p", "", None], fn.cancelled_flag) == [True, True, False, False, False]
    assert values(spark, ["1", "0", "", None], fn.disruption_flag) == [True, False, False, False]
    df = spark.createDataFrame([(0, "3", "S1"), (1, "", "S1"), (2, None, None)], "i int, cp string, l string")
    parity = fn.actual_platform(F.col("cp"), F.col("l"))
    strict = fn.actual_platform(F.col("cp"), F.col("l"), line_fallback=False)
    assert [tuple(r) for r in df.orderBy("i").select(parity, strict).collect()] == [
        ("3", "3"), ("S1", None), (None, None)
    ]


def test_normalize_station(spark):
    cases = {
        "Berlin Südkreuz": "suedkreuz",
        "Berlin Friedrichstraße": "friedrichstrasse",
        "Berlin Schönhauser Allee": "schoenhauser_allee",
        "Berlin Hbf (tief)": "hbf",
        "Berlin Frankfurter Str.": "frankfurter_strasse",
        "berlin friedrichstra_e": "friedrichstrasse",
        "Berlin-Spandau": "berlin_spandau",
        "BERLIN  Zoo (a) x (b)": "zoo",
        "_A._-b_": "a_b",
        "": "",
        None: "",
    }
    assert values(spark, list(cases), fn.normalize_station) == list(cases.values())


def test_station_from_filename(spark):
    path = "/d/timetables/w/2509221901/berlin_s_dkreuz_timetable.xml"
    assert values(spark, [path], fn.station_from_filename) == ["berlin s dkreuz"]


def test_first_element(spark):
    assert values(spark, [[3, 4], [], None], fn.first_element, "array<int>") == [3, None, None]


def test_haversine(spark):
    distance = fn.haversine_km(F.lit(52.52), F.lit(13.405), F.lit(52.525), F.lit(13.369))
    assert spark.range(1).select(distance).first()[0] == pytest.approx(2.49828819961610, abs=1e-9)


def test_blank_station_means_the_default():
    assert delays.station_or_default(" Ostkreuz ") == "Ostkreuz"
    assert {delays.station_or_default(x) for x in (None, "", "  ")} == {delays.DEFAULT_STATION}
