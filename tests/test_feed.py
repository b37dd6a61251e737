from collections import Counter
from xml.etree import ElementTree
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feed import write_archives, write_feed
from perron.operators import latest
from perron.plans import lake
from perron.sources import layout, stations, tables, xml
from perron.streaming import ingest


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return write_feed(tmp_path_factory.mktemp("feed"))


@pytest.fixture(scope="module")
def planned(spark, root):
    return xml.parse_planned(xml.read_documents(spark, root, "timetables"))


@pytest.fixture(scope="module")
def changes(spark, root):
    return xml.parse_changes(xml.read_documents(spark, root, "timetable_changes"))


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_lake_timetables(planned):
    at = datetime(2025, 9, 22, 19, 39)
    name = "Berlin Südkreuz"
    assert rows(xml.lake_timetables(planned)) == Counter(
        [
            ("a", name, "arrival", "S", "1", "08", "S1", at, "1", "X & Y"),
            ("a", name, "departure", "S", "1", "08", "S1", at.replace(minute=41), "1", None),
            ("b", name, "departure", "", "", "", None, None, None, None),
            ("c", name, "arrival", "RE", "7", None, None, None, None, None),
            (None, name, "arrival", " S ", "1", "08", None, None, None, None),
            ("e", None, "departure", "S", "", "", None, None, None, None),
        ]
    )


def test_lake_changes(changes):
    got = rows(xml.lake_changes(changes).where("sid = 'a' and event_type = 'arrival'"))
    name = "Berlin Südkreuz"
    assert got == Counter(
        [
            ("a", name, "arrival", "S1", datetime(2025, 9, 22, 19, 40), None, " C ", "", ""),
            ("a", name, "arrival", "", datetime(2025, 9, 22, 19, 37), None, "", "", ""),
            ("a", name, "arrival", "", datetime(2025, 9, 23, 1, 0), None, "", "", ""),
        ]
    )


def test_corrupt_documents_are_set_aside(planned):
    (row,) = xml.corrupt_documents(planned).collect()
    assert row.file_path.endswith("cut_timetable.xml") and "2509" in row.content


def test_warehouse_rows(planned):
    stops = xml.planned_stops(planned)
    movements = xml.warehouse_planned(stops)
    got = {(r.sid, r.event_type, r.event_pos): r for r in movements.collect()}
    assert set(got) == {("a", "AR", 0), ("a", "DP", 0), ("a", "DP", 1), ("c", "AR", 0), ("e", "DP", 0)}
    assert got["a", "DP", 1].planned_time == datetime(2025, 9, 22, 19, 59)
    assert got["a", "AR", 0].file_station == "berlin s dkreuz" and got["a", "AR", 0].train_id == "S_1_08"
    last = got["e", "DP", 0]
    assert last.planned_time == datetime(2025, 9, 29, 20, 5) and last.xml_station == ""
    assert last.file_station == "no station+name" and last.train_id == "S__UNK" and last.day == "250929"
    trains = [(r.category, r.number) for r in xml.train_rows(stops).orderBy("stop_pos").collect()]
    assert trains == [("S", "1"), ("RE", "7"), (" S ", "1"), ("S", "1")]


def test_stops_at_any_depth_in_their_order(spark):
    planned = (
        '<timetable station="X"><s id="1"><tl c="S" n="1"/><ar pt="2509221939" ppth="a &gt; b"/></s>'
        '<part><s id="2"><tl c="S" n="2"/><x><ar/></x><dp pt="2509221940" pdest=\'c > "d"\'/></s >'
        '<part><s id="3"/><s\nid="4"><tl c="S" n="4"/><dp l="&lt;/s>"/></s></part></part>'
        '<!-- <s id="no"/> --><sub/><s id="5"><tl c="S" n="5"/><ar/></s></timetable>'
    )
    changes = (
        '<timetable><s id="1"><ar ct="2509221940"/></s><part><s id="1"><ar ct="2509221941"/></s></part>'
        '<s id="1"><ar ct="2509221942"/></s></timetable>'
    )
    rows = [("root/timetables/w/2509221901/x_timetable.xml", text) for text in (planned, "<timetable/>", None, "<timet", changes)]
    documents = spark.createDataFrame(rows, "file_path string, xml string")
    stops = xml.planned_stops(xml.parse_planned(documents.limit(4), any_depth=True))
    got = {r.stop_pos: (r.station, r.s["_id"]) for r in stops.collect()}
    assert got == {i: ("X", str(i + 1)) for i in range(5)}
    moves = {(r.sid, r.event_type): r for r in xml.warehouse_planned(stops).collect()}
    assert set(moves) == {("1", "AR"), ("2", "DP"), ("4", "DP"), ("5", "AR")}
    assert moves["2", "DP"].planned_destination == 'c > "d"' and moves["1", "AR"].planned_path == "a > b"
    assert moves["4", "DP"].line_number == "</s>"
    assert [r.number for r in xml.train_rows(stops).orderBy("stop_pos").collect()] == ["1", "2", "4", "5"]
    changed = xml.warehouse_changes(xml.parse_changes(documents.where("xml like '%ct=%'"), any_depth=True))
    assert latest.latest_changes(changed).first().actual_time == datetime(2025, 9, 22, 19, 42)
    assert changed.count() == 3
    # the lake tables take children of the root only
    assert xml.lake_changes(xml.parse_changes(documents.where("xml like '%ct=%'"))).count() == 2


NESTED = (
    '<timetable station="X"><s id="1"><tl c="S" n="1"/><ar pt="2509221939"/>'
    '<s id="2"><tl c="S" n="2"/><dp pt="2509221940" pdest="a > b"/><part><s id="3"><ar/></s></part></s>'
    '<dp pt="2509221941"/></s><sub><s id="4"/></sub><s id="5"><x><s\tid="6"><dp l="&lt;s>"/></s ></x><ar/></s></timetable>'
)


def test_stops_inside_stops_are_read_like_the_outer_ones(spark):
    """As a search for stops below the root finds them, in the order they begin, with their own events only."""
    expected = []
    for stop in ElementTree.fromstring(NESTED).iterfind(".//s"):
        expected.append((stop.get("id"), len(stop.findall("ar")), len(stop.findall("dp"))))
    plain = '<timetable><s id="1"><ar/></s><sub/><station/></timetable>'
    rows = [("r/timetables/w/2509221901/x_timetable.xml", NESTED), ("r/timetables/w/2509221901/y_timetable.xml", plain)]
    documents = spark.createDataFrame(rows, "file_path string, xml string")
    stops = xml.planned_stops(xml.parse_planned(documents, any_depth=True)).collect()

    def found(name):
        own = sorted((r for r in stops if name in r.file_path), key=lambda r: r.stop_pos)
        return [(r.s["_id"], len(r.s["ar"] or ()), len(r.s["dp"] or ())) for r in own]

    assert found("x_timetable") == expected and len(expected) == 6
    assert found("y_timetable") == [("1", 1, 0)]


def test_inventory_and_periods(spark, root):
    planned = layout.file_inventory(layout.list_files(spark, root, "timetables"))
    changes = layout.file_inventory(layout.list_files(spark, root, "timetable_changes"))
    assert planned.count() == 4 and changes.count() == 4
    assert {r.period for r in layout.in_planned_periods(changes, planned).collect()} == {"w1"}
    counts = {(r.feed, r.period): r.n_files for r in layout.files_per_period(planned, changes).collect()}
    assert counts == {
        ("timetables", "w1"): 3, ("timetables", "w2"): 1, ("timetables", None): 4,
        ("timetable_changes", "w1"): 3, ("timetable_changes", None): 3,
    }
    times = {r.timestamp for r in layout.snapshot_times(planned, changes).collect()}
    assert len(times) == 7 and datetime(2025, 9, 22, 19, 15) in times


def test_lake_from_files_archives_and_stream(spark, root, tmp_path):
    lake.build_lake(spark, root, str(tmp_path / "files"))
    lake.build_lake(spark, root, str(tmp_path / "dated"), by_date=True)
    packed = write_archives(type(tmp_path)(root), tmp_path / "packed")
    lake.build_lake(spark, packed, str(tmp_path / "archives"), archived=True)
    for feed in layout.FEEDS:
        documents = ingest.stream_documents(spark, root, feed, files_per_batch=2)
        ingest.ingest_feed(documents, feed, str(tmp_path / "stream"), str(tmp_path / "progress")).awaitTermination()
    read = {
        (name, feed): rows(tables.read_table(spark, str(tmp_path / name), feed))
        for name in ("files", "archives", "stream")
        for feed in layout.FEEDS
    }
    assert read["files", "timetables"] == read["archives", "timetables"] == read["stream", "timetables"]
    assert read["files", "timetable_changes"] == read["archives", "timetable_changes"]
    dated = tables.read_table(spark, str(tmp_path / "dated"), "timetables").drop("service_date", "file_path")
    assert rows(dated) == read["files", "timetables"]
    # the lake skips the change period that has no planned feed; the stream takes every file
    extra = read["stream", "timetable_changes"] - read["files", "timetable_changes"]
    assert {r[0] for r in extra} == {"q"}


def test_stream_takes_each_file_once(spark, root, tmp_path):
    def run():
        documents = ingest.stream_documents(spark, root, "timetables")
        ingest.ingest_feed(documents, "timetables", str(tmp_path / "lake"), str(tmp_path / "p")).awaitTermination()
        return tables.read_table(spark, str(tmp_path / "lake"), "timetables").count()

    assert run() == run() == 6


def test_partitioned_rerun_replaces_its_dates_only(spark, tmp_path):
    day = "select timestamp_ntz'2025-09-22 10:00:00' + make_dt_interval(d, id) as t, id, d from range(5) join {0}"
    two_days = spark.sql(day.format("(values 0, 1) v(d)"))
    one_day = spark.sql(day.format("(values 1) v(d)"))
    for df in (two_days, two_days, one_day):
        tables.overwrite_by_date(df, str(tmp_path), "t", "t", sort_by="id")
    read = tables.read_table(spark, str(tmp_path), "t")
    assert read.count() == 10 and dict(read.dtypes)["service_date"] == "date"


def test_station_files(spark, tmp_path):
    (tmp_path / "stations.json").write_text(
        '{"result": [{"number": 1, "name": "A", "evaNumbers": [{"number": 8, "geographicCoordinates":'
        ' {"type": "Point", "coordinates": [13.5, 52.25]}}, {"number": 9}],\n "mailingAddress": {"city": "Berlin"},'
        ' "ril100Identifiers": [{"rilIdentifier": "BX"}], "hasWiFi": true, "hasSteplessAccess": "partial"},'
        ' {"number": 2, "evaNumbers": []}, {"number": 3, "evaNumbers": [{"number": 7}]}]}'
    )
    (tmp_path / "none.json").write_text('{"result": null}')
    flat = stations.flatten_stations(stations.read_station_files(spark, str(tmp_path)))
    assert len(flat.columns) == 43
    picked = flat.select("station_id", "eva_number", F.col("longitude").cast("double"), "city", "has_wifi",
                         "ril100_identifier", "has_stepless_access").orderBy("station_id")
    assert [tuple(r) for r in picked.collect()] == [
        (1, 8, 13.5, "Berlin", True, "BX", "partial"),
        (2, None, None, None, None, None, None),
        (3, 7, None, None, None, None, None),
    ]
