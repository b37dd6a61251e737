from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feed import write_feed
from perron.operators import joins, keys, latest, resolve
from perron.plans import dimensions, reports, schema_check, warehouse
from perron.sources import derived, layout, stations, xml


@pytest.fixture(scope="module")
def feed_root(tmp_path_factory):
    return write_feed(tmp_path_factory.mktemp("feed"))


@pytest.fixture(scope="module")
def documents(spark, feed_root):
    root = feed_root
    return [xml.read_documents(spark, root, feed) for feed in ("timetables", "timetable_changes")]


@pytest.fixture(scope="module")
def house(spark, documents, feed_root, tmp_path_factory):
    text = '{"result":[{"number":5,"name":"Berlin Südkreuz"},{"number":6,"name":"Elsewhere"}]}'
    station_rows = stations.parse_station_documents(spark.createDataFrame([("s", text)], "file_path string, json string"))
    root = str(tmp_path_factory.mktemp("house"))
    warehouse.build_warehouse(spark, *documents, station_rows, root)
    # a rerun changes nothing, also with the file list given
    files = tuple(layout.list_files(spark, feed_root, feed) for feed in layout.FEEDS)
    return warehouse.build_warehouse(spark, *documents, station_rows, root, files=files)


def test_fact(house):
    got = {(r.sid, r.event_type, r.planned_time): r for r in house.fact.collect()}
    assert len(got) == house.fact.count() == 4
    arrival = got["a", "AR", datetime(2025, 9, 22, 19, 39)]
    # the newest snapshot of the same day wins; the one after midnight is another day
    assert arrival.actual_time == datetime(2025, 9, 22, 19, 37) and arrival.delay_minutes == -2
    assert (arrival.actual_platform, arrival.is_cancelled, arrival.has_disruption) == ("3", False, False)
    first = got["a", "DP", datetime(2025, 9, 22, 19, 41)]
    # two changed departures in one file: the later element wins, for both planned ones
    assert first.actual_time == datetime(2025, 9, 22, 19, 55) and first.delay_minutes == 14
    assert first.cancellation_time == datetime(2025, 9, 22, 19, 0) and not first.is_cancelled
    assert got["a", "DP", datetime(2025, 9, 22, 19, 59)].delay_minutes == -4
    lone = got["c", "AR", None]
    assert lone.time_key is None and lone.actual_time is None and lone.is_cancelled is False


def test_dimensions(house):
    assert house.dim_station.count() == 2
    trains = {r.train_id: r for r in house.dim_train.collect()}
    assert set(trains) == {"S_1_08", "RE_7_UNK", "S__UNK"}
    assert trains["S_1_08"].train_type_desc == "Passenger"  # first row of the id
    assert trains["S__UNK"].train_number is None  # inferred from a movement
    times = house.dim_time
    assert times.count() == times.select("timestamp").distinct().count() == 7 + 4
    assert {r.n_violations for r in house.violations().collect()} == {0}
    (open_name,) = house.table("unresolved_stations").collect()
    assert (open_name.xml_station, open_name.file_station, open_name.n_rows) == ("", "no station+name", 1)


def test_schemas_match_the_declared_ones(house):
    assert schema_check.differences(house) == {}


def test_reports(house):
    (row,) = reports.avg_delay_per_station(house.fact, house.dim_station).collect()
    assert row.station_name == "Berlin Südkreuz" and row.avg_delay == pytest.approx((-2 + 14 - 4) / 3)
    assert reports.avg_delay_per_station(house.fact, house.dim_station, "Elsewhere").count() == 0
    n = reports.cancelled_in_period(house.fact, datetime(2025, 9, 1), datetime(2025, 10, 1)).first()[0]
    assert n == 0


def test_upserts_are_idempotent(spark):
    times = spark.sql("select explode(sequence(timestamp_ntz'2025-01-01', timestamp_ntz'2025-01-02', interval 1 hour)) timestamp")
    once = dimensions.upsert_dim_time(dimensions.time_members(times.limit(3)), times)
    twice = dimensions.upsert_dim_time(once, times)
    assert once.count() == twice.count() == 25
    members = spark.range(3000).select(F.concat(F.lit("S_"), "id", F.lit("_UNK")).alias("train_id"))
    first = keys.add_keys(members.where("train_id < 'S_2'"), ["train_id"], "train_key")
    second = dimensions.upsert_dim_train(first, members)
    third = dimensions.upsert_dim_train(second, members)
    assert second.count() == third.count() == 3000
    assert second.select("train_key").distinct().count() == 3000
    assert second.intersect(first).count() == first.count()  # known trains keep their keys


def test_latest_change_does_not_depend_on_row_order(spark, documents):
    changes = xml.warehouse_changes(xml.parse_changes(documents[1]))
    shuffled = changes.orderBy(F.rand(1)).repartition(5)
    expected = sorted(map(tuple, latest.latest_changes(changes).collect()), key=str)
    assert sorted(map(tuple, latest.latest_changes(shuffled).collect()), key=str) == expected


def test_long_lookups_are_merged(spark, tmp_path):
    names = spark.range(50).select(F.col("id").cast("string").alias("xml_station"), F.lit("f").alias("file_station"), F.col("id").alias("station_key"))
    names.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    rows = spark.range(200).select((F.col("id") % 60).cast("string").alias("xml_station"), F.lit("f").alias("file_station"))
    for small, kind in ((10, "SortMergeJoin"), (50, "BroadcastHashJoin")):
        found = joins.stored_lookup(rows, stored, ["xml_station", "file_station"], small)
        assert kind in found._jdf.queryExecution().executedPlan().toString()
        assert found.where("station_key is null").count() == sum(n % 60 >= 50 for n in range(200))


def test_lookups_of_some_thousand_rows_are_merged(spark, tmp_path):
    spark.range(20_000).select(F.col("id").cast("string").alias("train_id"), F.col("id").alias("train_key")).write.parquet(str(tmp_path / "t"))
    rows = spark.range(50).select((F.col("id") * 1000).cast("string").alias("train_id"))
    found = joins.stored_lookup(rows, spark.read.parquet(str(tmp_path / "t")), ["train_id"])
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.where("train_key is not null").count() == 20 and found.count() == 50


def test_lists_of_stations_are_never_broadcast(spark, tmp_path):
    rows = [(1, "a", 7, "x"), (2, "b", None, "y"), (None, None, None, "z"), (3, "c", 8, "w")]
    spark.createDataFrame(rows, "station_number int, station_name string, eva_number int, city string").write.parquet(str(tmp_path / "t"))
    given = spark.read.parquet(str(tmp_path / "t"))
    dimensions.added_station_keys(given.where("city <> 'w'"), None).write.parquet(str(tmp_path / "keys"))
    stored = spark.read.parquet(str(tmp_path / "keys"))
    keyed, added = dimensions.keyed_stations(given, stored), dimensions.added_station_keys(given, stored)
    assert sorted(r.city for r in keyed.collect()) == ["x", "y", "z"]
    assert [r.station_number for r in added.collect()] == [3]
    assert "Broadcast" not in keyed._jdf.queryExecution().executedPlan().toString()
    plan = added._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [coalesce(station_number" in plan


def test_names_are_never_broadcast(spark, tmp_path):
    spark.createDataFrame([("a", 1, "A"), ("b", 2, "B")], "normalized string, station_key long, station_name string").write.parquet(str(tmp_path / "t"))
    names = spark.createDataFrame([("A", "b"), (None, "B"), ("x", "y")], "xml_station string, file_station string")
    found = resolve.exact_matches(names, spark.read.parquet(str(tmp_path / "t")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted(str(r.station_key) for r in found.collect()) == ["1", "2", "None"]


@pytest.mark.parametrize("documents", [derived.planned_documents, derived.change_documents])
def test_texts_are_rendered_after_the_shuffle(spark, sf_dir, documents):
    plan = documents(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    # read from the result down to the tables: both halves of the aggregate stand above the exchange
    assert plan.index("partial_collect_list") < plan.index("Exchange hashpartitioning")
    assert plan.count("Exchange hashpartitioning") == 1
