"""The physical plans are part of the contract."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from perron.operators import delays, latest, nearest, peaks, resolve
from perron.operators.joins import left_lookup, semi_join
from perron.plans import catalog
from perron.sources import derived, tables, xml


def plan(df):
    return df._jdf.queryExecution().toString()


def physical(df):
    return plan(df).split("== Physical Plan ==")[1]


@contextlib.contextmanager
def settings(spark, **conf):
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}
TINY_SKEW = {
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    tables.overwrite_table(derived.timetables(spark, sf_dir), root, "timetables")
    tables.overwrite_table(derived.timetable_changes(spark, sf_dir), root, "timetable_changes")
    return [tables.read_table(spark, root, n) for n in ("timetables", "timetable_changes")]


def test_station_filter_and_columns_reach_both_scans(spark, lake):
    with settings(spark, spark__sql__maxMetadataStringLength="10000"):
        text = physical(delays.avg_daily_delay(*lake, "Berlin Anhalter Bf"))
    scans = re.findall(r"PushedFilters: \[(.*?)\].*?ReadSchema: struct<(.*?)>", text)
    assert len(scans) == 2
    assert all("EqualTo(station,Berlin Anhalter Bf)" in filters for filters, _ in scans)
    columns = [{c.split(":")[0] for c in schema.split(",")} for _, schema in scans]
    assert {"sid", "station", "event_type", "planned_time"} in columns
    assert {"sid", "station", "event_type", "changed_time", "cancellation_time"} in columns


def test_delay_sides_are_reduced_before_the_join(lake):
    text = physical(delays.avg_daily_delay(*lake))
    assert text.index("Join") < text.index("partial_count")  # plans read top-down


def test_peak_report_is_one_scan_without_join(spark, lake):
    with settings(spark, spark__sql__maxMetadataStringLength="10000"):
        text = physical(peaks.peak_hours_report(lake[0]))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert "EqualTo(event_type,departure)" in text


def test_peak_report_equals_two_branches(lake):
    one_pass = peaks.peak_hours_report(lake[0]).collect()
    joined = peaks.outer_join_peaks(
        peaks.peak_average(lake[0], peaks.MORNING, peaks.MORNING_COLUMN),
        peaks.peak_average(lake[0], peaks.EVENING, peaks.EVENING_COLUMN),
    )
    assert one_pass == joined.orderBy("station").collect()


def test_documents_are_parsed_once(spark, sf_dir):
    parsed = xml.parse_changes(catalog.landed(spark, sf_dir, "timetable_changes_xml"))
    for df in (xml.lake_changes(parsed), xml.warehouse_changes(parsed)):
        text = physical(df)
        operators = [line for line in text.splitlines() if "from_xml" in line]
        assert len(operators) == 1 and "Project" in operators[0]


def test_no_cross_joins(spark, sf_dir):
    for name in ("station_fuzzy_match", "station_resolution", "nearest_station_batch"):
        text = plan(catalog.QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_hot_stop_is_split_in_the_change_lookup(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    planned = spark.range(0, 60000, 1, 16).select(hot.alias("sid"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    changes = spark.range(0, 60000, 1, 16).select(hot.alias("sid"), F.col("id").alias("c"))
    newest = changes.groupBy("sid").agg(F.max("c").alias("c"))
    with settings(spark, **NO_BROADCAST, **TINY_SKEW):
        joined = left_lookup(planned, newest, ["sid"])
        rows = joined.collect()
        assert "SortMergeJoin(skew=true)" in plan(joined)
    assert len(rows) == 60000 and all(r.c is not None for r in rows)


def test_hot_place_is_split_in_the_nearest_search(spark):
    hot = F.col("id") % 3 == 0
    points = spark.range(0, 60000, 1, 16).select(
        F.col("id").alias("point_id"),
        F.when(hot, F.lit(52.5)).otherwise(52.0 + F.col("id") / 60000).alias("lat"),
        F.when(hot, F.lit(13.4)).otherwise(13.0 + F.col("id") / 60000).alias("lon"),
    )
    stations = spark.range(40).select(
        F.col("id").alias("station_key"), F.concat(F.lit("s"), "id").alias("station_name"),
        (52.0 + F.col("id") / 40).alias("latitude"), (13.0 + F.col("id") / 40).alias("longitude"),
    )
    with settings(spark, **NO_BROADCAST, **TINY_SKEW):
        found = nearest.nearest_station_batch(points, stations)
        assert len(found.collect()) == 60000
        assert "skew=true" in plan(found)


def test_report_prunes_dates(spark, sf_dir):
    with settings(spark, spark__sql__maxMetadataStringLength="10000"):
        text = physical(catalog.QUERIES["cancelled_in_period"](spark, sf_dir))
    assert re.search(r"PartitionFilters: \[.*service_date.*\], PushedFilters: \[.*is_cancelled", text)


def test_changes_combine_before_the_shuffle(spark, sf_dir):
    changes = xml.warehouse_changes(xml.parse_changes(catalog.landed(spark, sf_dir, "timetable_changes_xml")))
    text = physical(latest.latest_changes(changes))
    assert text.index("Exchange") < text.index("partial_max_by")


def test_semi_join_beyond_the_broadcast_bound(spark):
    left = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    members = spark.range(10).select(F.col("id").alias("k"))
    small, large = semi_join(left, members, "k"), semi_join(left, members, "k", small=5)
    assert "BroadcastHashJoin" in physical(small)
    with settings(spark, **NO_BROADCAST):
        assert "SortMergeJoin" in physical(large)
        assert small.count() == large.count() == 200


def test_results_do_not_depend_on_the_join_strategy(spark, sf_dir):
    names = ("station_resolution", "nearest_station_batch", "left_latest_change", "avg_daily_delay_all_stations")
    plain = {n: sorted(map(str, catalog.QUERIES[n](spark, sf_dir).collect())) for n in names}
    with settings(spark, **NO_BROADCAST):
        for n in names:
            assert sorted(map(str, catalog.QUERIES[n](spark, sf_dir).collect())) == plain[n]


def test_candidate_filters_are_sql_only():
    # no Python workers behind the matching and search operators
    for module in (resolve, nearest, delays, latest, peaks):
        assert "udf" not in open(module.__file__).read().lower()


def test_one_station_reads_its_keys_only(spark, sf_dir):
    house = catalog._warehouse(spark, sf_dir)
    text = physical(catalog.reports.avg_delay_per_station(house.fact, house.dim_station, catalog.STATION))
    assert re.search(r"PushedFilters: \[[^]]*(In|EqualTo)\(station_key", text)
