"""Loads that follow one another leave what one load of everything leaves."""

from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from feed import CHANGES, PLANNED, write_feed
from perron.operators import delays
from perron.plans import lake, warehouse
from perron.sources import files, layout, stations, tables, versions, xml
from perron.streaming import ingest

# another file of the same day, stops after midnight and without a time, a new and a known train
SECOND = {
    "w1/2509222301/berlin_s_dkreuz_timetable.xml": (
        '<timetable station="Berlin Südkreuz"><s id="n"><tl c="S" n="1" o="08"/><dp pt="2509230005"/></s>'
        '<s id="m"><tl c="IC" n="9" o="80"/><ar/></s></timetable>'
    ),
    "w1/2509221801/elsewhere_timetable.xml": (
        '<timetable station="Elsewhere"><s id="k"><tl c="RB" n="3" o="R"/><dp pt="2509222359"/></s></timetable>'
    ),
}
FIRST_CHANGES = [name for name in CHANGES if "2509221915" in name]


def documents(spark, files, feed):
    rows = [(f"/drop/{feed}/{name}", text) for name, text in files.items()]
    return spark.createDataFrame(rows, "file_path string, xml string")


def station_rows(spark, names):
    text = ",".join(f'{{"number":{n},"name":"{name}"}}' for n, name in names)
    one = spark.createDataFrame([("s", f'{{"result":[{text}]}}')], "file_path string, json string")
    return stations.parse_station_documents(one)


def drops(spark):
    """(planned, changes) of the first drop, of the second, and of both."""
    later = {n: t for n, t in CHANGES.items() if n not in FIRST_CHANGES and not n.startswith("w3")}
    parts = [
        (PLANNED, {n: CHANGES[n] for n in FIRST_CHANGES}),
        (SECOND, later),
        (PLANNED | SECOND, {n: t for n, t in CHANGES.items() if not n.startswith("w3")}),
    ]
    return [(documents(spark, p, "timetables"), documents(spark, c, "timetable_changes")) for p, c in parts]


def named(house):
    fact = house.fact.join(house.dim_station.select("station_key", "station_name"), "station_key", "left")
    fact = fact.join(house.dim_train.select("train_key", "train_id"), "train_key", "left")
    columns = sorted(set(fact.columns) - {"station_key", "train_key"})
    return Counter(map(str, fact.select(*columns).collect()))


def keys_of(house):
    trains = {r.train_id: r.train_key for r in house.dim_train.collect()}
    return trains, {r.station_name: r.station_key for r in house.dim_station.collect()}


@pytest.mark.parametrize("repeats", [1, 2])
def test_warehouse_takes_a_second_drop(spark, tmp_path, repeats):
    first, second, both = drops(spark)
    early, late = [(5, "Berlin Südkreuz")], [(5, "Berlin Südkreuz"), (4, "Elsewhere")]
    root = str(tmp_path / "two")
    house = warehouse.build_warehouse(spark, *first, station_rows(spark, early), root)
    trains, names = keys_of(house)
    for _ in range(repeats):
        house = warehouse.build_warehouse(spark, *second, station_rows(spark, late), root)
    once = warehouse.build_warehouse(spark, *both, station_rows(spark, late), str(tmp_path / "one"))
    assert named(house) == named(once) and house.fact.count() == 4 + 3
    assert {r.n_violations for r in house.violations().collect()} == {0}
    later_trains, later_names = keys_of(house)
    assert trains.items() <= later_trains.items() and names.items() <= later_names.items()
    assert set(later_trains) == set(keys_of(once)[0]) and set(later_names) == {"Berlin Südkreuz", "Elsewhere"}
    assert house.dim_train.count() == len(set(later_trains.values())) == once.dim_train.count()
    assert Counter(house.dim_time.collect()) == Counter(once.dim_time.collect())
    assert Counter(house.table("unresolved_stations").collect()) == Counter(once.table("unresolved_stations").collect())


def test_station_attributes_follow_the_newest_load_and_stations_stay(spark, tmp_path):
    planned, changes = drops(spark)[0]
    for names in ([(5, "Berlin Südkreuz"), (6, "Old")], [(5, "Berlin Südkreuz"), (5, "Berlin Südkreuz")]):
        house = warehouse.build_warehouse(spark, planned, changes, station_rows(spark, names), str(tmp_path))
    assert Counter(r.station_name for r in house.dim_station.collect()) == {"Berlin Südkreuz": 1, "Old": 1}


def test_lake_takes_a_second_drop(spark, tmp_path):
    first, second, both = drops(spark)
    for drop in (first, second, second, first):
        lake.load_lake(*drop, str(tmp_path / "two"), by_date=True)
    lake.load_lake(*both, str(tmp_path / "one"), by_date=True)
    for feed in layout.FEEDS:
        two, one = (tables.read_table(spark, str(tmp_path / name), feed) for name in ("two", "one"))
        assert Counter(map(str, two.collect())) == Counter(map(str, one.collect())) != Counter()


def test_batch_and_stream_share_a_table(spark, tmp_path):
    root, target = write_feed(tmp_path / "feed"), str(tmp_path / "lake")

    def stream():
        periods = layout.file_inventory(layout.list_files(spark, root, layout.PLANNED_FEED))
        for feed in layout.FEEDS:
            files = ingest.stream_documents(spark, root, feed, files_per_batch=2)
            ingest.ingest_feed(files, feed, target, str(tmp_path / "p"), True, periods).awaitTermination()

    lake.load_lake(*drops(spark)[1], target, by_date=True)
    stream()
    for name, text in SECOND.items():
        path = tmp_path / "feed" / "timetables" / f"{name}".replace("w1", "w2")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    stream()
    stream()
    planned, changes = (tables.read_table(spark, target, feed) for feed in layout.FEEDS)
    assert Counter(r.sid for r in planned.select(F.coalesce("sid", F.lit("")).alias("sid")).collect()) == Counter(
        {"a": 2, "b": 1, "c": 1, "e": 1, "": 1} | dict.fromkeys("nmk", 2)
    )
    lake.build_lake(spark, root, target, by_date=True)
    assert tables.read_table(spark, target, "timetables").count() == planned.count()
    # the change period without a planned feed is left out
    assert {r.sid for r in changes.collect()} == {"a"}
    assert delays.avg_daily_delay_all_stations(planned, changes).count() >= 0


def open_names(house):
    return Counter(house.table("unresolved_stations").collect())


def test_a_reader_keeps_its_version_and_a_broken_load_shows_nothing(spark, tmp_path, monkeypatch):
    first, second, both = drops(spark)
    late = [(5, "Berlin Südkreuz"), (4, "Elsewhere")]
    root = str(tmp_path / "two")
    early = warehouse.build_warehouse(spark, *first, station_rows(spark, late), root)
    before = {name: Counter(map(str, early.table(name).collect())) for name in early.version.parts}

    def broken(*args):
        raise ValueError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "fact_rows", broken)
        with pytest.raises(ValueError, match="lost"):
            warehouse.build_warehouse(spark, *second, station_rows(spark, late), root)
    opened = warehouse.Warehouse.open(spark, root)
    assert opened.version == early.version
    assert {name: Counter(map(str, opened.table(name).collect())) for name in before} == before
    house = warehouse.build_warehouse(spark, *second, station_rows(spark, late), root)
    once = warehouse.build_warehouse(spark, *both, station_rows(spark, late), str(tmp_path / "one"))
    assert named(house) == named(once) and open_names(house) == open_names(once)
    assert {name: Counter(map(str, early.table(name).collect())) for name in before} == before
    assert warehouse.Warehouse.open(spark, root).version == house.version


@pytest.mark.parametrize("other", [0, 1], ids=["other files", "the same files"])
def test_of_two_loads_at_once_one_starts_again(spark, tmp_path, monkeypatch, other):
    first, second, both = drops(spark)
    late = [(5, "Berlin Südkreuz"), (4, "Elsewhere")]
    root, parsed = str(tmp_path / "two"), []
    commit, parse = versions.Load.commit, xml.parse_planned

    def overtaken(load):
        monkeypatch.setattr(versions.Load, "commit", commit)
        warehouse.build_warehouse(spark, *(first, second)[other], station_rows(spark, late), root)
        return commit(load)

    def counted(*args, **kwargs):
        parsed.append(1)
        return parse(*args, **kwargs)

    monkeypatch.setattr(xml, "parse_planned", counted)
    monkeypatch.setattr(versions.Load, "commit", overtaken)
    house = warehouse.build_warehouse(spark, *second, station_rows(spark, late), root)
    # one parse for each load, none for the second attempt
    assert house.version.number == 2 and len(parsed) == 2
    once = warehouse.build_warehouse(spark, *((both, second)[other]), station_rows(spark, late), str(tmp_path / "one"))
    assert named(house) == named(once) and open_names(house) == open_names(once)
    assert {r.n_violations for r in house.violations().collect()} == {0}
    assert house.dim_train.count() == house.dim_train.select("train_key").distinct().count() == once.dim_train.count()
    assert Counter(house.dim_time.collect()) == Counter(once.dim_time.collect())


def test_a_load_gives_up_in_the_end(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions.Load, "commit", lambda load: None)
    with pytest.raises(RuntimeError, match="2 times"):
        warehouse.build_warehouse(spark, *drops(spark)[0], station_rows(spark, []), str(tmp_path), attempts=2)


def test_a_file_is_created_once(spark, tmp_path):
    path = str(tmp_path / "new" / "7.json")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda n: files.create_file(spark, path, str(n).encode()), range(8)))
    assert won.count(True) == 1 and files.read_file(path) == str(won.index(True)).encode()
    assert [p.name for p in (tmp_path / "new").iterdir()] == ["7.json"]
    assert not files.create_file(spark, f"file:{path}", b"x")
