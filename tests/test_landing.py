"""Archives as a source, landed files and the log of loads."""

import os
import re
import tarfile
import tracemalloc
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feed import CHANGES, PLANNED, write_archives, write_feed
from perron.plans import lake, landing, loadlog
from perron.sources import archives, files, layout, tables, xml
from test_drops import documents


def paths_of(df):
    return sorted(r.file_path for r in df.select("file_path").collect())


def many(spark, n, size=400):
    rows = [(f"/drop/timetables/w{i % 3}/25092219{i % 60:02d}/s{i:05d}_timetable.xml", f'<timetable station="{i}">{"é" * (i % size)}</timetable>') for i in range(n)]
    return spark.createDataFrame(rows, "file_path string, xml string").repartition(2), dict(rows)


def tail(path):
    return "/".join(path.split("/")[-3:])


@pytest.mark.parametrize("part_bytes", [None, 3_000])
def test_archives_of_many_members(spark, tmp_path, part_bytes):
    docs, expected = many(spark, 1500)
    written = archives.write_archives(docs, str(tmp_path), "timetables", member_bytes=20_000).collect()
    assert sum(r.n_members for r in written) == 1500
    index = part_bytes and archives.index_archives(spark, str(tmp_path), "timetables", str(tmp_path / "index"), part_bytes)
    read = archives.read_documents(spark, str(tmp_path), "timetables", index=index)
    assert {tail(r.file_path): r.xml for r in read.collect()} == {tail(p): x for p, x in expected.items()}
    assert read.count() == 1500
    parts = read.rdd.getNumPartitions()
    assert parts > len(written) if part_bytes else parts == len(written)
    plan = read._jdf.queryExecution().toString()
    assert "content" not in plan and "binaryFile" not in plan
    some = archives.read_documents(spark, str(tmp_path), "timetables", ["w1"], index)
    assert {r.file_path.split("/")[-3] for r in some.collect()} == {"w1"} and some.count() == 500


def test_archive_memory_does_not_follow_its_size(tmp_path):
    path = tmp_path / "w.tar.gz"
    with tarfile.open(path, "w:gz") as archive:
        for i in range(60):
            (tmp_path / "x.xml").write_bytes(os.urandom(500_000) * 2)
            archive.add(tmp_path / "x.xml", arcname=f"./f/{i}.xml")
    tracemalloc.start()
    sizes = [len(data) for _, data in archives.members(archives.ArchivePart(str(path)))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes == [1_000_000] * 60 and peak < 12_000_000


def test_archives_that_end_early_fail(tmp_path):
    packed = write_archives(tmp_path / "plain" if write_feed(tmp_path / "plain") else None, tmp_path / "packed")
    path = f"{packed}/timetables/w1.tar.gz"
    with open(path, "rb") as f:
        data = f.read()
    with open(path, "ab") as f:
        f.write(b"\0" * 5000)  # padding is fine
    whole = [name for name, _ in archives.members(archives.ArchivePart(path))]
    assert len(whole) == 3
    files.write_file(path, data[: len(data) // 2])
    with pytest.raises((EOFError, tarfile.ReadError)):
        list(archives.members(archives.ArchivePart(path)))


def test_landing_takes_each_file_once(spark, tmp_path):
    root, store = write_feed(tmp_path / "feed"), str(tmp_path / "store")

    def landed():
        return landing.documents(spark, store, "timetables")

    first = landing.land(spark, root, "timetables", store)
    read = xml.read_documents(spark, root, "timetables")
    content = {tail(r.file_path): r.xml for r in read.collect()}
    assert {tail(r.file_path): r.xml for r in landed().collect()} == content and landed().count() == len(PLANNED)
    assert landing.land(spark, root, "timetables", store) is None
    # a new folder, and a new and an empty file in a known one
    for name, text in (("w2/2509292101/a_timetable.xml", "<timetable/>"), ("w1/2509222001/b_timetable.xml", ""), ("w1/2509222001/c_timetable.txt", "no")):
        path = tmp_path / "feed" / "timetables" / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)
    second = landing.land(spark, root, "timetables", store)
    assert [tail(p) for p in paths_of(landing.documents(spark, store, "timetables", [second]))] == ["w1/2509222001/b_timetable.xml", "w2/2509292101/a_timetable.xml"]
    relisted = spark.read.parquet(f"{store}/timetables/folders/batch={second}")
    assert {r.folder for r in relisted.collect()} == {"2509222001", "2509292101"}
    states = {tail(r.file_path): (r.state, r.period, r.day) for r in landing.inventory(spark, store, "timetables").collect()}
    assert states["w1/2509222001/b_timetable.xml"] == ("empty", "w1", "250922") and len(states) == len(PLANNED) + 2
    assert landing.commits(store, "timetables") == [first, second]
    before = paths_of(landed())
    merged = landing.compact(spark, store, "timetables")
    assert landing.commits(store, "timetables") == [merged] and paths_of(landed()) == before
    assert landing.compact(spark, store, "timetables") is None and landing.land(spark, root, "timetables", store) is None
    assert landing.land(spark, str(tmp_path / "nowhere"), "timetables", store) is None


def test_a_landing_that_broke_off_is_not_read(spark, tmp_path, monkeypatch):
    root, store = write_feed(tmp_path / "feed"), str(tmp_path / "store")

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(landing, "_commit", broken)
    with pytest.raises(RuntimeError):
        landing.land(spark, root, "timetables", store)
    assert landing.documents(spark, store, "timetables").count() == 0
    monkeypatch.undo()
    landing.land(spark, root, "timetables", store)
    assert landing.documents(spark, store, "timetables").count() == len(PLANNED) == landing.inventory(spark, store, "timetables").count()


def test_lake_from_landed_documents(spark, tmp_path):
    root, store = write_feed(tmp_path / "feed"), str(tmp_path / "store")
    for feed in layout.FEEDS:
        landing.land(spark, root, feed, store)
    assert lake.load_landed(spark, store, str(tmp_path / "a")) == {"timetables": 4, "timetable_changes": 3}
    assert lake.load_landed(spark, store, str(tmp_path / "a")) == {"timetables": 0, "timetable_changes": 0}
    lake.build_lake(spark, root, str(tmp_path / "b"), by_date=True)
    for feed in layout.FEEDS:
        a, b = (tables.read_table(spark, str(tmp_path / name), feed).drop("file_path").collect() for name in "ab")
        assert Counter(a) == Counter(b) != Counter()


def test_known_files_go_before_the_parse(spark, tmp_path):
    planned = documents(spark, PLANNED, "timetables")
    root = str(tmp_path)
    assert lake.append_documents(planned, "timetables", root) == 4
    log = loadlog.LoadLog(planned.where("file_path like '%/w1/%'"), root, "timetables")
    rows = lake.lake_rows(log.fresh(log.documents), "timetables", True)
    optimized = rows._jdf.queryExecution().optimizedPlan().toString()
    assert re.search("from_xml|xmltostructs", optimized, re.I).start() < optimized.index("LeftAnti")
    # only the units of the drop are listed
    known = re.search(r"PartitionFilters: \[(.*?)\]", log.taken._jdf.queryExecution().toString())[1]
    assert "w1_250922" in known and "w2_250929" not in known
    # the pass that wrote the rows counted them, and set the broken document aside
    loads = tables.read_table(spark, root, "timetables_loads").drop("load").collect()
    assert [r.asDict() for r in loads] == [{"n_files": 4, "n_rows": 6, "n_corrupt": 1}]
    (broken,) = tables.read_table(spark, root, "timetables_corrupt").collect()
    assert broken.file_path.endswith("cut_timetable.xml") and "2509" in broken.content
    # a file without rows is known as well
    assert rows.count() == 0 and log.fresh(log.files).count() == 0
    assert lake.append_documents(planned, "timetables", root) == 0


@pytest.mark.parametrize("step", ["timetables", "timetables_loads"])
def test_a_load_that_broke_off_is_completed(spark, tmp_path, monkeypatch, step):
    planned = documents(spark, PLANNED, "timetables")
    append = tables.append_table

    def breaks(df, root, name, partition_by=()):
        if name == step:
            raise RuntimeError("lost")
        return append(df, root, name, partition_by)

    root = str(tmp_path / "lake")
    lake.append_documents(planned.where("file_path like '%/w2/%'"), "timetables", root)
    monkeypatch.setattr(tables, "append_table", breaks)
    with pytest.raises(RuntimeError):
        lake.append_documents(planned, "timetables", root)
    monkeypatch.undo()
    for _ in range(2):
        lake.append_documents(planned, "timetables", root)
    lake.append_documents(planned, "timetables", str(tmp_path / "once"))
    got, once = (Counter(map(str, tables.read_table(spark, r, "timetables").collect())) for r in (root, str(tmp_path / "once")))
    assert got == once != Counter()
    # nothing is left open
    assert loadlog.LoadLog(planned, root, "timetables").recovered is None


def test_a_table_older_than_its_log(spark, tmp_path):
    planned = documents(spark, PLANNED, "timetables")
    rows = lake.lake_rows(planned, "timetables", True)
    tables.append_table(rows.withColumn("service_date", F.to_date("planned_time")), str(tmp_path), "timetables", ("service_date",))
    before = tables.read_table(spark, str(tmp_path), "timetables").count()
    lake.append_documents(planned, "timetables", str(tmp_path))
    assert tables.read_table(spark, str(tmp_path), "timetables").count() == before
    assert len(CHANGES) == 4


def test_lists_of_paths_are_merged(spark, tmp_path):
    # some hundred bytes of Parquet hold all these paths, so their size is guessed far too small
    paths = spark.range(5000).select(F.format_string("/a/long/folder/w1/2509221901/%07d_timetable.xml", "id").alias("file_path"))
    paths.write.parquet(str(tmp_path / "t"))
    known = spark.read.parquet(str(tmp_path / "t"))
    left = tables.of_new_files(paths.union(spark.createDataFrame([("/new",)], "file_path string")), known)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert [r.file_path for r in left.collect()] == ["/new"]


def test_a_new_drop_is_not_compared_text_by_text(spark, tmp_path, monkeypatch):
    def documents(*names):
        return spark.createDataFrame([(f"/d/timetables/w1/2509221901/{n}.xml", "<timetable><s id='a'><ar/></s></timetable>") for n in names], "file_path string, xml string")

    compared, of_new_files = [], tables.of_new_files

    def counted(df, known, *args):
        compared.append("xml" in df.columns and known is not None)
        return of_new_files(df, known, *args)

    monkeypatch.setattr(tables, "of_new_files", counted)
    assert lake.append_documents(documents("a", "b"), layout.PLANNED_FEED, str(tmp_path)) == 2
    assert lake.append_documents(documents("c"), layout.PLANNED_FEED, str(tmp_path)) == 1
    assert not any(compared)
    # partly known: texts are compared; the same new file twice is one file of two documents, as before
    assert lake.append_documents(documents("c", "d", "d"), layout.PLANNED_FEED, str(tmp_path)) == 1
    assert any(compared)
    assert tables.read_table(spark, str(tmp_path), layout.PLANNED_FEED).count() == 5
