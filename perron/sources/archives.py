"""``.tar.gz`` drops: every XML member becomes a document row.

Archives are a data source of their own, ``xml_archives``. A partition of it is one
archive, or a part of one, which its task opens by path and streams: neither the archive
nor its unpacked content is ever held as a whole, and archives may be of any size.

A gzip stream can be entered where one of its members begins. A first pass over
large archives (:func:`index_archives`) stores these places and the first tar header behind
each, so that several tasks read one archive; an archive of a single gzip
member stays with one task.
"""

from __future__ import annotations

import io
import json
import sys
import tarfile
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from perron.sources import files

# Workers get the classes below with the job; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(files)

MEMBER_SCHEMA = "file_path string, xml string"
INDEX_SCHEMA = "path string, packed_at bigint, skip bigint, header bigint"
MEMBERS_PER_BATCH = 256
BYTES_PER_BATCH = 16 << 20
READ_BYTES = 64 << 10
# Unpacked at a time; tar asks for much less.
INFLATE_BYTES = 256 << 10
# Compressed bytes of an archive that one task should read.
PART_BYTES = 128 << 20
SUFFIX = ".tar.gz"


def period_of(path: Column) -> Column:
    """``<feed>/<period>.tar.gz`` holds the documents of one period."""
    return F.replace(F.substring_index(path, "/", -1), F.lit(SUFFIX), F.lit(""))


class UnpackedStream(io.RawIOBase):
    """The unpacked bytes of a gzip file from one of its members on; reads forward only.

    ``begins`` lists (packed, unpacked) offsets at which members began.
    """

    def __init__(self, stream, packed_at: int = 0):
        self._stream, self._inflate = stream, None
        self._packed, self._taken, self._unpacked = b"", packed_at, 0
        self._ready, self._given = b"", 0
        self.begins: list[tuple[int, int]] = []

    def readable(self) -> bool:
        return True

    def read(self, size: int = -1) -> bytes:
        """Up to ``size`` bytes; none at the end only."""
        if size < 0:
            raise io.UnsupportedOperation("read without a size")
        if size and self._given == len(self._ready):
            self._ready, self._given = self._inflated(), 0
        data = self._ready[self._given : self._given + size]
        self._given += len(data)
        return data

    def _inflated(self) -> bytes:
        while True:
            if not self._packed:
                self._packed = self._stream.read(READ_BYTES)
                if not self._packed:
                    if self._inflate is not None:
                        raise EOFError("the archive ends inside a gzip member")
                    return b""
            if self._inflate is None:
                rest = self._packed.lstrip(b"\0")  # padding behind the last member
                self._taken += len(self._packed) - len(rest)
                self._packed = rest
                if not rest:
                    continue
                self._inflate = zlib.decompressobj(31)
                self.begins.append((self._taken, self._unpacked))
            before = len(self._packed)
            data = self._inflate.decompress(self._packed, INFLATE_BYTES)
            self._packed = self._inflate.unused_data if self._inflate.eof else self._inflate.unconsumed_tail
            self._taken += before - len(self._packed)
            if self._inflate.eof:
                self._inflate = None
            if data:
                self._unpacked += len(data)
                return data

    def skip(self, size: int) -> None:
        while size:
            size -= len(self.read(size))


class _Whole(io.RawIOBase):
    """Reads as many bytes as asked for, as tar needs them."""

    def __init__(self, stream: UnpackedStream):
        self.stream = stream

    def read(self, size: int = -1) -> bytes:
        parts = []
        while size and (data := self.stream.read(size)):
            parts.append(data)
            size -= len(data)
        return b"".join(parts)


@dataclass
class ArchivePart(InputPartition):
    """Members whose headers lie in [header, end) of the unpacked archive; entered at ``packed_at``, ``skip`` bytes before the first."""

    path: str
    packed_at: int = 0
    skip: int = 0
    header: int = 0
    end: int | None = None


def members(part: ArchivePart) -> Iterator[tuple[str, bytes]]:
    """(path, content) of the XML members; paths are those below the folder an archive would be unpacked to."""
    system, at = files.file_system(part.path)
    folder = part.path.removesuffix(SUFFIX)
    with system.open_input_file(at) as packed:
        packed.seek(part.packed_at)
        stream = UnpackedStream(packed, part.packed_at)
        stream.skip(part.skip)
        with tarfile.open(fileobj=_Whole(stream), mode="r|") as archive:
            for member in archive:
                if part.end is not None and part.header + member.offset >= part.end:
                    return
                if member.isfile() and member.name.endswith(".xml"):
                    yield f"{folder}/{member.name.removeprefix('./')}", archive.extractfile(member).read()
                archive.members = []  # tarfile keeps every header otherwise


def _to_batch(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    paths, texts = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())], names=["file_path", "xml"])


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.periods = json.loads(options["periods"]) if "periods" in options else None
        self.index = options.get("index")

    def archives(self) -> list[str]:
        found = sorted(e.path for e in files.entries(self.root, recursive=True) if e.is_file and e.path.endswith(SUFFIX))
        prefix = self.root.split("://")[0] + "://" if "://" in self.root and not self.root.startswith("file://") else ""
        wanted = None if self.periods is None else set(self.periods)
        return [prefix + p for p in found if wanted is None or p.rpartition("/")[2].removesuffix(SUFFIX) in wanted]

    def partitions(self) -> list[ArchivePart]:
        places: dict[str, list[dict]] = {}
        if self.index:
            from pyarrow import dataset

            system, at = files.file_system(self.index)
            for row in dataset.dataset(at, filesystem=system, format="parquet").to_table().to_pylist():
                places.setdefault(row["path"], []).append(row)
        parts = []
        for path in self.archives():
            begin = sorted(places.get(path, []), key=lambda r: r["header"]) or [{"packed_at": 0, "skip": 0, "header": 0}]
            ends = [r["header"] for r in begin[1:]] + [None]
            parts += [ArchivePart(path, r["packed_at"], r["skip"], r["header"], end) for r, end in zip(begin, ends)]
        return parts

    def read(self, partition: ArchivePart) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for path, data in members(partition):
            rows.append((path, data.decode("utf-8", "replace")))
            size += len(data)
            if len(rows) >= MEMBERS_PER_BATCH or size >= BYTES_PER_BATCH:
                yield _to_batch(rows)
                rows, size = [], 0
        if rows:
            yield _to_batch(rows)


class ArchiveSource(DataSource):
    """``spark.read.format("xml_archives").load(folder)``: the XML members of all ``*.tar.gz`` below the folder.

    Options: ``periods`` (JSON list), archives of other periods are not opened; ``index``, the
    table of :func:`index_archives`.
    """

    @classmethod
    def name(cls) -> str:
        return "xml_archives"

    def schema(self) -> str:
        return MEMBER_SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(dict(self.options))


def read_documents(spark: SparkSession, root: str, feed: str, periods: list[str] | None = None, index: str | None = None) -> DataFrame:
    """(file_path, xml) of the archives at any depth below the feed, or of those of the ``periods`` only."""
    spark.dataSource.register(ArchiveSource)
    reader = spark.read.format(ArchiveSource.name())
    if periods is not None:
        reader = reader.option("periods", json.dumps(sorted(periods)))
    if index is not None:
        reader = reader.option("index", index)
    return reader.load(f"{root.rstrip('/')}/{feed}")


def archive_periods(root: str, feed: str) -> list[str]:
    """The periods of a feed's archives, from their names alone."""
    found = (e.path for e in files.entries(f"{root.rstrip('/')}/{feed}", recursive=True) if e.is_file)
    return sorted({p.rpartition("/")[2].removesuffix(SUFFIX) for p in found if p.endswith(SUFFIX)})


def restart_points(path: str, part_bytes: int = PART_BYTES) -> list[tuple[int, int, int]]:
    """(packed_at, skip, header) of places about ``part_bytes`` apart: where a gzip member begins, and the first tar header from there on."""
    system, at = files.file_system(path)
    headers = []
    with system.open_input_stream(at, compression=None) as packed:
        stream = UnpackedStream(packed)
        with tarfile.open(fileobj=_Whole(stream), mode="r|") as archive:
            for member in archive:
                headers.append(member.offset)
                archive.members = []
    out = [(0, 0, 0)]
    for packed_at, unpacked in stream.begins:
        next_header = bisect_left(headers, unpacked)
        if packed_at - out[-1][0] >= part_bytes and next_header < len(headers) and headers[next_header] > out[-1][2]:
            out.append((packed_at, headers[next_header] - unpacked, headers[next_header]))
    return out


def index_archives(spark: SparkSession, root: str, feed: str, target: str, part_bytes: int = PART_BYTES) -> str:
    """Writes the restart points of archives of more than ``part_bytes`` to the table ``target``; a task streams one archive."""
    reader = ArchiveReader({"path": f"{root.rstrip('/')}/{feed}"})
    large = []
    for path in reader.archives():
        system, at = files.file_system(path)
        if system.get_file_info(at).size > part_bytes:
            large.append((path,))

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                packed, skip, header = zip(*restart_points(path, part_bytes))
                columns = [pa.array([path] * len(packed)), *(pa.array(c, pa.int64()) for c in (packed, skip, header))]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "packed_at", "skip", "header"])

    listed = spark.createDataFrame(large, "path string").repartition(max(1, len(large)))
    listed.mapInArrow(points, INDEX_SCHEMA).write.mode("overwrite").parquet(target)
    return target


def write_archives(documents: DataFrame, root: str, feed: str, member_bytes: int = 32 << 20, archive_bytes: int = 256 << 20) -> DataFrame:
    """Packs (file_path, xml) documents into ``<root>/<feed>/<task>/<period>.tar.gz`` and returns (path, n_members), lazily.

    A task writes an archive for each of its periods, and a further one beyond ``archive_bytes``. Gzip members
    begin anew about every ``member_bytes``, so that readers can enter there. Names depend on the task's number
    only: a repeated task replaces its own files.
    """
    folder = f"{root.rstrip('/')}/{feed}"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, run, held = TaskContext.get().partitionId(), 0, None

        def done() -> pa.RecordBatch:
            path = f"{folder}/{number:06d}-{run:06d}/{held[0]}{SUFFIX}"
            files.write_file(path, held[1].finished())
            return pa.RecordBatch.from_pydict({"path": [path], "n_members": [held[1].members]})

        for batch in batches:
            for path, text in zip(batch.column("file_path").to_pylist(), batch.column("xml").to_pylist()):
                period, snapshot, name = path.split("/")[-3:]
                if held is None or held[0] != period or held[1].out.tell() >= archive_bytes:
                    if held:
                        yield done()
                        run += 1
                    held = period, _Packer(member_bytes)
                held[1].add(f"./{snapshot}/{name}", (text or "").encode())
        if held:
            yield done()

    return documents.select("file_path", "xml").sortWithinPartitions("file_path").mapInArrow(packed, "path string, n_members bigint")


class _Packer:
    """A tar archive as a row of gzip members."""

    def __init__(self, member_bytes: int):
        self.member_bytes, self.members = member_bytes, 0
        self.raw, self.out = io.BytesIO(), io.BytesIO()

    def add(self, name: str, data: bytes) -> None:
        info = tarfile.TarInfo(name)
        info.size = len(data)
        self.raw.write(info.tobuf(tarfile.PAX_FORMAT))
        self.raw.write(data + b"\0" * (-len(data) % tarfile.BLOCKSIZE))
        self.members += 1
        if self.raw.tell() >= self.member_bytes:
            self._pack()

    def _pack(self) -> None:
        squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.out.write(squeeze.compress(self.raw.getvalue()) + squeeze.flush())
        self.raw = io.BytesIO()

    def finished(self) -> bytes:
        self.raw.write(b"\0" * tarfile.RECORDSIZE)
        self._pack()
        return self.out.getvalue()
