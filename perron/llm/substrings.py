"""Substring dedup: count-min sketches find the word windows worth grouping exactly.

Documents are packed once into chunks. Every chunk sends each shard of the hash
range a sparse count-min sketch of its windows (two rows of counters, coded as
gaps); a shard adds the chunks' sketches up and answers, counter by counter,
whether the sum reaches two. Sums only overestimate, so no repeated window is
lost. In the second pass a chunk sends the exact hashes (96 bits) and least
doc_id of the windows whose counters all reach two, shards group them, and answer
one bit per window. The number of shards follows the corpus, so sketches stay as
sharp and groups as large at any size; nothing is broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perron.llm.files import shared_dir
from perron.llm.hashing import U64, Words, mix, pieces, text_bytes, window_hashes
from perron.llm.tables import saved, task_count

WINDOW = 13
CHUNK_BYTES = 4 << 20
# Windows per shard, and counters per row of its sketch: loaded to a quarter.
SHARD_WINDOWS, COUNTER_BITS = 1 << 20, 22


# ---- coding -----------------------------------------------------------------


def pack_planes(*arrays: np.ndarray) -> bytes:
    """Integers as byte planes, so that zstd finds the empty and the even ones."""
    out = []
    for a in arrays:
        planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T
        out.append(np.ascontiguousarray(planes).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack_planes(data: bytes, n: int, *types: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 0
    for t in types:
        width = np.dtype(t).itemsize
        planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(t).reshape(n))
        at += n * width
    return out


def gaps(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


def pack_bits(bits: np.ndarray) -> bytes:
    return np.packbits(bits).tobytes()


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


# ---- a chunk ----------------------------------------------------------------


def pack_chunk(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


def unpack_chunk(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)).read_next_batch()


class Chunk:
    """The distinct windows of a chunk in order of hash, with least and greatest doc_id.

    Rows without a doc_id have words but no windows.
    """

    def __init__(self, texts: pa.Array, ids: pa.Array, window: int):
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        own = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.counts, hashes, docs, starts, at = [], [], [], [], 0
        table = pa.RecordBatch.from_arrays([texts, pa.array(np.arange(len(own)))], names=["text", "row"])
        for piece in pieces(iter([table]), "text"):
            words = Words(*text_bytes(piece.column("text")))
            rows = piece.column("row").to_numpy()
            h = window_hashes(words.hashes(), window)
            inside = words.text[: len(h)] == words.text[window - 1 :] if len(h) else np.zeros(0, bool)
            row = rows[words.text[: len(h)]] if len(h) else np.zeros(0, np.int64)
            inside &= known[row]
            hashes.append(h[inside])
            docs.append(own[row[inside]])
            starts.append(np.flatnonzero(inside) + at)
            self.counts.append(words.count)
            at += len(words.start)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.counts, self.words = join(self.counts, np.int64), at
        self.hash, self.doc, self.start = join(hashes, U64), join(docs, np.int64), join(starts, np.int64)
        self.order = np.argsort(self.hash)
        ordered = self.hash[self.order]
        self.first = np.flatnonzero(np.diff(ordered, prepend=~ordered[:1]) != 0)
        self.key = ordered[self.first]
        by_hash = self.doc[self.order]
        self.least = np.minimum.reduceat(by_hash, self.first) if len(self.first) else by_hash
        self.greatest = np.maximum.reduceat(by_hash, self.first) if len(self.first) else by_hash


def _place(key: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each hash and its counter in the first row; both rise with the hash."""
    scaled = (key >> U64(32)) * U64(shards)
    return (scaled >> U64(32)).astype(np.int64), ((scaled & U64(0xFFFFFFFF)) >> U64(32 - COUNTER_BITS)).astype(np.uint32)


def _second(key: np.ndarray) -> np.ndarray:
    return (mix(key ^ U64(0x1234567812345678)) >> U64(64 - COUNTER_BITS)).astype(np.uint32)


def _check(key_windows: np.ndarray) -> np.ndarray:
    return (mix(key_windows) >> U64(32)).astype(np.uint32)


def sparse_sketches(chunk: Chunk, shards: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, slice]]:
    """(shard, entries, first row, second row, keys) per shard; a window of two documents counts twice."""
    shard, first = _place(chunk.key, shards)
    second = _second(chunk.key)
    edges = np.searchsorted(shard, np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(edges)):
        keys = slice(edges[s], edges[s + 1])
        times = 1 + (chunk.greatest[keys] > chunk.least[keys])
        yield int(s), int(times.sum()), np.repeat(first[keys], times), np.repeat(second[keys], times), keys


def estimated_repeated(chunk: Chunk, shards: int, answers: dict[int, bytes]) -> np.ndarray:
    """For each distinct window, whether both of its counters reach two."""
    out = np.zeros(len(chunk.key), bool)
    for s, n, _, second, keys in sparse_sketches(chunk, shards):
        bits = unpack_bits(answers[s], 2 * n)
        order = np.argsort(second, kind="stable")
        other = np.empty(n, bool)
        other[order] = bits[n:]
        times = 1 + (chunk.greatest[keys] > chunk.least[keys])
        entry = np.cumsum(times) - times
        out[keys] = bits[:n][entry] & other[entry]
    return out


def window_checks(texts: pa.Array, chunk: Chunk, wanted: np.ndarray, window: int) -> np.ndarray:
    """32 more bits for each wanted distinct window, from another hash of its words."""
    checks, at = np.zeros(chunk.words, np.uint32), 0
    for piece in pieces(iter([pa.RecordBatch.from_arrays([texts], names=["text"])]), "text"):
        words = Words(*text_bytes(piece.column("text")))
        h = window_hashes(words.hashes(), window, 7)
        checks[at : at + len(h)] = _check(h)
        at += len(words.start)
    return checks[chunk.start[chunk.order[chunk.first[wanted]]]]


# ---- tables -----------------------------------------------------------------


def _packed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(chunk, windows, blob): all columns of some MB of rows, in a table bucketed by chunk.

    Bucketing spares the later passes a shuffle of the texts.
    """
    spark = docs.sparkSession
    shown = docs.select(F.col(key).cast("bigint").alias("s_key"), F.col(text).alias("s_text"), F.struct("*").alias("s_row"), F.monotonically_increasing_id().alias("s_chunk"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def chunk() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            words = sum(int(np.maximum(Words(*text_bytes(p.column("s_text"))).count - WINDOW + 1, 0).sum()) for p in pieces(iter([table]), "s_text"))
            return pa.RecordBatch.from_pydict({"chunk": [table.column("s_chunk")[0].as_py()], "windows": [words], "blob": [pack_chunk(table)]})

        for batch in pieces(batches, "s_text"):
            held.append(batch)
            size += batch.nbytes
            if size >= CHUNK_BYTES:
                yield chunk()
                held, size = [], 0
        if held:
            yield chunk()

    name = f"substring_chunks_{uuid.uuid4().hex}"
    rows = shown.mapInArrow(packed, "chunk bigint, windows bigint, blob binary")
    rows.write.bucketBy(task_count(spark), "chunk").option("path", shared_dir(spark, "substrings")).option("compression", "none").saveAsTable(name)
    return spark.table(name)


def _answers(sent: DataFrame, merge) -> DataFrame:
    """(chunk, answers): what ``merge`` says, shard by shard, to every chunk."""
    bits = sent.groupBy("shard").applyInArrow(merge, "chunk bigint, shard int, bits binary")
    return bits.groupBy("chunk").agg(F.collect_list(F.struct("shard", "bits")).alias("answers"))


def merged_sketches(table: pa.Table) -> pa.Table:
    """Adds up one shard's sketches; tells each sender which of its counters reach two."""
    size = 1 << COUNTER_BITS
    sums = np.zeros((2, size), np.uint8)
    sketches = list(zip(table.column("n").to_pylist(), table.column("blob").to_pylist()))
    for n, blob in sketches:
        for row, g in enumerate(unpack_planes(blob, n, np.uint32, np.uint32)):
            at = np.cumsum(g, dtype=np.uint32)
            again = np.flatnonzero(np.diff(at) == 0)
            sums[row, at] = np.minimum(sums[row, at] + 1, 2)
            sums[row, at[again]] = 2
    bits = [
        pack_bits(np.concatenate([sums[row, np.cumsum(g, dtype=np.uint32)] > 1 for row, g in enumerate(unpack_planes(blob, n, np.uint32, np.uint32))]))
        for n, blob in sketches
    ]
    return _replies(table, bits)


def grouped_windows(table: pa.Table) -> pa.Table:
    """Groups one shard's windows exactly; tells each sender where a smaller doc_id than its own least has the window."""
    sizes = np.array(table.column("n").to_pylist(), np.int64)
    parts = [unpack_planes(blob, n, np.uint64, np.uint32, np.int64) for n, blob in zip(sizes, table.column("blob").to_pylist())]
    key = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    check, doc = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    order = np.lexsort((check, key))
    key, check = key[order], check[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
    least = np.minimum.reduceat(doc[order], np.flatnonzero(fresh))
    smaller = np.empty(len(key), bool)
    smaller[order] = least[np.cumsum(fresh) - 1] < doc[order]
    ends = np.cumsum(sizes)
    return _replies(table, [pack_bits(smaller[e - n : e]) for n, e in zip(sizes, ends)])


def _replies(table: pa.Table, bits: list[bytes]) -> pa.Table:
    return pa.table({"chunk": table.column("chunk").combine_chunks(), "shard": table.column("shard").combine_chunks(), "bits": pa.array(bits, pa.binary())})


def _reply_map(answers: list[dict] | None) -> dict[int, bytes]:
    return {a["shard"]: a["bits"] for a in answers or []}


def mark_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, n_removed (long) and kept_text: its kept words joined by one space.

    A word goes if a window of 13 words covers it whose words also start somewhere in a row
    with a smaller doc_id. Windows are judged on the input. Null texts have no words and an
    empty kept_text. Rows that share a doc_id do not remove each other's words; rows
    without a doc_id keep all words and remove none. Columns of ``docs`` named like
    the three new ones are replaced. An empty table gives no rows.
    """
    spark = docs.sparkSession
    packed = _packed(docs, key, text)
    total = packed.agg(F.sum("windows")).first()[0] or 0
    shards = max(1, -(-total // SHARD_WINDOWS))
    sent_schema = "chunk bigint, shard int, n int, blob binary"

    def chunks(batch: pa.RecordBatch, *more: str):
        for i in range(batch.num_rows):
            rows = unpack_chunk(batch.column("blob")[i].as_py())
            yield batch.column("chunk")[i].as_py(), rows, Chunk(rows.column("s_text"), rows.column("s_key"), window), *(_reply_map(batch.column(m)[i].as_py()) for m in more)

    def message(place: int, rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        shard, n, blob = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array([place] * len(rows)), pa.array(shard, pa.int32()), pa.array(n, pa.int32()), pa.array(blob, pa.binary())], names=["chunk", "shard", "n", "blob"])

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, _, chunk in chunks(batch):
                rows = [(s, n, pack_planes(gaps(first), gaps(np.sort(second)))) for s, n, first, second, _ in sparse_sketches(chunk, shards)]
                if rows:
                    yield message(place, rows)

    estimates = saved(_answers(packed.select("chunk", "blob").mapInArrow(sketched, sent_schema), merged_sketches), "substring-estimates")
    estimates = estimates.withColumnRenamed("answers", "estimates")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, table, chunk, answers in chunks(batch, "estimates"):
                repeated = np.flatnonzero(estimated_repeated(chunk, shards, answers))
                checks = window_checks(table.column("s_text"), chunk, repeated, window)
                shard = _place(chunk.key[repeated], shards)[0]
                edges = np.searchsorted(shard, np.arange(shards + 1))
                rows = []
                for s in np.flatnonzero(np.diff(edges)):
                    part = slice(edges[s], edges[s + 1])
                    own = repeated[part]
                    rows.append((int(s), len(own), pack_planes(gaps(chunk.key[own]), checks[part], chunk.least[own])))
                if rows:
                    yield message(place, rows)

    estimated = packed.select("chunk", "blob").join(estimates, "chunk", "left")
    smaller = saved(_answers(estimated.mapInArrow(exact, sent_schema), grouped_windows), "substring-repeats")
    smaller = smaller.withColumnRenamed("answers", "smaller")

    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    new = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    schema = T.StructType([*docs.select(*names).schema.fields, *new])

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, table, chunk, answers, smaller in chunks(batch, "estimates", "smaller"):
                gone = removed_words(chunk, estimated_repeated(chunk, shards, answers), shards, smaller, window)
                ends = np.cumsum(chunk.counts)
                texts, lost = [], []
                for value, n, end in zip(table.column("s_text").to_pylist(), chunk.counts, ends):
                    own = gone[end - n : end]
                    words = value.encode().split() if value else []
                    lost.append(int(own.sum()))
                    texts.append(b" ".join(compress(words, ~own) if lost[-1] else words).decode())
                struct = table.column("s_row")
                columns = [struct.field(c) for c in names]
                columns += [pa.array(chunk.counts, pa.int64()), pa.array(lost, pa.int64()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_words", "n_removed", "kept_text"])

    return estimated.join(smaller, "chunk", "left").select("blob", "chunk", "estimates", "smaller").mapInArrow(finished, schema)


def removed_words(chunk: Chunk, repeated: np.ndarray, shards: int, smaller: dict[int, bytes], window: int) -> np.ndarray:
    """Per word of the chunk, whether it goes."""
    own = np.flatnonzero(repeated)
    shard = _place(chunk.key[own], shards)[0]
    edges = np.searchsorted(shard, np.arange(shards + 1))
    elsewhere = np.zeros(len(chunk.key), bool)
    for s in np.flatnonzero(np.diff(edges)):
        elsewhere[own[edges[s] : edges[s + 1]]] = unpack_bits(smaller[int(s)], edges[s + 1] - edges[s])
    sizes = np.diff(chunk.first, append=len(chunk.order))
    # a window goes if a smaller doc_id has it in another chunk or in this one
    goes = np.repeat(elsewhere, sizes) | (chunk.doc[chunk.order] > np.repeat(chunk.least, sizes))
    marks = np.zeros(chunk.words + 1, np.int32)
    starts = chunk.start[chunk.order[goes]]
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + window, -1)
    return np.cumsum(marks[:-1]) > 0


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without repeated passages: changed texts are their kept words, texts without repeats stay as they are.

    Rows of which no word is left go; wordless and null texts stay. A column n_chars follows the text. Rows that share a
    key do not remove each other's words, rows without one stay whole. Columns may have any name; no rows give no rows.
    """
    rows = docs.select(F.struct(*[c for c in docs.columns if c != text]).alias("row"), F.col(key).alias("row_key"), F.col(text).alias("row_text"))
    marked = mark_repeats(rows, "row_key", "row_text").filter("n_removed = 0 or n_removed < n_words")
    new = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("row_text"))
    marked = marked.select("row", new.alias("new_text"))

    def column(name: str):
        if name == text:
            return F.col("new_text").alias(name)
        if name == "n_chars":
            return F.length("new_text").cast(docs.schema[name].dataType).alias(name)
        return F.col("row").getField(name).alias(name)

    return marked.select(*map(column, docs.columns))
