"""Byte-level BPE by a rank file: long texts are encoded in parallel pieces, cut where overlapping chunks agree."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perron.llm.hashing import pieces
from perron.llm.tables import saved, task_count

# Code points per chunk, and of its overlap with the next one.
CHUNK, OVERLAP = 32_768, 1_024


@lru_cache(maxsize=2)
def encoder(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


@lru_cache(maxsize=2)
def token_bytes(ranks: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All tokens' bytes in order of rank, and where each token begins (one more at the end)."""
    table = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, ranks.splitlines())}
    tokens = [table.get(i, b"") for i in range(max(table, default=-1) + 1)]
    begins = np.zeros(len(tokens) + 1, np.int64)
    np.cumsum([len(t) for t in tokens], out=begins[1:])
    return np.frombuffer(b"".join(tokens), np.uint8), begins


def boundaries(text: str, pattern: regex.Pattern, start: int, stop: int) -> list[int]:
    """Pre-token starts in [start, stop) of ``text`` at which it may be cut.

    The characters on both sides are ASCII and the left one is no white space:
    then the piece before the cut ends in the same pre-token on its own.
    """
    found = (m.start() for m in pattern.finditer(text))
    return [p for p in found if start <= p < stop and p and text[p] < "\x80" and text[p - 1] < "\x80" and not text[p - 1].isspace()]


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",), chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per row of ``docs``: ``carry`` columns, ids (little-endian unsigned 32-bit, binary), n_tokens.

    Texts of up to ``chunk`` code points are encoded where they are read. Longer
    ones are cut into chunks that overlap; each chunk is pre-tokenised on its own,
    and the first boundary that both neighbours see in their overlap is a true one
    for both (a match depends only on the text after its start). Pieces between
    such boundaries are encoded in parallel and joined by row and place. A text
    with an overlap without a common boundary (a run of one kind of characters) is
    encoded whole. Null texts are empty and have no ids. Rows are told apart by
    their place in the input, so repeated or null keys do no harm.
    """
    spark = docs.sparkSession
    with open(ranks, "rb") as file:  # bounded by the vocabulary
        shared = spark.sparkContext.broadcast(file.read())
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*carry).schema)
    rows = docs.select(*carry, F.coalesce(text, F.lit("")).alias("b_text"))
    out = f"{kinds}, ids binary, n_tokens bigint"
    is_long = F.length("b_text") > chunk

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value, pattern)
        for batch in pieces(batches, "b_text"):
            ids = [enc.encode_to_numpy(t, allowed_special=set(), disallowed_special=()).astype("<u4") for t in batch.column("b_text").to_pylist()]
            columns = [batch.column(c) for c in batch.schema.names if c != "b_text"]
            columns += [pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[c for c in batch.schema.names if c != "b_text"] + ["ids", "n_tokens"])

    short = rows.filter(~is_long).mapInArrow(whole, out)
    longs = rows.filter(is_long).withColumn("b_row", F.monotonically_increasing_id())
    longs = saved(longs, "bpe-long-texts")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, t in zip(batch.column("b_row").to_pylist(), batch.column("b_text").to_pylist()):
                count = -(-len(t) // chunk)
                for at in range(0, count, 64):
                    part = range(at, min(at + 64, count))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * len(part)), pa.array(list(part)), pa.array([count] * len(part)), pa.array([t[k * chunk : (k + 1) * chunk + overlap] for k in part], pa.string())],
                        names=["b_row", "b_part", "b_parts", "b_text"],
                    )

    def pretokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in batches:
            heads, tails = [], []
            for part, t in zip(batch.column("b_part").to_pylist(), batch.column("b_text").to_pylist()):
                cuts = boundaries(t, compiled, 0, len(t))
                heads.append([p + part * chunk for p in cuts if p < overlap])
                tails.append([p + part * chunk for p in cuts if p >= chunk])
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (heads, tails)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, "head", "tail"])

    parts = longs.select("b_row", "b_text").mapInArrow(chunks, "b_row bigint, b_part bigint, b_parts bigint, b_text string")
    parts = parts.repartition(task_count(spark), "b_row", "b_part")
    parts = saved(parts.mapInArrow(pretokenised, "b_row bigint, b_part bigint, b_parts bigint, b_text string, head array<bigint>, tail array<bigint>"), "bpe-chunks")
    ends = parts.select("b_row", (F.col("b_part") + 1).alias("b_part"), "tail")
    cuts = parts.select("b_row", "b_part", "head").join(ends, ["b_row", "b_part"])
    cuts = saved(cuts.select("b_row", "b_part", F.array_min(F.array_intersect("tail", "head")).alias("cut")), "bpe-cuts")
    lost = cuts.filter("cut is null").select("b_row").distinct()
    stop = cuts.select("b_row", (F.col("b_part") - 1).alias("b_part"), F.col("cut").alias("stop"))
    start = cuts.select("b_row", "b_part", F.col("cut").alias("start"))
    between = parts.drop("head", "tail").join(lost, "b_row", "left_anti")
    between = between.join(start, ["b_row", "b_part"], "left").join(stop, ["b_row", "b_part"], "left")
    from_here = F.coalesce(F.col("start") - F.col("b_part") * chunk, F.lit(0))
    upto = F.coalesce(F.col("stop") - F.col("b_part") * chunk, F.length("b_text"))
    between = between.select("b_row", "b_part", F.substring(F.col("b_text"), (from_here + 1).cast("int"), (upto - from_here).cast("int")).alias("b_text"))
    encoded = between.mapInArrow(whole, "b_row bigint, b_part bigint, ids binary, n_tokens bigint")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, ids = None, []
        for batch in batches:
            for key, part in zip(batch.column("b_row").to_pylist(), batch.column("ids").to_pylist()):
                if key != row and ids:
                    yield _row_of(row, ids)
                    ids = []
                row = key
                ids.append(part)
        if ids:
            yield _row_of(row, ids)

    encoded = encoded.repartition(task_count(spark), "b_row").sortWithinPartitions("b_row", "b_part").mapInArrow(joined, "b_row bigint, ids binary, n_tokens bigint")
    long = longs.drop("b_text").join(encoded, "b_row").select(*carry, "ids", "n_tokens")
    unsplit = longs.join(lost, "b_row", "left_semi").drop("b_row").mapInArrow(whole, out)
    return short.unionByName(long).unionByName(unsplit)


def _row_of(row: int, ids: list[bytes]) -> pa.RecordBatch:
    whole = b"".join(ids)
    return pa.RecordBatch.from_arrays([pa.array([row]), pa.array([whole], pa.binary()), pa.array([len(whole) // 4])], names=["b_row", "ids", "n_tokens"])


def decode_ids(ids: np.ndarray, table: np.ndarray, begins: np.ndarray) -> bytes:
    """The ids' bytes one after the other; they need not be whole characters."""
    lengths = begins[ids + 1] - begins[ids]
    ends = np.cumsum(lengths)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begins[ids] - ends + lengths, lengths)
    return table[at].tobytes()


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """``encoded`` with ``decoded`` (binary): the raw bytes of its ``ids``; null ids give null."""
    with open(ranks, "rb") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, begins = token_bytes(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [None if b is None else decode_ids(np.frombuffer(b, "<u4").astype(np.int64), table, begins) for b in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(decoded, schema)
