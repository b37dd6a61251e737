"""Benchmark decontamination: MinHash containment search for short items inside long documents.

Containment of an item's shingles does not depend on the length of the document,
so the sketch sits on the item: the ``m`` least values of one hash function over
its ``n`` shingles. An item contained to at least ``t`` misses at most n - need
of its shingles (need = ceil(t * n)), so with m = n - need + 1 a document that
contains it must hold one of its sketch values: no candidate is lost. Items are
partitioned by size; within a partition all sketch values lie below a common
ceiling, and documents send only the shingles below the ceiling of a partition
whose smallest need they can meet at all. Candidates are then verified by exact
containment.

An item of fewer than 5 words has its whole word sequence as its only shingle, which a
document holds wherever these words follow one another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.llm.hashing import U64, Words, mix, pieces, text_bytes, window_hashes
from perron.llm.tables import bounded_broadcast, saved

WORDS = 5
PERCENT = 75


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes (63 bits) of its shingles of ``words`` words, A-Z lower-cased.

    A text with fewer words, but one at least, has its whole sequence as its only shingle.
    """
    found = Words(*text_bytes(texts))
    hashes = found.hashes(fold_case=True)
    windows = window_hashes(hashes, words) >> U64(1)
    for first, count in zip(found.first[:-1], found.count):
        if count >= words:
            yield np.unique(windows[first : first + count - words + 1])
        elif count:
            # tells a short sequence from a window by its length
            yield window_hashes(hashes[first : first + count], int(count), 100 + int(count)) >> U64(1)
        else:
            yield np.zeros(0, U64)


def _rank(shingles: np.ndarray) -> np.ndarray:
    """The hash that orders sketches; 63 bits."""
    return mix(shingles ^ U64(0xA5A5A5A5A5A5A5A5)) >> U64(1)


def short_windows(texts: pa.Array, widths: list[int]) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its windows of ``widths`` words, each as the only shingle of a text that short."""
    found = Words(*text_bytes(texts))
    hashes = found.hashes(fold_case=True)
    windows = {w: window_hashes(hashes, w, 100 + w) >> U64(1) for w in widths}
    for first, count in zip(found.first[:-1], found.count):
        own = [windows[w][first : first + count - w + 1] for w in widths if count >= w]
        yield np.unique(np.concatenate(own)) if own else np.zeros(0, U64)


def _document_sets(texts: pa.Array, widths: list[int]) -> Iterator[np.ndarray]:
    """Per text its shingles, and its shorter windows if there are items that short."""
    if not widths:
        yield from shingle_sets(texts)
        return
    for own, short in zip(shingle_sets(texts), short_windows(texts, widths)):
        yield np.union1d(own, short)


def item_widths(items: DataFrame, text: str, words: int = WORDS) -> list[int]:
    """The numbers of words below ``words`` that items have; at most ``words`` rows reach the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.unique(Words(*text_bytes(batch.column("text"))).count)
            yield pa.RecordBatch.from_arrays([pa.array(counts[(counts > 0) & (counts < words)].astype(np.int64))], names=["w"])

    return sorted(r["w"] for r in items.select(F.col(text).alias("text")).mapInArrow(counted, "w bigint").distinct().collect())


def _exploded(df: DataFrame, key: str, text: str, name: str, widths: list[int] | None = None) -> DataFrame:
    """(key, n, rank) for each distinct shingle; n is the size of the set. ``widths``: see :func:`_document_sets`."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            sets = [np.sort(_rank(s)) for s in _document_sets(batch.column("text"), widths or [])]
            sizes = np.array([len(s) for s in sets], np.int64)
            if not sizes.sum():
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(keys, sizes)), pa.array(np.repeat(sizes, sizes)), pa.array(np.concatenate(sets).astype(np.int64))],
                names=[name, "n", "rank"],
            )

    taken = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).filter("key is not null and text is not null")
    return taken.mapInArrow(rows, f"{name} bigint, n bigint, rank bigint")


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    percent: int = PERCENT,
    doc_key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found) for every item contained in a document to ``percent`` or more.

    n_shingles is the size of the item's set, n_found how many of them the document
    has. Rows without a key or text, and texts without words, match nothing; rows
    that share a key count as one set, the union of theirs, and none is left out for its
    own size. An item of fewer than 5 words is one shingle. Empty tables give no
    rows; other columns are ignored.
    """
    spark = docs.sparkSession
    shingles = _exploded(items, item_key, text, "item").select("item", "rank").distinct()
    sizes = shingles.groupBy("item").agg(F.count("*").alias("n"))
    need = F.ceil(F.col("n") * percent / 100)
    sizes = sizes.withColumns({"need": need, "size_class": F.floor(F.log2("n"))})
    full = saved(shingles.join(sizes, "item"), "benchmark-shingles")
    # per item at most n values: a group of one short text
    sketch = full.groupBy("item", "n", "need", "size_class").agg(F.sort_array(F.collect_list("rank")).alias("ranks"))
    sketch = sketch.withColumn("rank", F.explode(F.slice("ranks", 1, (F.col("n") - F.col("need") + 1).cast("int")))).drop("ranks")
    sketch = saved(sketch, "benchmark-sketches")
    classes = sketch.groupBy("size_class").agg(F.max("rank").alias("ceiling"), F.min("need").alias("least")).collect()  # at most 64 rows
    if not classes:
        return spark.createDataFrame([], f"{doc_key} bigint, {item_key} bigint, n_shingles bigint, n_found bigint")
    widths = item_widths(items.filter(F.col(item_key).isNotNull()), text)
    least = np.array([c["least"] for c in classes])
    ceilings = np.array([c["ceiling"] for c in classes])

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            sent = []
            for s, shared in zip(_document_sets(batch.column("text"), widths), batch.column("shared").to_pylist()):
                reachable = ceilings if shared else ceilings[least <= len(s)]
                ranks = _rank(s)
                sent.append(ranks[ranks <= U64(reachable.max())] if len(reachable) else ranks[:0])
            sizes = [len(s) for s in sent]
            if sum(sizes):
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(keys, sizes)), pa.array(np.concatenate(sent).astype(np.int64))], names=["doc", "rank"])

    keyed = docs.select(F.col(doc_key).cast("bigint").alias("key"), F.col(text).alias("text")).filter("key is not null and text is not null")
    # of a set that is spread over rows, a row's own size says nothing
    several = saved(keyed.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1").select("key", F.lit(True).alias("shared")), "contamination-shared-keys")
    flagged = keyed.join(bounded_broadcast(several), "key", "left") if several.head(1) else keyed.withColumn("shared", F.lit(False))
    sent = flagged.mapInArrow(below, "doc bigint, rank bigint")
    candidates = sent.join(bounded_broadcast(sketch.select("item", "rank")), "rank")
    candidates = saved(candidates.select("doc", "item").distinct(), "contamination-candidates")
    suspects = candidates.select(F.col("doc").alias("key")).distinct()
    texts = keyed.join(bounded_broadcast(suspects), "key", "left_semi")
    held = _exploded(texts, "key", "text", "doc", widths).select("doc", "rank").join(bounded_broadcast(full.select("item", "n", "need", "rank")), "rank")
    # a rank counts once, also where rows share a key
    found = held.groupBy("doc", "item", "n", "need").agg(F.countDistinct("rank").alias("n_found"))
    found = found.filter("n_found >= need").join(candidates, ["doc", "item"], "left_semi")
    return found.select(F.col("doc").alias(doc_key), F.col("item").alias(item_key), F.col("n").alias("n_shingles"), "n_found")


def clean_documents(docs: DataFrame, items: DataFrame, percent: int = PERCENT, doc_key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that contain no item, with the columns of ``docs``, whatever their names.

    Rows without a key stay, as do null and wordless texts; rows that share a key go together. No rows give no rows.
    """
    found = saved(contained_items(docs, items, percent, doc_key).select(F.col(doc_key).alias("bad_key")).distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("clean_row"), F.col(doc_key).alias("clean_key"))
    return rows.join(bounded_broadcast(found), F.col("clean_key") == F.col("bad_key"), "left_anti").select("clean_row.*")
