"""Spelling variants: PartEnum signatures over letter multisets find words one edit apart.

A word's letter multiset is a binary vector with one dimension per (letter, how many-th
of its kind). One replaced letter changes two dimensions, one inserted or deleted letter
one. The dimensions are dealt over ``parts`` partitions of about equal information. Vectors
that differ in d dimensions agree on all but d partitions, so a signature for each choice
of d partitions left out, over all the others, misses no pair: an equi-join on signatures
and lengths finds every candidate. Half-word hashes discard most candidates in the join,
the edit distance decides about the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.llm.hashing import U64, mix, powers
from perron.llm.tables import saved
from perron.operators.joins import left_lookup

LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
PARTS = 6
# Letters are told apart by their low eight bits: U+0000 to U+00FF; from the eighth of its kind on, dimensions share a partition.
ALPHABET, KINDS = 256, 8
BASE = 0x9E3779B97F4A7C15 | 5


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = 31, least: int = LEAST_LETTERS, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of all whole texts that occur at least ``count`` times.

    A word is a maximal run of letters with A-Z lower-cased. If ``every`` divides the CRC-32 h of
    ``<key>:<run>``, the run loses its letter at h modulo its length. Results of fewer than
    ``least`` letters are left out. Null texts have no words; a null key counts as an empty string; rows
    that share a key count each.
    """
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.explode(F.regexp_extract_all(text, F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))).alias("run"))
    runs = runs.select("key", F.translate("run", UPPER, LOWER).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("key", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= least)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= count)


class Vectors:
    """The letter multisets of a batch of words as (word, letter, how many-th) triples."""

    def __init__(self, words: pa.Array):
        points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
        self.points = points
        self.length = np.array([len(w) for w in words.to_pylist()], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.length)])
        word = np.repeat(np.arange(len(words)), self.length)
        order = np.lexsort((points, word))
        self.word, self.letter = word, points[order].astype(np.int64) % ALPHABET
        place = np.arange(len(points))
        fresh = np.ones(len(points), bool)
        fresh[1:] = (word[1:] != word[:-1]) | (self.letter[1:] != self.letter[:-1])
        self.nth = place - np.maximum.accumulate(np.where(fresh, place, 0))
        self.dimension = self.letter * KINDS + np.minimum(self.nth, KINDS - 1)

    def masks(self, partition: np.ndarray, parts: int) -> np.ndarray:
        """Per word and partition the XOR of the hashes of its dimensions there."""
        out = np.zeros((parts, len(self.length)), U64)
        hashes = mix((self.letter * 65_536 + self.nth + 1).astype(U64))
        own = partition[self.dimension]
        for p in range(parts):
            at = np.flatnonzero(own == p)
            np.bitwise_xor.at(out[p], self.word[at], hashes[at])
        return out

    def halves(self, length: np.ndarray) -> np.ndarray:
        """Two 32-bit hashes: of the first ``length // 2`` letters and of the last ``length - length // 2``."""
        coded = mix(self.points.astype(U64) + U64(1)) * powers(len(self.points), BASE)
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(coded, dtype=U64)])
        back = powers(len(sums), pow(BASE, -1, 1 << 64))
        start, end = self.first[:-1], self.first[1:]
        head = mix((sums[start + length // 2] - sums[start]) * back[start])
        tail_start = end - (length - length // 2)
        tail = mix((sums[end] - sums[tail_start]) * back[tail_start])
        return (head & ~U64(0xFFFFFFFF)) | (tail >> U64(32))


def balanced_partitions(words: DataFrame, parts: int = PARTS) -> np.ndarray:
    """A partition per dimension, so that all have about the same information (entropy over the words).

    Counts cover all words; at most 256 letters x 8 sums reach the driver.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(ALPHABET * KINDS, np.int64), 0
        for batch in batches:
            total += np.bincount(Vectors(batch.column("word")).dimension, minlength=len(total))
            rows += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(total)), -1)), pa.array(np.append(total, rows))], names=["dimension", "n"])

    sums = words.select("word").mapInArrow(counted, "dimension bigint, n bigint").groupBy("dimension").agg(F.sum("n").alias("n")).collect()
    counts = {r["dimension"]: r["n"] for r in sums}
    share = np.array([counts.get(d, 0) for d in range(ALPHABET * KINDS)]) / max(1, counts.get(-1, 0))
    share = np.clip(share, 1e-12, 1 - 1e-12)
    bits = -share * np.log2(share) - (1 - share) * np.log2(1 - share)
    out, filled = np.zeros(len(share), np.int64), np.zeros(parts)
    for d in np.argsort(-bits, kind="stable"):
        out[d] = filled.argmin()
        filled[out[d]] += bits[d]
    return out


def signatures(words: DataFrame, partition: np.ndarray, parts: int, left_out: int, shorter: bool) -> DataFrame:
    """(word, halves, signature): one row per word and choice of ``left_out`` partitions that do not count.

    Signatures hold the choice and the length of the pair's shorter word: the
    word's own, or (``shorter`` false) one letter less.
    """
    choices = list(combinations(range(parts), left_out))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = Vectors(batch.column("word"))
            masks = vectors.masks(partition, parts)
            whole = np.bitwise_xor.reduce(masks, axis=0)
            length = vectors.length if shorter else vectors.length - 1
            out = np.empty((batch.num_rows, len(choices)), U64)
            for k, choice in enumerate(choices):
                kept = whole ^ np.bitwise_xor.reduce(masks[list(choice)], axis=0)
                out[:, k] = mix(kept + mix(length.astype(U64) * U64(4096) + U64(k)))
            edges = pa.array(np.arange(batch.num_rows + 1) * len(choices), pa.int32())
            lists = pa.ListArray.from_arrays(edges, pa.array(out.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(vectors.halves(length).view(np.int64)), lists], names=["word", "halves", "signatures"])

    return words.select("word").mapInArrow(signed, "word string, halves bigint, signatures array<bigint>").select("word", "halves", F.explode("signatures").alias("signature"))


def _agree(a: str, b: str) -> Column:
    """Whether the first or the second halves are alike: an edit leaves one of them as it is."""
    differ = F.col(f"{a}.halves").bitwiseXOR(F.col(f"{b}.halves"))
    return (F.shiftrightunsigned(differ, 32) == 0) | (differ.bitwiseAND(0xFFFFFFFF) == 0)


def near_pairs(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct ``word`` rows that are one edit (code point inserted, deleted, replaced) apart.

    Hot signatures are split on both sides by adaptive execution; no group is gathered.
    """
    partition = balanced_partitions(words, parts)
    same = signatures(words, partition, parts, 2, True)
    longer, shorter = signatures(words, partition, parts, 1, False), signatures(words, partition, parts, 1, True)
    near = F.levenshtein("x.word", "y.word", 1) == 1
    on = F.col("x.signature") == F.col("y.signature")
    replaced = same.alias("x").join(same.alias("y"), on & (F.col("x.word") < F.col("y.word")) & _agree("x", "y") & near)
    edited = longer.alias("x").join(shorter.alias("y"), on & _agree("x", "y") & near)
    pair = F.least("x.word", "y.word").alias("a"), F.greatest("x.word", "y.word").alias("b")
    return replaced.select(*pair).union(edited.select(*pair)).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): follows (word, form) rows to the last word, doubling the steps each round; forms have no cycle."""
    hops = saved(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = hops.select(F.col("word").alias("root"), F.col("root").alias("top"))
        moved = left_lookup(hops, further, ["root"])
        hops = saved(moved.select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")), "spelling-roots")
        if not hops.filter("moved").head(1):
            return hops.select("word", "root")
        hops = hops.select("word", "root")


def variant_groups(words: DataFrame, ratio: int = RATIO, parts: int = PARTS) -> DataFrame:
    """One row per word of ``words`` (word, n; distinct words): word, form, root, n, n_near, form_n.

    form is the near word (one edit apart) with the largest n (ties: first in code-point order)
    if that n is at least ``ratio`` times the word's, else null; root is where forms end, the word itself without a form.
    An empty table gives no rows.
    """
    words = saved(words.select("word", "n"), "spelling-words")
    pairs = saved(near_pairs(words, parts), "spelling-pairs")
    both = pairs.union(pairs.select("b", "a")).toDF("word", "near")
    both = left_lookup(both, words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), ["near"])
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    best = best.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))
    out = words.join(best, "word", "left")
    formed = F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))
    out = out.select("word", F.when(formed, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("form_n")).alias("form_n"))
    out = saved(out, "spelling-forms")
    out = out.join(roots(out.filter("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
