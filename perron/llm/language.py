"""Language identification by prediction by partial matching over bytes.

Per language a tree of byte contexts of order 0 to 2 with escape probabilities
(method C, with exclusion of symbols already ruled out by longer contexts). The
trees are frozen after training, so the exact code length of every byte after
every context is a table look-up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.llm.hashing import pieces, text_bytes

# Before the first byte of a text stand two of these; texts have no byte 0 of their own in UTF-8 prose,
# and if one has, it merely shares the context.
PAD = 0
ORDER = 2


def _codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte, 24 bits: the two bytes before it in its text (or PAD) and itself."""
    before = np.zeros(len(data), np.int32)
    before[1:] = data[:-1]
    earlier = np.zeros(len(data), np.int32)
    earlier[2:] = data[:-2]
    starts = offsets[:-1][np.diff(offsets) > 0]
    before[starts] = PAD
    earlier[starts] = PAD
    seconds = offsets[:-1][np.diff(offsets) > 1] + 1
    earlier[seconds] = PAD
    return (earlier << 16) | (before << 8) | data


def counts(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, code, n): how often each byte follows each two bytes in the texts of each language.

    At most 2**24 codes per language, far fewer in practice; counted in the tasks
    first, so that a language with most of the rows adds no more rows to the shuffle.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in pieces(batches, "text"):
            langs = np.array(batch.column("lang").to_pylist(), object)
            data, offsets = text_bytes(batch.column("text"))
            codes = _codes(data, offsets)
            owner = np.repeat(np.arange(len(langs)), np.diff(offsets))
            for name in set(langs):
                values, n = np.unique(codes[(langs == name)[owner]], return_counts=True)
                old = sums.get(name)
                if old is not None:
                    both = np.concatenate([old[0], values])
                    values, place = np.unique(both, return_inverse=True)
                    n = np.bincount(place, np.concatenate([old[1], n]), len(values)).astype(np.int64)
                sums[name] = (values, n)
        for name, (values, n) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(values), pa.string()), pa.array(values.astype(np.int32)), pa.array(n.astype(np.int64))], names=["lang", "code", "n"])

    taken = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")
    found = taken.mapInArrow(counted, "lang string, code int, n bigint")
    return found.groupBy("lang", "code").agg(F.sum("n").alias("n"))


class Model:
    """Frozen trees: ``bits`` holds, per language, the code length of symbol c after (a, b) at [a, b, c].

    Bytes that no training text has share one symbol at the end of the alphabet.
    """

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({r[0] for r in rows})
        seen = np.unique([[c >> 16, c >> 8 & 255, c & 255] for _, c, _ in rows]) if rows else np.zeros(0, int)
        self.symbol = np.full(256, len(seen), np.int32)
        self.symbol[seen.astype(int)] = np.arange(len(seen))
        size = len(seen) + 1
        self.bits = np.zeros((len(self.langs), size, size, size), np.float32)
        for i, lang in enumerate(self.langs):
            tree = np.zeros((size, size, size), np.float64)
            own = np.array([(c, n) for name, c, n in rows if name == lang])
            s = self.symbol
            tree[s[own[:, 0] >> 16], s[own[:, 0] >> 8 & 255], s[own[:, 0] & 255]] = own[:, 1]
            self.bits[i] = code_lengths(tree)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of each text (row) under each language (column)."""
        codes = _codes(data, offsets)
        size = self.bits.shape[1]
        s = self.symbol
        at = (s[codes >> 16] * size + s[codes >> 8 & 255]) * size + s[codes & 255]
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        full = np.flatnonzero(np.diff(offsets) > 0)
        if len(full):
            for i in range(len(self.langs)):
                out[full, i] = np.add.reduceat(self.bits[i].ravel()[at].astype(np.float64), offsets[:-1][full])
        return out


def code_lengths(tree: np.ndarray) -> np.ndarray:
    """Exact PPM code lengths of all symbols after all contexts of two symbols.

    A context with n occurrences of d symbols gives a seen symbol count / (n + d),
    and d / (n + d) to escaping to the context one symbol shorter, where symbols
    already ruled out are excluded. Below order 0 all symbols are alike.
    """
    size = tree.shape[0]
    shorter = tree.sum(axis=0)
    shortest = shorter.sum(axis=0)
    out = np.empty_like(tree)
    for a in range(size):
        bits = np.full((size, size), np.nan)
        lost = np.zeros((size, 1))  # bits spent on escapes
        ruled_out = np.zeros((size, size), bool)
        for level in (tree[a], shorter, np.broadcast_to(shortest, (size, size))):
            n = np.where(ruled_out, 0, level)
            seen = n > 0
            total, distinct = n.sum(axis=1, keepdims=True), seen.sum(axis=1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                bits = np.where(seen, lost + np.log2((total + distinct) / n), bits)
                escape = np.log2((total + distinct) / distinct)
            lost = lost + np.where(distinct > 0, escape, 0)
            ruled_out |= seen
        rest = size - ruled_out.sum(axis=1, keepdims=True)
        out[a] = np.where(ruled_out, bits, lost + np.log2(np.maximum(rest, 1)))
    return out


def identify(docs: DataFrame, training: Column, lang: str = "lang", text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: ``carry`` columns, lang_pred, score.

    Learns from the rows where ``training`` is true and lang and text are not null;
    lang is no input of a prediction. The prediction is the language with the
    shortest code, the first by name among equals; ``score`` is its posterior
    probability with equal priors. Texts that are null or have no letter are
    ``und`` with score 0, as are all texts if nothing could be learned. Every row
    is judged on its own whole text, so repeated rows and keys do no harm.

    The counts reach the driver as the model: (languages x distinct three-byte
    sequences) rows, bounded by the byte alphabet and not by the corpus.
    """
    spark = docs.sparkSession
    rows = [tuple(r) for r in counts(docs.filter(training), lang, text).collect()]
    model = spark.sparkContext.broadcast(Model(rows))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*carry).schema)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = model.value.langs
        for batch in pieces(batches, "l_text"):
            texts = batch.column("l_text")
            bits = model.value.score(*text_bytes(texts))
            has_letter = np.array([t is not None and any(map(str.isalpha, t)) for t in texts.to_pylist()], bool)
            known = has_letter & bool(langs)
            names = np.full(len(known), "und", object)
            score = np.zeros(len(known))
            if langs:
                best = bits.argmin(axis=1)
                gap = bits - bits.min(axis=1, keepdims=True)
                names[known] = np.array(langs, object)[best[known]]
                score[known] = (1 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1))[known]
            columns = [batch.column(c) for c in carry]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(score)], names=[*carry, "lang_pred", "score"])

    taken = docs.select(*carry, F.col(text).alias("l_text"))
    return taken.mapInArrow(predicted, f"{kinds}, lang_pred string, score double")
