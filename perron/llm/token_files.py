"""Token-id files: ids in blocks that an adaptive context-mixing range coder packs.

In a block an order-2 and an order-1 context each predict one id, with a
probability learned per confidence; an order-0 distribution over all ids covers
the rest. The predictions are mixed with weights that follow their success, and
the mixture drives a range coder. Every block starts from nothing and has a
checksum, so blocks are independent. A block is cut into streams of one length
that share its model: a step codes one id of every stream in numpy, and the model
learns from the ids of all streams after every few steps.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perron.llm.files import new_file, open_input, open_output, shared_dir
from perron.llm.hashing import pieces
from perron.llm.tables import saved, task_count

MAGIC = b"PTIDS\x00\x02\n"
BLOCK = 1 << 20
STREAMS = 4096  # of a block, at most
FILE_IDS = 4 * BLOCK
PIECE = 1 << 21  # bytes of texts tokenised together

_SHORTEST = 128  # ids of a stream, if the block has more
_STEPS = 8  # between two updates of the model, at most
_TOP, _BOTTOM = 48, 32  # bits of a range, at most and at least
_SCALE = 16
_SHARES = 1 << _SCALE
_FADE = 1 << 16  # outcomes after which older ones count half


def _layout(size: int) -> tuple[int, int]:
    """Streams of a block of ``size`` ids and ids per stream; the last streams may be filled up."""
    streams = max(1, min(STREAMS, size // _SHORTEST))
    steps = max(1, -(-size // streams))
    return max(1, -(-size // steps)), steps


def _sure_steps() -> tuple[np.ndarray, np.ndarray]:
    """By outcome of a cell, what is added to the confidence of order 2 and of order 1.

    A miss halves the confidence, and without any the new id takes the place (_NEW).
    """
    after = {False: lambda sure: (sure >> 1) - sure if sure > 1 else _NEW, True: lambda sure: min(7, sure + 1) - sure if sure else _NEW}
    steps = np.zeros((2, 2, 8, 8, 4), np.int32)
    for same, sure2, sure1, by in np.ndindex(steps.shape[1:]):
        steps[0, same, sure2, sure1, by] = after[by == 0](sure2)
        steps[1, same, sure2, sure1, by] = after[by == 1 or (by == 0 and same == 1)](sure1)
    return steps[0].ravel(), steps[1].ravel()


_NEW = 99
_STEP2, _STEP1 = _sure_steps()


def _chunks(steps: int) -> Iterator[tuple[int, int]]:
    """Steps from and to which the model stays as it is: single ones at first."""
    at = 0
    while at < steps:
        to = min(steps, at + max(1, min(_STEPS, at // 8)))
        yield at, to
        at = to


class Mixer:
    """The model of a block: contexts of order 2 and 1 with one predicted id each, and order 0.

    Tables hold a predicted id + 1 above three bits of confidence, 0 where nothing is known.
    A cell is the pair of confidences, and whether both contexts predict the same id.
    """

    def __init__(self, size: int, ids: int):
        self.ids = ids
        self.bits = max(_SCALE, ids.bit_length() + 4)  # of the order 0 scale
        slots = min(19, max(10, size.bit_length() - 1))
        self.shift = 32 - slots
        self.table1 = np.zeros(ids, np.int32 if ids < 1 << 27 else np.int64)
        self.table2 = np.zeros(1 << slots, self.table1.dtype)
        self.outcomes = np.zeros(512, np.int64)  # of each cell: order 2, order 1 or the rest was right
        self.prior1, self.prior2 = np.linspace(0.5, 7.5, 8), np.linspace(1, 9, 8)  # hits in 10
        self.counts = np.zeros(ids, np.int64)
        self.rebuild([])
        self._mix()

    def look(self, before: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The slot of order 2, the entries of order 2 and 1, and four times the cell."""
        slot = ((last * 0x9E3779B1 + before * 0x85EBCA77) & 0xFFFFFFFF) >> self.shift
        old2, old1 = self.table2.take(slot), self.table1.take(last)
        cell = ((old2 & 7) << 5) | ((old1 & 7) << 2)
        cell += ((old2 ^ old1) < 8) * np.int32(256)  # the same id
        return slot, old2, old1, cell

    def learn(self, last: np.ndarray, slot: np.ndarray, old2: np.ndarray, old1: np.ndarray, x: np.ndarray, found: np.ndarray) -> None:
        """Updates from ids ``x``; ``found`` is four times the cell, plus 0 (order 2), 1 (order 1) or 2 (the rest)."""
        new = (x.astype(old2.dtype) << 3) + 9
        for table, slots, old, step in ((self.table2, slot, old2, _STEP2), (self.table1, last, old1, _STEP1)):
            by = step.take(found)
            table[slots] = np.where(by == _NEW, new, old + by)
        self.outcomes += np.bincount(found.ravel(), minlength=512)
        self._mix()
        if self.outcomes.sum() > _FADE:
            self.outcomes >>= 1

    def _mix(self) -> None:
        """Ends of the shares of order 2 and 1 of 2**16, per cell; the rest is order 0's."""
        n = self.outcomes.reshape(2, 8, 8, 4)
        by_sure2, by_sure1 = n.sum(axis=(0, 2)), n.sum(axis=1)
        rate2 = (by_sure2[:, 0] + self.prior2) / (by_sure2.sum(axis=1) + 10)
        rate1 = (by_sure1[0, :, 1] + by_sure1[1, :, 0] + self.prior1) / (by_sure1.sum(axis=(0, 2)) + 10)
        rate2, rate1 = np.clip(rate2, 0.002, 0.998)[:, None], np.clip(rate1, 0.002, 0.998)[None, :]
        weight = np.clip((n[0, :, :, 0] + 1) / (n[0, :, :, 0] + n[0, :, :, 1] + 2), 0.03, 0.97)
        weight[:, 0], weight[0, :] = 1, 0  # only one context knows something
        share2, share1 = weight * rate2, (1 - weight) * rate1
        share2[0], share1[:, 0] = 0, 0
        ends = np.zeros((2, 8, 8, 4), np.int64)
        ends[0, :, :, 1] = share2 * _SHARES
        ends[0, :, :, 2] = ends[0, :, :, 1] + (share1 * _SHARES).astype(np.int64)
        ends[1, :, :, 1] = ends[1, :, :, 2] = (share2 + share1) * _SHARES
        ends[..., 3] = _SHARES
        self.start = ends.ravel()
        size = np.zeros_like(ends)
        size[..., :3] = np.diff(ends, axis=-1)
        self.size = size.ravel()
        self.end2, self.end1 = self.start[1:], self.start[2:]

    def rebuild(self, rest: list[np.ndarray]) -> None:
        """Order 0 from all ids of the block so far that neither context predicted; ``rest`` has the new ones."""
        if rest:
            self.counts += np.bincount(np.concatenate(rest), minlength=self.ids)
        free = (1 << self.bits) - self.ids
        freq = self.counts * free // max(1, int(self.counts.sum())) + 1
        if not self.counts.any():
            freq += free // self.ids
        freq[freq.argmax()] += (1 << self.bits) - int(freq.sum())
        self.freq = freq
        self.begin = np.cumsum(freq) - freq


def _rebuilt(step: int) -> bool:
    return step > 0 and step & (step - 1) == 0


class Encoder:
    """Range coders of all streams; a word that overflows 16 bits carries into the one before."""

    def __init__(self, streams: int):
        self.low, self.range = np.zeros(streams, np.int64), np.full(streams, 1 << _TOP, np.int64)
        self.used = np.zeros(streams, np.int32)
        # words as they leave: stream, place in it, and the word
        self.lanes: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.words: list[np.ndarray] = []

    def put(self, start: np.ndarray, size: np.ndarray, bits: int, lanes: np.ndarray | None = None) -> None:
        if lanes is None:
            unit = self.range >> bits
            self.low += start * unit
            self.range = size * unit
            self._settle(np.flatnonzero(self.range < 1 << _BOTTOM))
        else:
            unit = self.range[lanes] >> bits
            self.low[lanes] += start * unit
            rng = size * unit
            self.range[lanes] = rng
            self._settle(lanes[rng < 1 << _BOTTOM])

    def _settle(self, go: np.ndarray) -> None:
        while len(go):
            low = self.low[go]
            used = self.used[go]
            self.lanes.append(go)
            self.places.append(used)
            self.words.append(low >> _BOTTOM)
            self.used[go] = used + 1
            self.low[go] = (low & ((1 << _BOTTOM) - 1)) << 16
            rng = self.range[go] << 16
            self.range[go] = rng
            go = go[rng < 1 << _BOTTOM]

    def finish(self) -> bytes:
        """Three words of each stream, then one for each time a stream needs its next."""
        streams = len(self.low)
        first = np.cumsum(self.used + 3) - (self.used + 3)
        heads = first[:, None] + np.arange(3)
        place = np.concatenate([np.zeros(0, np.int64), *(first[lanes] + places for lanes, places in zip(self.lanes, self.places))])
        words = np.zeros(len(place) + 3 * streams, np.int64)
        words[place] = np.concatenate([np.zeros(0, np.int64), *self.words])
        words[heads + self.used[:, None]] = np.stack([self.low >> 32, self.low >> 16 & 0xFFFF, self.low & 0xFFFF], axis=1)
        over = np.flatnonzero(words > 0xFFFF)
        while len(over):
            words[over] &= 0xFFFF
            over = over - 1
            words[over] += 1
            over = over[words[over] > 0xFFFF]
        return words[np.concatenate([heads.ravel(), place + 3])].astype("<u2").tobytes()


class Decoder:
    def __init__(self, packed: bytes, streams: int):
        self.words = np.frombuffer(packed[: len(packed) // 2 * 2], "<u2").astype(np.int64)
        self.used = 0
        head = self._next(3 * streams).reshape(streams, 3)
        self.range = np.full(streams, 1 << _TOP, np.int64)
        self.code = (head[:, 0] << 32) | (head[:, 1] << 16) | head[:, 2]

    def _next(self, n: int) -> np.ndarray:
        """The next ``n`` words; zeros after the end, which only a broken block reaches."""
        found = self.words[self.used : self.used + n]
        self.used += n
        return found if len(found) == n else np.pad(found, (0, n - len(found)))

    def target(self, bits: int, lanes: np.ndarray | None = None) -> np.ndarray:
        self.unit = (self.range if lanes is None else self.range[lanes]) >> bits
        # exact: the quotient of whole numbers below 2**48 and 2**32
        return ((self.code if lanes is None else self.code[lanes]) / self.unit).astype(np.int64)

    def take(self, start: np.ndarray, size: np.ndarray, lanes: np.ndarray | None = None) -> None:
        if lanes is None:
            self.code -= start * self.unit
            self.range = size * self.unit
            go = np.flatnonzero(self.range < 1 << _BOTTOM)
        else:
            self.code[lanes] -= start * self.unit
            rng = size * self.unit
            self.range[lanes] = rng
            go = lanes[rng < 1 << _BOTTOM]
        while len(go):
            self.code[go] = ((self.code[go] & ((1 << _BOTTOM) - 1)) << 16) | self._next(len(go))
            rng = self.range[go] << 16
            self.range[go] = rng
            go = go[rng < 1 << _BOTTOM]


def _encode(block: np.ndarray, ids: int) -> bytes:
    streams, steps = _layout(len(block))
    model, out = Mixer(len(block), ids), Encoder(streams)
    filled = np.zeros(streams * steps, np.int64)
    filled[: len(block)] = block
    rows = np.zeros((steps + 2, streams), np.int64)  # two ids of context before the first
    rows[2:] = filled.reshape(streams, steps).T
    escaped = []
    for at, to in _chunks(steps):
        last, x = rows[at + 1 : to + 1], rows[at + 2 : to + 2]
        slot, old2, old1, cell = model.look(rows[at:to], last)
        missed2 = x != (old2 >> 3) - 1
        found = cell + missed2
        missed = missed2 & (x != (old1 >> 3) - 1)
        found += missed
        start, size = model.start.take(found), model.size.take(found)
        for t in range(at, to):
            if _rebuilt(t):
                model.rebuild(escaped)
                escaped = []
            out.put(start[t - at], size[t - at], _SCALE)
            rest = np.flatnonzero(missed[t - at])
            if len(rest):
                own = x[t - at].take(rest)
                out.put(model.begin.take(own), model.freq.take(own), model.bits, rest)
                escaped.append(own)
        model.learn(last, slot, old2, old1, x, found)
    return out.finish()


def _decode(packed: bytes, length: int, ids: int) -> np.ndarray:
    streams, steps = _layout(length)
    model, source = Mixer(length, ids), Decoder(packed, streams)
    rows = np.zeros((steps + 2, streams), np.int64)
    escaped = []
    by_mark = None
    seen = [np.zeros((_STEPS, streams), kind) for kind in (np.int64, model.table2.dtype, model.table1.dtype, np.int32)]
    for at, to in _chunks(steps):
        for t in range(at, to):
            if _rebuilt(t):
                model.rebuild(escaped)
                escaped, by_mark = [], None
            if by_mark is None:
                by_mark = np.repeat(np.arange(ids, dtype=np.int32), model.freq)
            slot, old2, old1, cell = model.look(rows[t], rows[t + 1])
            mark = source.target(_SCALE)
            missed2 = mark >= model.end2.take(cell)
            missed = mark >= model.end1.take(cell)
            found = cell + missed2
            found += missed
            source.take(model.start.take(found), model.size.take(found))
            x = rows[t + 2]
            x[:] = (np.where(missed2, old1, old2) >> 3) - 1
            rest = np.flatnonzero(missed)
            if len(rest):
                own = by_mark.take(np.minimum(source.target(model.bits, rest), len(by_mark) - 1)).astype(np.int64)
                source.take(model.begin.take(own), model.freq.take(own), rest)
                x[rest] = own
                escaped.append(own)
            for part, row in zip(seen, (slot, old2, old1, found)):
                part[t - at] = row
        slot, old2, old1, found = (part[: to - at] for part in seen)
        model.learn(rows[at + 1 : to + 1], slot, old2, old1, rows[at + 2 : to + 2], found)
    return rows[2:].astype(np.uint32).T.ravel()[:length]


def encode_blocks(blocks: np.ndarray, ids: int) -> list[bytes]:
    """Codes the rows of ``blocks`` (values below ``ids``) independently."""
    return [_encode(block, ids) for block in blocks]


def decode_blocks(blocks: list[bytes], steps: int, ids: int) -> np.ndarray:
    """The rows of ``steps`` ids each; a broken block gives some ids, or none of its own."""
    return np.stack([_decode(block, steps, ids) for block in blocks])


# ---- files ------------------------------------------------------------------


def _check(packed: bytes, block: np.ndarray) -> int:
    return zlib.crc32(block.astype("<u4").tobytes(), zlib.crc32(packed))


def write_file(path: str, doc_ids: list[int | None], documents: list[np.ndarray], ids: int) -> None:
    """Header, document index and blocks; every part has its length and a crc32."""
    total = sum(map(len, documents))
    # blocks share their length; the last one is filled up
    count = max(1, -(-total // BLOCK))
    steps = -(-total // count)
    filled = np.zeros(count * steps, np.uint32)
    np.concatenate([filled[:0], *documents], out=filled[:total])
    blocks = filled.reshape(count, steps)
    index = zlib.compress(json.dumps({"doc_ids": doc_ids, "n_tokens": [len(d) for d in documents]}).encode())
    with open_output(path) as out:
        out.write(MAGIC)
        out.write(np.array([ids, count, steps, total, len(index), zlib.crc32(index)], "<u8").tobytes())
        out.write(index)
        for block in blocks if steps else []:
            packed = _encode(block, ids)
            out.write(np.array([len(packed), _check(packed, block)], "<u4").tobytes())
            out.write(packed)


def read_file(path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) in the order of the file; a part that fails its checksum raises ValueError."""
    with open_input(path) as stream:
        if stream.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path}: not a token-id file")
        ids, count, steps, total, size, check = np.frombuffer(stream.read(48), "<u8").astype(int).tolist()
        index = stream.read(size)
        if zlib.crc32(index) != check:
            raise ValueError(f"{path}: broken document index")
        index = json.loads(zlib.decompress(index))
        parts = []
        for block in range(count if steps else 0):
            size, check = np.frombuffer(stream.read(8), "<u4").tolist()
            packed = stream.read(size)
            found = _decode(packed, steps, ids)
            if _check(packed, found) != check:
                raise ValueError(f"{path}: broken block {block}")
            parts.append(found)
    whole = np.concatenate(parts)[:total] if parts else np.zeros(0, np.uint32)
    del parts
    ends = np.cumsum(index["n_tokens"], dtype=np.int64)
    for doc_id, n, end in zip(index["doc_ids"], index["n_tokens"], ends):
        yield doc_id, whole[end - n : end]


# ---- tokenizer --------------------------------------------------------------


class WordIds:
    """Ids of texts by a tokenizer that drops white space, word by word through a bounded memory.

    Strings of special tokens in a text become these tokens, as in the library; they hold no
    white space, so a word holds them whole, also amid other letters. The library gets new words
    many at a time, with a word of one id between them; where that id is also in a word, it gets
    these words one by one.
    """

    MOST = 700_000
    TOGETHER = 300

    def __init__(self, tokenizer: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(tokenizer)
        self.size = self.tokenizer.get_vocab_size()
        self.between = self._between()
        self.place: dict[str, int] = {}
        # ids of all words known, where the words begin in them, and in how many batches they were
        self.flat, self.begins, self.uses = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _between(self) -> tuple[str, int] | None:
        """A word that is one id, and this id: control characters, which are short and rare, or a word of a high id."""
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        high = sorted(vocabulary, key=vocabulary.get, reverse=True)[:1000]
        for word in [*map(chr, range(1, 9)), *(w for token in high for w in re.findall("[A-Za-z]+", token)[:1])]:
            ids = self._encoded([word])[0].tolist()
            if len(ids) == 1:
                return f" {word} ", ids[0]
        return None

    def _keep(self, most: int) -> None:
        """Forgets all words but the most used ones."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[:most])
        words = list(self.place)
        self.place = {words[i]: n for n, i in enumerate(kept.tolist())}
        n = np.diff(self.begins)[kept]
        ends = np.cumsum(n)
        self.flat = self.flat[np.arange(n.sum()) + np.repeat(self.begins[kept] - ends + n, n)]
        self.begins, self.uses = np.concatenate([[0], ends]), self.uses[kept] >> 1

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        parts = (texts[i : i + 30] for i in range(0, len(texts), 30))  # the library's results are large
        return [np.array(e.ids, np.uint32) for part in parts for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        groups = [words[i : i + self.TOGETHER] for i in range(0, len(words), self.TOGETHER)] if self.between else [[w] for w in words]
        text, mark = self.between or ("", -1)
        found, lengths = [], []
        for group, ids in zip(groups, self._encoded([text.join(group) for group in groups])):
            cuts = np.flatnonzero(ids == mark) if len(group) > 1 else np.zeros(0, np.int64)
            if len(cuts) == len(group) - 1:
                found.append(ids[ids != mark] if len(cuts) else ids)
                lengths.append(np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1)
            else:
                each = self._encoded(group)
                found += each
                lengths.append(np.array([len(e) for e in each], np.int64))
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        self.flat = np.concatenate([self.flat, *found])
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(np.concatenate(lengths))])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), np.int32)])

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        if not texts:
            return []
        if len(self.place) > self.MOST:
            self._keep(self.MOST // 4)
        # white space at an end makes an empty word, which has no ids
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()).fill_null(""))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            at[unknown] = np.arange(len(self.place), len(self.place) + len(unknown))
            self._learn([words[i] for i in unknown.tolist()])
        self.uses[at] += 1
        at = at[coded.indices.to_numpy()]
        begins = self.begins[at]
        n = self.begins[at + 1] - begins
        ends = np.cumsum(n)
        where = np.repeat(begins - ends + n, n)
        where += np.arange(len(where))
        ids = self.flat[where]
        cuts = np.concatenate([[0], ends])[split.offsets.to_numpy()].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=1)
def word_ids(tokenizer: bytes) -> WordIds:
    return WordIds(tokenizer)


def write_documents(docs: DataFrame, tokenizer: str, end_id: int, text: str = "text", key: str = "doc_id", file_ids: int = FILE_IDS, encoder: Callable[[bytes], WordIds] = word_ids) -> DataFrame:
    """Writes all texts' ids, each document closed by ``end_id``, and returns the manifest (part, seq, file, n_ids, start).

    Files follow ascending ``key`` (nulls first; equal keys by a hash of the text, then by text), ``start``
    counts the ids in files before. Range bounds are sampled from keys and hashes, not from texts. Null texts are empty and have the end id alone. Extra columns are ignored; an
    empty table writes no file.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark, "token-ids")
    with open(tokenizer, "rb") as file:  # bounded by the vocabulary
        shared = spark.sparkContext.broadcast(file.read())

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(shared.value)
        end = np.array([end_id], np.uint32)
        keys, held, size, seq, part = [], [], 0, 0, None

        def flush() -> pa.RecordBatch:
            path = new_file(folder, ".ids")
            write_file(path, keys, held, max(words.size, end_id + 1))
            return pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "file": [path], "n_ids": [size]})

        for batch in pieces(batches, "text", PIECE):
            part = batch.column("part")[0].as_py()
            found = words.of(batch.column("text").to_pylist())
            # one array for all texts of the batch
            closed = np.concatenate([part for ids in found for part in (ids, end)])
            ends = np.cumsum([len(ids) + 1 for ids in found]).tolist()
            for k, begin, stop in zip(batch.column("key").to_pylist(), [0, *ends], ends):
                keys.append(k)
                held.append(closed[begin:stop])
                size += stop - begin
                if size >= file_ids:
                    yield flush()
                    keys, held, size, seq = [], [], 0, seq + 1
        if held:
            yield flush()

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    rows = rows.repartitionByRange(task_count(spark), F.col("key").asc_nulls_first(), F.col("hash"))
    rows = rows.sortWithinPartitions(F.col("key").asc_nulls_first(), F.col("hash"), F.col("text").asc_nulls_first()).drop("hash")
    rows = rows.withColumn("part", F.spark_partition_id().cast("bigint"))
    manifest = saved(rows.mapInArrow(written, "part bigint, seq bigint, file string, n_ids bigint"), "token-manifest")
    # one row per file of some MB
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return saved(manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "token-manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids): the documents of the manifest's files; ids as little-endian unsigned 32-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_ids.cache_clear()  # of a worker that wrote before
        for batch in batches:
            for path, at in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                documents = read_file(path)
                while rows := list(islice(documents, 1000)):
                    keys, found = zip(*rows)
                    starts = at + np.cumsum([0, *map(len, found)])
                    at = int(starts[-1])
                    blobs = [ids.astype("<u4").tobytes() for ids in found]
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(starts[:-1], pa.int64()), pa.array(blobs, pa.binary())], names=["doc_id", "start", "ids"])

    spark = manifest.sparkSession
    dealt = manifest.select("file", "start").repartition(task_count(spark), "file")
    return dealt.mapInArrow(read, "doc_id bigint, start bigint, ids binary")
