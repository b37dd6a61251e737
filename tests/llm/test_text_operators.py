"""Operators on texts against brute force, with nulls, empty and odd rows."""

import base64
import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from perron.llm import bpe, decontaminate, hashing, language, minhash, quality, substrings, token_files
from perron.llm.tables import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n int, item string, q_words string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = [f"w{i}" for i in range(400)] + ["Äpfel", "naïve", "日本語", "á", "#$%", "the", "The"]


def words_of(seed, n):
    return [VOCABULARY[i] for i in np.random.default_rng(seed).integers(0, len(VOCABULARY), n)]


def sample():
    """Texts with copies, near copies, shared passages, repeated rows, nulls and odd white space."""
    base = words_of(1, 120)
    texts = [" ".join(base), " ".join(base).upper(), " ".join(base[:60] + ["x"] + base[61:]), "\n".join(base[:119])]
    texts += [" ".join(words_of(s, 90)) for s in range(2, 8)]
    passage = words_of(9, 60)
    texts += [" ".join(words_of(20 + s, 40) + passage + words_of(40 + s, 30)) for s in range(5)]
    texts += [None, "", "  \t\n ", "one two", "one  two", "One two three four", "a b c d e", "x " * 300, "line one\nline one\nline one\n" * 3, "\x1c word"]
    chain = words_of(50, 100)
    for k in range(6):  # neighbours alike, ends not
        texts.append(" ".join(chain[: 100 - 4 * k] + words_of(60 + k, 4 * k)))
    rows = [(i, t, "en", f"s{i % 3}", 0, 1, "i", "q") for i, t in enumerate(texts)]
    rows += [rows[0], (None, texts[0], None, None, None, None, None, None), (100, texts[4], "de", None, 0, 1, None, None)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return sample()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def folded(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text):
    w = folded(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def least_reachable(ids, links):
    root = {i: i for i in ids}
    for _ in ids:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_near_duplicates(docs, rows):
    sets = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = least_reachable(sets, links)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), root[r.doc_id], root[r.doc_id] == r.doc_id)
    kept = minhash.kept_documents(docs)
    assert kept.columns == docs.columns
    # the repeated row of document 0 and the row without an id stay
    assert kept.count() == sum(root[r[0]] == r[0] if r[0] is not None else True for r in rows)


def test_near_duplicates_in_large_groups(spark):
    """Lists whose hub misses members go on to other hubs and to blocks."""
    base = words_of(70, 200)
    texts = []
    for k in range(150):
        rng = np.random.default_rng(1000 + k)
        w = list(base)
        for at in rng.choice(200, 6, replace=False):
            w[at] = f"v{k}x{at}"
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a, b in combinations(range(150), 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = least_reachable(range(150), links)
    assert 1 < len(set(root.values()))
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()} == root


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 99), (99, 101), (7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {i: 0 for i in range(41)} | {99: 99, 100: 99, 101: 99}


def test_quality_measures(docs, rows):
    got = quality.judge(docs, carry=("doc_id", "text")).collect()
    assert len(got) == len(rows)
    for r in got:
        t = r.text or ""
        w = WORD.findall(t)
        seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        expected = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.kept and r.base_failed)


def test_bad_hosts_lose_all_documents(spark):
    good = [(i, " ".join(words_of(i, 60)), f"good{i % 5}") for i in range(100)]
    bad = [(1000 + i, "short" if i else " ".join(words_of(500, 60)), "bad") for i in range(50)]
    single = [(2000, "short", "new"), (2001, " ".join(words_of(501, 60)), None)]
    df = spark.createDataFrame(good + bad + single, "doc_id long, text string, source string")
    kept = {r.doc_id for r in quality.kept_documents(df).collect()}
    assert kept == {g[0] for g in good} | {2001}
    rate = {r.doc_id: r.host_rate for r in quality.judge(df).collect()}
    # one failure says less about a host than fifty
    assert 0.5 < rate[1000] < 1 and rate[1000] != rate[2000] and rate[2001] is None


def test_repeated_windows(docs, rows):
    first = {}
    for key, text, *_ in rows:
        w = WORD.findall(text or "")
        for i in range(len(w) - 12):
            if key is not None:
                first[tuple(w[i : i + 13])] = min(key, first.get(tuple(w[i : i + 13]), key))
    got = substrings.mark_repeats(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        w = WORD.findall(r.text or "")
        gone = {k for i in range(len(w) - 12) if r.doc_id is not None and first[tuple(w[i : i + 13])] < r.doc_id for k in range(i, i + 13)}
        assert (r.n_words, r.n_removed) == (len(w), len(gone))
        assert r.kept_text == " ".join(x for k, x in enumerate(w) if k not in gone)
    out = substrings.without_repeats(docs)
    assert out.columns == docs.columns
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[15] is None and text[17] == "  \t\n " and text[0] == rows[0][1] and 100 not in text


def test_sketches_lose_no_repeat(monkeypatch, docs):
    """Tiny counters collide all the time; results stay."""
    whole = sorted(map(str, substrings.mark_repeats(docs).select("doc_id", "n_removed", "kept_text").collect()))
    monkeypatch.setattr(substrings, "SHARD_WINDOWS", 300)
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 2000)
    assert sorted(map(str, substrings.mark_repeats(docs).select("doc_id", "n_removed", "kept_text").collect())) == whole


def test_contained_items(spark, docs, rows):
    w = words_of(9, 60)
    items = [(0, " ".join(w[:40])), (1, " ".join(w[:14] + words_of(90, 4))), (2, "one two"), (3, None), (4, ""), (5, " ".join(words_of(91, 30))), (None, " ".join(w)), (6, " ".join(w[:12] + words_of(92, 20)))]
    df = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, doc_id string, n int")
    sets = {k: shingles(t) for k, t in items if k is not None}
    expected = set()
    for key, text, *_ in rows:
        own = shingles(text) | {tuple(folded(text)[i : i + n]) for n in range(1, 5) for i in range(len(folded(text)) - n + 1)}
        expected |= {(key, k, len(s), len(s & own)) for k, s in sets.items() if key is not None and s and 100 * len(s & own) >= 75 * len(s)}
    got = [tuple(r) for r in decontaminate.contained_items(docs, df).collect()]
    assert len(got) == len(set(got)) and set(got) == expected and len(expected) > 5
    clean = decontaminate.clean_documents(docs, df)
    assert clean.columns == docs.columns
    bad = {e[0] for e in expected}
    assert clean.count() == sum(r[0] not in bad for r in rows)
    assert decontaminate.contained_items(docs, df.limit(0)).count() == 0


def test_contained_over_rows_and_short_items(spark):
    """Rows of one key share a set; items of few words are found inside long texts."""
    w = words_of(70, 12)
    halves = [" ".join(w[:8]), " ".join(w[4:])]
    long = " ".join(words_of(71, 3000) + ["alpha", "Beta", "gamma"] + words_of(72, 3000))
    df = spark.createDataFrame([(1, halves[0]), (1, halves[1]), (2, halves[0]), (3, long), (4, "beta  gamma"), (5, "gamma beta"), (6, None)], "doc_id long, text string")
    items = spark.createDataFrame([(10, " ".join(w)), (11, "beta gamma"), (12, "ALPHA"), (13, "alpha beta gamma delta")], "item_id long, text string")
    got = {tuple(r) for r in decontaminate.contained_items(df, items).collect()}
    assert got == {(1, 10, 8, 8), (3, 11, 1, 1), (4, 11, 1, 1), (3, 12, 1, 1)}


CLASHES = ["gone_id", "bad_key", "n_words", "n_removed", "kept_text", "n", "doc", "rank", "key", "q_n_words", "q_text", "base_failed", "row", "s_row", "s_text", "minhash_key", "clean_row"]


@pytest.mark.parametrize("change", [str.lower, str.upper])
def test_clashing_columns(spark, change):
    names = list(map(change, CLASHES))
    w = [" ".join(words_of(80 + i, 80)) for i in range(4)]
    texts = [w[0], w[0], w[1] + " " + w[2], w[3] + " " + w[2], None]
    rows = [(i, t, "s", t and len(t), *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names))
    items = spark.createDataFrame([(1, w[1][:200])], "item_id long, text string")
    by_id = {r[0]: r for r in rows}
    for kept, out in (
        ({0, 1, 2, 3}, quality.kept_documents(df)),
        ({0, 2, 3, 4}, minhash.kept_documents(df)),
        ({0, 1, 3, 4}, decontaminate.clean_documents(df, items)),
    ):
        assert out.columns == df.columns and sorted(map(tuple, out.collect())) == [by_id[i] for i in sorted(kept)]
    out = substrings.without_repeats(df)
    got = {r[0]: tuple(r) for r in out.collect()}
    assert out.columns == df.columns and set(got) == {0, 2, 3, 4}
    assert got[3] == (3, w[3], "s", len(w[3]), *by_id[3][4:]) and all(got[i] == by_id[i] for i in (0, 2, 4))
    judged = quality.judge(df, carry=("doc_id", change("q_n_words"), change("q_text"))).collect()
    assert {(r[0], r[1], r[2]) for r in judged} == {(r[0], r[4 + CLASHES.index("q_n_words")], r[4 + CLASHES.index("q_text")]) for r in rows}


def ranks():
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def tiktoken_ids(text):
    with open(ranks(), "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return enc.encode_ordinary(text)


def test_bpe(spark, docs, rows):
    got = bpe.decode(bpe.encode(docs, ranks(), public_tokenizers.PATTERN, carry=("doc_id", "text")), ranks()).collect()
    assert len(got) == len(rows)
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == tiktoken_ids(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode() and r.n_tokens == len(r.ids) // 4


def test_bpe_in_chunks(spark):
    """Short chunks: cuts in words, white space and contractions; runs without a cut; repeated keys."""
    mixed = " ".join(words_of(3, 300)) + "\n\n\n  it's we'll   don't\t\t" + "日本語 テキスト" * 20
    texts = [mixed, mixed, "a" * 500, " " * 300 + "b", mixed[::-1], "\n \n x" * 100, "ab1" * 150]
    df = spark.createDataFrame([(1, t) for t in texts], "doc_id long, text string")
    got = bpe.encode(df, ranks(), public_tokenizers.PATTERN, carry=("text",), chunk=64, overlap=24).collect()
    assert sorted(r.text for r in got) == sorted(texts)
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == tiktoken_ids(r.text)


def test_coder_round_trip():
    rng = np.random.default_rng(1)
    blocks = np.minimum(rng.geometric(0.02, (7, 3000)), 999).astype(np.uint32)
    blocks[0] = 5
    blocks[1, :1500] = np.tile([3, 1, 4, 1, 5], 300)
    packed = token_files.encode_blocks(blocks, 1000)
    assert (token_files.decode_blocks(packed, 3000, 1000) == blocks).all()
    assert len(packed[0]) < 400 and len(packed[1]) < len(packed[2])
    # a block needs no other
    assert (token_files.decode_blocks(packed[3:4], 3000, 1000) == blocks[3:4]).all()


def test_file_checks(tmp_path):
    path = str(tmp_path / "a.ids")
    docs = [np.array([1, 2, 3], np.uint32), np.zeros(0, np.uint32), np.arange(20000, dtype=np.uint32) % 77]
    token_files.write_file(path, [None, 4, 9], docs, 100)
    got = list(token_files.read_file(path))
    assert [k for k, _ in got] == [None, 4, 9] and all((a == b).all() for (_, a), b in zip(got, docs))
    data = bytearray((tmp_path / "a.ids").read_bytes())
    data[-40] ^= 1
    (tmp_path / "a.ids").write_bytes(data)
    with pytest.raises(ValueError, match="broken block"):
        list(token_files.read_file(path))


def test_token_files(spark, docs, rows, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    manifest = token_files.write_documents(docs, path, end_id=2, file_ids=500)
    got = sorted(token_files.read_documents(manifest).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    place = 0
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for r, (key, text, *_) in zip(got, expected):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.doc_id == key and r.start == place
        assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        place += len(ids)
    assert token_files.read_documents(token_files.write_documents(empty, path, end_id=2)).count() == 0


def brute_bits(tree, data):
    """PPM-C code length of one text by walking the contexts; ``tree`` counts (a, b, c)."""
    alphabet = sorted({x for key in tree for x in key})
    bits, context = 0.0, (0, 0)
    for c in data:
        ruled_out = set()
        for order in (2, 1, 0):
            n = Counter()
            for (a, b, x), count in tree.items():
                if count and (a, b)[2 - order :] == context[2 - order :] and x not in ruled_out:
                    n[x] += count
            if not n:
                continue
            total = sum(n.values()) + len(n)
            if n[c]:
                bits += np.log2(total / n[c])
                break
            bits += np.log2(total / len(n))
            ruled_out |= set(n)
        else:
            bits += np.log2(max(1, len(alphabet) + 1 - len(ruled_out)))
        context = (context[1], c)
    return bits


def test_code_lengths():
    trees = {"en": Counter({(0, 0, 97): 4, (0, 97, 98): 3, (97, 98, 97): 2, (98, 97, 99): 1}), "de": Counter({(0, 0, 98): 2, (0, 98, 98): 5})}
    model = language.Model([(lang, a << 16 | b << 8 | c, n) for lang, t in trees.items() for (a, b, c), n in t.items()])
    merged = set(trees["en"]) | set(trees["de"])
    texts = ["abab", "bbbb", "", "cab", "zzz"]
    got = model.score(*hashing.text_bytes(pa.array(texts)))
    for i, t in enumerate(texts):
        for j, lang in enumerate(model.langs):
            tree = {k: trees[lang][k] for k in merged}  # one alphabet for all languages
            assert got[i, j] == pytest.approx(brute_bits(tree, t.encode()), rel=1e-5)


def test_special_strings(spark):
    """As the library takes them: as special tokens, also glued to letters."""
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["<|endoftext|>", "a<|startoftext|>b <|endoftext|><|endoftext|>, <|ENDOFTEXT|>", "<| endoftext |> x<|endoftext", "é<|endoftext|>É"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_files.read_documents(token_files.write_documents(df, path, end_id=2)).collect()}
    assert got == {i: Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    assert 49406 in got[1] and got[1].count(49407) == 2


def test_language(spark, docs, empty):
    got = language.identify(docs.limit(0).union(docs), F.col("lang").isNotNull(), carry=("doc_id", "text")).collect()
    for r in got:
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) and 0 <= r.score <= 1
    none = language.identify(docs, F.lit(False), carry=("doc_id",)).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


def test_language_held_out(spark, sf_dir):
    from perron.llm.queries import op10_language_id

    got = op10_language_id(spark, sf_dir).filter("held_out").join(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == r.lang for r in got) >= 0.9 * len(got)


def test_empty_tables(empty):
    assert minhash.near_duplicates(empty).count() == 0
    assert quality.judge(empty).count() == quality.kept_documents(empty).count() == 0
    assert substrings.mark_repeats(empty).count() == 0
    assert decontaminate.contained_items(empty, empty.select(F.col("doc_id").alias("item_id"), "text")).count() == 0
    assert bpe.encode(empty, ranks(), public_tokenizers.PATTERN).count() == 0
    assert language.identify(empty, F.lit(True)).count() == 0


def test_word_hashes():
    texts = ["a b  c\tab", "", None, "éa b", "ab"]
    words = hashing.Words(*hashing.text_bytes(pa.array(texts)))
    h = words.hashes()
    names = [w for t in texts for w in WORD.findall(t or "")]
    assert words.count.tolist() == [4, 0, 0, 2, 1] and len(set(h.tolist())) == len(set(names))
    assert {n: x for n, x in zip(names, h.tolist())} == dict(zip(names, h.tolist()))
    assert hashlib.sha256(h.tobytes()).hexdigest() == hashlib.sha256(words.hashes().tobytes()).hexdigest()
