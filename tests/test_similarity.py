import random

import pytest
from pyspark.sql import functions as F

from perron.functions import indel_ratio
from perron.functions.similarity import letter_signature
from perron.operators import resolve


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


def ratio(a, b):
    if not a and not b:
        return 100.0
    return 200.0 * lcs(a, b) / (len(a) + len(b))


def random_names(n, rng, alphabet="abcdeü_", longest=20):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_known_scores(spark):
    pairs = [("suedkreuz", "s_dkreuz", 82.35294117647058), ("abc", "abd", 66.66666666666667),
             ("friedrichstrasse", "friedrichstr_sse", 93.75), ("", "", 100.0), ("", "a", 0.0)]
    df = spark.createDataFrame(pairs, "a string, b string, expected double")
    for row in df.select("expected", indel_ratio(F.col("a"), F.col("b")).alias("score")).collect():
        assert row.score == pytest.approx(row.expected, abs=1e-9)


def test_matches_textbook_programme_also_beyond_one_word(spark):
    rng = random.Random(3)
    names = random_names(80, rng) + random_names(20, rng, "ab", 150)
    pairs = [(rng.choice(names), rng.choice(names)) for _ in range(400)]
    pairs += [("a" * 62, "a" * 62), ("ab" * 40, "ba" * 40), ("x" * 63, "x" * 62)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for row in df.select("a", "b", indel_ratio(F.col("a"), F.col("b")).alias("score")).collect():
        assert row.score == pytest.approx(ratio(row.a, row.b), abs=1e-9)


def test_signature_never_overstates_the_distance(spark):
    rng = random.Random(5)
    names = random_names(60, rng, "abcdefghij", 25)
    df = spark.createDataFrame([(a, b) for a in names[:30] for b in names[30:]], "a string, b string")
    bits = F.bit_count(letter_signature(F.col("a")).bitwiseXOR(letter_signature(F.col("b"))))
    for row in df.select("a", "b", bits.alias("bits")).collect():
        assert row.bits <= len(row.a) + len(row.b) - 2 * lcs(row.a, row.b)


def perturbed(name, rng):
    letters = list(name)
    for _ in range(rng.randint(0, 4)):
        place = rng.randint(0, len(letters))
        if rng.random() < 0.5 and letters:
            letters.pop(min(place, len(letters) - 1))
        else:
            letters.insert(place, rng.choice("abcs_"))
    return "".join(letters)


def test_fuzzy_match_equals_brute_force(spark):
    rng = random.Random(11)
    known = {n for n in random_names(120, rng, "abcdefgh", 24) if n}
    known |= {n + "strasse" for n in list(known)[:60]}
    known |= {n[:30] * 3 for n in list(known)[:5]}  # longer than one word
    known = sorted(known)
    names = sorted({perturbed(rng.choice(known), rng) for _ in range(300)} | {"", "a", "zzz"})
    name_map = spark.createDataFrame(
        [(n, k, n.upper()) for k, n in enumerate(known)], "normalized string, station_key long, station_name string"
    )
    got = {
        r.name: (r.station_key, r.score)
        for r in resolve.fuzzy_matches(spark.createDataFrame([(n,) for n in names], "name string"), name_map).collect()
    }
    expected = {}
    for name in names:
        best = max(((ratio(name, k), -i) for i, k in enumerate(known)))
        if best[0] >= 85:
            expected[name] = (-best[1], best[0])
    assert set(got) == set(expected)
    for name, (key, score) in expected.items():
        assert got[name][0] == key and got[name][1] == pytest.approx(score, abs=1e-9)


def test_every_pair_of_lengths_has_short_enough_segments(spark):
    lengths = spark.range(1, 256).select(F.col("id").cast("int").alias("n"))
    pairs = lengths.select("n", F.explode(resolve._partner_lengths(F.col("n"))).alias("m"))
    partners = {}
    for row in pairs.select("n", "m", resolve._max_distance(F.col("n"), F.col("m")).alias("d")).collect():
        partners.setdefault(row.n, set()).add(row.m)
        assert row.n // (row.d + 1) in resolve.SEGMENT_LENGTHS
        assert -(-row.n // (row.d + 1)) in resolve.SEGMENT_LENGTHS
    for n, found in partners.items():
        assert found == {m for m in range(1, 2 * n + 1) if 100 * abs(n - m) <= 15 * (n + m)}


def test_fuzzy_join_meets_few_pairs(spark):
    rng = random.Random(13)
    known = sorted({"".join(rng.choice("abcdefghiklmnorstu") for _ in range(rng.randint(4, 12))) + "strasse" for _ in range(400)})
    names = spark.createDataFrame([(perturbed(n, rng),) for n in known], "name string")
    name_map = spark.createDataFrame([(k, n) for k, n in enumerate(known)], "station_key long, normalized string")
    keys = ["name_length", "place", "segment"]
    joined = resolve._substrings(names).join(resolve._segments(name_map), keys)
    # all of them end alike, the worst case of the join; other parts meet hardly anything
    assert joined.count() < len(known) ** 2
    assert joined.where("not contains('strasse', segment)").count() <= 0.1 * len(known) ** 2
    assert resolve._candidate_pairs(names, name_map).count() <= 0.1 * len(known) ** 2


def test_segments_are_never_broadcast(spark):
    # a known name gives some hundred rows, which Spark takes for one when it decides on a broadcast
    known = [(f"platz{n:07d}weg", n, f"Platz {n}") for n in range(2000)]
    name_map = spark.createDataFrame(known, "normalized string, station_key long, station_name string")
    names = spark.createDataFrame([(f"platz{n:07d}wex",) for n in range(100)], "name string")
    found = resolve.fuzzy_matches(names, name_map)
    assert found.count() == 100
    assert resolve._segments(name_map).count() > 30 * len(known)
    plan = resolve._candidate_pairs(names, name_map)._jdf.queryExecution().executedPlan().toString()
    # only the list of common word parts, joined from the left, may be broadcast
    assert "SortMergeJoin [name_length" in plan
    assert all("LeftOuter" in line for line in plan.splitlines() if "BroadcastHashJoin" in line)


def test_common_word_parts_are_dealt(spark, monkeypatch):
    rng = random.Random(19)
    known = sorted({"".join(rng.choice("abcdefgh") for _ in range(8)) + "strasse" for _ in range(150)})
    names = spark.createDataFrame([(perturbed(n, rng),) for n in known], "name string").distinct()
    name_map = spark.createDataFrame([(n, k, n.upper()) for k, n in enumerate(known)], "normalized string, station_key long, station_name string")
    whole = sorted(resolve.fuzzy_matches(names, name_map).collect())
    monkeypatch.setattr(resolve, "NAMES_PER_PART", 7)
    assert whole and sorted(resolve.fuzzy_matches(names, name_map).collect()) == whole


def test_list_of_common_parts_is_bounded(spark, monkeypatch):
    rng = random.Random(23)
    known = sorted({"".join(rng.choice("abcdefgh") for _ in range(8)) + "strasse" for _ in range(150)})
    names = spark.createDataFrame([(perturbed(n, rng),) for n in [*known, ""]], "name string").distinct()
    name_map = spark.createDataFrame([(n, k, n.upper()) for k, n in enumerate(known)], "normalized string, station_key long, station_name string")
    whole = sorted(resolve.fuzzy_matches(names, name_map).collect())
    substrings = resolve._substrings(names)
    assert names.agg(F.sum(resolve._n_substrings(F.col("name")))).first()[0] == substrings.count()
    monkeypatch.setattr(resolve, "NAMES_PER_PART", 2)
    common = substrings.groupBy(*resolve._KEYS).count().where(F.col("count") > 2).count()
    assert resolve._common_parts(names, substrings).count() == common > 300
    monkeypatch.setattr(resolve, "MOST_PARTS", 300)
    assert 0 < resolve._common_parts(names, substrings).count() < 300
    assert whole and sorted(resolve.fuzzy_matches(names, name_map).collect()) == whole
    empty = names.where("name is null")
    assert resolve._common_parts(empty, resolve._substrings(empty)).count() == 0


def test_signature_of_two_words_never_overstates_the_distance(spark):
    rng = random.Random(17)
    names = [n or "a" for n in random_names(60, rng, "abcdefghij", 25)]
    df = spark.createDataFrame([(a, b) for a in names[:30] for b in names[30:]], "a string, b string")
    both = (F.bit_count(letter_signature(F.col("a"), n, 2).bitwiseXOR(letter_signature(F.col("b"), n, 2))) for n in range(2))
    for row in df.select("a", "b", sum(both).alias("bits")).collect():
        assert row.bits <= len(row.a) + len(row.b) - 2 * lcs(row.a, row.b)
