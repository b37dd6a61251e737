"""Segments of known names go by how much their letters tell."""

import random

from pyspark.sql import functions as F

from perron.operators import resolve


def known_names(spark, n):
    rng = random.Random(5)
    known = sorted({"berlin_" + "".join(rng.choice("bdfgklmnprstaeio") for _ in range(10)) + "_strasse" for _ in range(n)})
    return known, spark.createDataFrame([(n, k, n.upper()) for k, n in enumerate(known)], "normalized string, station_key long, station_name string")


def test_words_that_all_names_share_are_no_keys(spark):
    known, name_map = known_names(spark, 300)
    rng = random.Random(6)
    other = ["berlin_" + "".join(rng.choice("bdfgklmnprstaeio") for _ in range(10)) + "_strasse" for _ in range(300)]
    names = spark.createDataFrame([(n,) for n in other], "name string")
    joined = resolve._substrings(names).join(resolve._segments(name_map), resolve._KEYS)
    assert joined.count() < 1.5 * len(known) * len(other)


def test_segments_cover_the_name_and_stand_in_it(spark):
    known, name_map = known_names(spark, 40)
    extra = spark.createDataFrame([("a", -1, ""), ("aaaaaaa", -2, ""), ("straße_ä_strasse" * 5, -3, "")], name_map.schema)
    segments = resolve._segments(name_map.union(extra))
    rows = segments.where("place - lead >= 0").collect()
    assert rows and {r.station_key for r in rows} >= set(range(len(known))) | {-1, -2, -3}
    # a name of the same length: each of the max_distance + 1 segments without a shift
    for r in segments.where(F.length("normalized") == F.col("name_length")).collect():
        assert 1 <= len(r.segment) <= 6 and r.segment in r.normalized
    unshifted = segments.where((F.length("normalized") == F.col("name_length")) & F.expr("substring(normalized, place + 1, length(segment)) = segment"))
    for r in unshifted.groupBy("station_key", "max_distance").agg(F.countDistinct("place").alias("n")).collect():
        assert r.n >= r.max_distance + 1


def test_list_of_common_letters_is_bounded(spark, monkeypatch):
    known, name_map = known_names(spark, 60)
    lengths = name_map.select("normalized", F.length("normalized").alias("known_length"))
    sizes = F.aggregate(F.map_values("common"), F.lit(0), lambda done, x: done + F.length(x["letters"]))
    whole = sorted(resolve.fuzzy_matches(name_map.select(F.expr("concat(substring(normalized, 1, 8), substring(normalized, 10))").alias("name")), name_map).collect())
    assert len(whole) == len(known)
    monkeypatch.setattr(resolve, "MOST_LETTERS", 30)
    assert 0 < resolve._common_letters(lengths).select(sizes.alias("n")).first().n < 30
    assert sorted(resolve.fuzzy_matches(name_map.select(F.expr("concat(substring(normalized, 1, 8), substring(normalized, 10))").alias("name")), name_map).collect()) == whole
    assert resolve._segments(name_map.where("false")).count() == 0
