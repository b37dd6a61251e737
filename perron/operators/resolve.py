"""Station names of the feed -> rows of ``dim_station``.

Exact match on the normalised XML name, then on the normalised file name; only
distinct names that stay open are matched by similarity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perron.functions import indel_ratio, normalize_station
from perron.functions.similarity import let, letter_signature, match_masks
from perron.operators.joins import spread_by_work

THRESHOLD = 85


def station_name_map(dim_station: DataFrame) -> DataFrame:
    """(normalized, station_key, station_name); the last station of a name wins."""
    return (
        dim_station.select(normalize_station(F.col("station_name")).alias("normalized"), "station_key", "station_name")
        .groupBy("normalized")
        .agg(F.max_by(F.struct("station_key", "station_name"), "station_key").alias("station"))
        .select("normalized", "station.station_key", "station.station_name")
    )


def exact_matches(names: DataFrame, name_map: DataFrame) -> DataFrame:
    """(xml_station, file_station) rows with their station, null where none fits."""

    def lookup(prefix: str) -> DataFrame:
        return name_map.select(
            F.col("normalized").alias(f"{prefix}_norm"),
            F.struct("station_key", "station_name").alias(f"{prefix}_match"),
        )

    matched = (
        names.withColumn("xml_norm", normalize_station(F.col("xml_station")))
        .withColumn("file_norm", normalize_station(F.col("file_station")))
        .join(lookup("xml").hint("merge"), "xml_norm", "left")
        .join(lookup("file").hint("merge"), "file_norm", "left")
    )
    station = F.coalesce("xml_match", "file_match")
    return matched.select(
        "xml_station", "file_station", "xml_norm", "file_norm",
        station["station_key"].alias("station_key"), station["station_name"].alias("station_name"),
    )


# ---- similarity -------------------------------------------------------------
#
# A pair scores at least 85 only if its indel distance is at most 15 % of the
# summed lengths; d is the greatest such number for a pair of lengths that is even
# or odd as their difference is, which every indel distance is. Cut the
# known name into d + 1 segments, wherever its letters tell most, numbered from 0. Of d insertions and deletions
# there is a segment i that none of them touches, with at most i of them before
# it and d - i behind it (the first segment up to whose end there are no more
# than i). So it stands unchanged in the other name, shifted by at most i places,
# and by at most d - i from the shift that the lengths give at the end. The join is
# on length, place and text of the segment: it finds every pair that can pass. Most
# others fall to a comparison of letter signatures, which is an XOR and a bit
# count a word, and to the Levenshtein distance, which never exceeds the indel distance,
# before the real score is computed. A known name gives some hundred segment rows, which
# Spark takes for one when it guesses sizes: these sides are merged, never broadcast. So are
# all lists of names, which pass through tasks only.


def _partner_lengths(length: Column) -> Column:
    """Lengths of names that can score THRESHOLD against a name of ``length``."""
    least = F.ceil(length * THRESHOLD / F.lit(200 - THRESHOLD)).cast("int")
    return F.sequence(least, F.floor(length * (200 - THRESHOLD) / F.lit(THRESHOLD)).cast("int"))


def _max_distance(length: Column, other: Column) -> Column:
    most = F.floor((length + other) * (100 - THRESHOLD) / F.lit(100)).cast("int")
    return most - (most + length + other) % 2


def _signatures(text: Column, prefix: str) -> list[Column]:
    """The letters of a text in two words."""
    return [letter_signature(text, n, 2).alias(f"{prefix}_{n}") for n in range(2)]


# Letters of a segment that are compared.
SEGMENT_LENGTHS = range(1, 7)


# Letters at a place of known names of a length that are told from rare ones: at most so many.
MOST_LETTERS = 20_000
# Bits that a rare letter is worth, and what any letter is worth at least.
RARE_BITS, LEAST_BITS = 12.0, 0.05


def _common_letters(known: DataFrame) -> DataFrame:
    """A row per length of known names: by place the common letters there and the bits that each is worth; at most MOST_LETTERS letters in all."""
    place = F.explode(F.sequence(F.lit(0), F.col("known_length") - 1)).alias("p")
    letters = known.select("known_length", "normalized", place).groupBy("known_length", "p", F.expr("substring(normalized, p + 1, 1)").alias("letter"))
    counts = letters.agg(F.count("*").alias("n")).withColumn("names", F.sum("n").over(Window.partitionBy("known_length", "p")))
    share = known.agg((F.sum("known_length") / MOST_LETTERS).alias("share")).scalar()
    common = counts.where(F.col("n") > share).select("known_length", "p", "letter", F.log2(F.col("names") / F.col("n")).alias("bits"))
    places = common.groupBy("known_length", "p").agg(F.collect_list(F.struct("letter", "bits")).alias("l"))
    at = F.struct(F.array_join(F.col("l.letter"), "").alias("letters"), F.col("l.bits").alias("bits"))
    return places.groupBy("known_length").agg(F.map_from_entries(F.collect_list(F.struct("p", at))).alias("common"))


def _letter_bits(name_map: DataFrame) -> DataFrame:
    """Known names with ``sums``: the bits of their letters, added up from the left; 0 comes first."""
    known = spread_by_work(name_map.where(F.length("normalized") > 0), "normalized").select(
        "station_key", "normalized", F.length("normalized").alias("known_length"), *_signatures(F.col("normalized"), "known")
    )

    def bits(p: Column) -> Column:
        at = F.try_element_at("common", p)
        found = F.call_function("instr", at["letters"], F.substring(F.col("normalized"), p + 1, F.lit(1)))
        return F.greatest(F.coalesce(F.when(found > 0, F.get(at["bits"], found - 1)), F.lit(RARE_BITS)), F.lit(LEAST_BITS))

    each = known.join(F.broadcast(_common_letters(known)), "known_length", "left").withColumn(
        "bits", F.transform(F.sequence(F.lit(0), F.col("known_length") - 1), bits)
    )
    sums = F.aggregate("bits", F.array(F.lit(0.0)), lambda done, b: F.array_append(done, F.element_at(done, -1) + b))
    return each.withColumn("sums", sums).drop("common", "bits")


def _starts() -> Column:
    """Where the max_distance + 1 segments of a known name begin, and its length.

    Any cut into that many segments finds all pairs. This one gives each about the same number of chance partners: a segment has
    the more bits, the more shifts it may have. Letters that all names share make up no segment of their own while others are left.
    """
    sums, most, length = F.col("sums"), F.col("max_distance"), F.col("known_length")

    def shifts(i: Column) -> Column:
        return F.log2(F.least(i, most - i) * 2 + 1)

    def following(start: Column, i: Column) -> Column:
        later = most - i
        due = F.aggregate(F.sequence(i, most), F.lit(0.0), lambda done, j: done + shifts(j))
        left = F.element_at(sums, -1) - F.get(sums, start)
        goal = (F.get(sums, start) + F.greatest((left - due) / (later + 1), F.lit(0.0)) + shifts(i)) * 2
        # the place next to the goal, so that there is a letter for every segment
        below = lambda bits: F.size(F.filter(F.sequence(start + 1, length - 1), lambda p: F.get(sums, p) + F.get(sums, p + 1) < bits))
        return let(goal, lambda bits: F.least(start + 1 + below(bits), length - later))

    first = F.array(F.lit(0))
    rest = F.aggregate(F.sequence(F.lit(0), most - 1), first, lambda done, i: F.array_append(done, following(F.element_at(done, -1), i)))
    return F.array_append(F.when(most > 0, rest).otherwise(first), length)


def _segments(name_map: DataFrame) -> DataFrame:
    """A row per known name, length of the other name, segment, and place where it may stand there.

    ``segment`` is the rarest part of up to 6 letters of the segment, ``lead`` the number of letters before it.
    """
    length, other, most = F.col("known_length"), F.col("name_length"), F.col("max_distance")
    i, longer, sums, starts = F.col("i"), other - length, F.col("sums"), F.col("starts")

    def text(start: Column, end: Column) -> Column:
        return F.substring(F.col("normalized"), start + 1, end - start)

    def cut(n: Column) -> Column:
        start, end = F.get(starts, n), F.get(starts, n + 1)
        width = F.least(end - start, F.lit(SEGMENT_LENGTHS[-1]))
        rarest = F.array_max(
            F.transform(
                F.sequence(start, end - width), lambda p: F.struct((F.get(sums, p + width) - F.get(sums, p)).alias("bits"), (-p).alias("p"))
            )
        )
        at = -rarest["p"]
        previous = F.when(n > 0, text(F.get(starts, n - 1), start))
        return F.struct(n.alias("i"), at.alias("at"), (at - start).alias("lead"), text(at, at + width).alias("segment"), previous.alias("previous"))

    def bounds(n: Column) -> tuple[Column, Column]:
        return F.greatest(-n, longer - most + n), F.least(n, longer + most - n)

    # where the segment before may stand right before this one
    before = F.when((i > 0) & F.col("shift").between(*bounds(i - 1)), F.col("previous")).alias("before")
    partners = F.transform(_partner_lengths(length), lambda o: F.struct(o.alias("name_length"), _max_distance(length, o).alias("most")))
    return (
        _letter_bits(name_map)
        .withColumn("partners", partners)
        # lengths of equal distance share a cut; outer, as other explodes get a filter that computes their arrays once more
        .select("*", F.explode_outer(F.array_distinct(F.col("partners.most"))).alias("max_distance"))
        .withColumn("starts", _starts())
        .withColumn("cuts", F.transform(F.sequence(F.lit(0), most), cut))
        .select("*", F.explode_outer(F.filter("partners", lambda x: x["most"] == most)).alias("partner"))
        .select("*", F.col("partner.name_length").alias("name_length"), F.inline_outer("cuts"))
        .select("*", F.explode(F.sequence(*bounds(i))).alias("shift"))
        .withColumn("place", F.col("at") + F.col("shift"))
        .where((F.col("place") >= F.col("lead")) & (F.col("place") + F.length("segment") <= other))
        .select("station_key", "normalized", "known_0", "known_1", "max_distance", "name_length", "place", "lead", "segment", before)
    )


def _substrings(names: DataFrame) -> DataFrame:
    """A row per name, place and segment."""
    name, length, n = F.col("name"), F.col("name_length"), F.col("n")
    longest = F.least(length, F.lit(SEGMENT_LENGTHS[-1]))
    return (
        spread_by_work(names.where(F.length(name) > 0), "name")
        .select("name", F.length(name).alias("name_length"), *_signatures(name, "name"))
        .select("*", F.explode(F.sequence(F.lit(SEGMENT_LENGTHS[0]), longest)).alias("n"))
        .select("*", F.explode(F.sequence(F.lit(0), length - n)).alias("place"))
        .select("name", "name_length", "name_0", "name_1", "place", F.substring(name, F.col("place") + 1, n).alias("segment"))
    )


def _n_substrings(name: Column) -> Column:
    """Rows that _substrings makes of a name."""
    return sum(F.greatest(F.length(name) - n + 1, F.lit(0)) for n in SEGMENT_LENGTHS)


_KEYS = ["name_length", "place", "segment"]
# Rows of one segment at one place that one task should compare, or one in MOST_PARTS of all rows where that is more:
# so there are at most MOST_PARTS such segments, however many names there are.
NAMES_PER_PART = 1000
MOST_PARTS = 20_000


def _common_parts(names: DataFrame, substrings: DataFrame) -> DataFrame:
    """Segments that many names have at the same place, with the number of parts to deal these names over; at most MOST_PARTS rows."""
    share = names.agg((F.sum(_n_substrings(F.col("name"))) / MOST_PARTS).alias("share")).scalar()
    per_part = F.greatest(F.lit(NAMES_PER_PART).cast("double"), share)
    counts = substrings.groupBy(*_KEYS).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > per_part).select(*_KEYS, F.ceil(F.col("n") / per_part).alias("n_parts"))


def _candidate_pairs(names: DataFrame, name_map: DataFrame) -> DataFrame:
    """Distinct (name, station_key) that may score 85; a pair found through
    several segments is counted once. Partitioned by station, one partition per shuffle partition."""
    name, most, before = F.col("name"), F.col("max_distance"), F.col("before")
    distance_floor = sum(F.bit_count(F.col(f"name_{n}").bitwiseXOR(F.col(f"known_{n}"))) for n in range(2))
    # the segment before, right before this one, finds the same pair; place counts from 0
    start = F.col("place") - F.col("lead") - F.length(before) + 1
    found = F.coalesce((start > 0) & (F.substring(name, start, F.length(before)) == before), F.lit(False))
    distance = F.call_function("levenshtein", name, F.col("normalized"), most)
    partitions = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a common word part meets all names that have it: its names are dealt over parts, each with all its stations
    substrings = _substrings(names)
    parts = F.broadcast(_common_parts(names, substrings))
    n_parts = F.coalesce("n_parts", F.lit(1))
    dealt = substrings.join(parts, _KEYS, "left").withColumn("part", F.pmod(F.xxhash64("name"), n_parts))
    known = _segments(name_map).join(parts, _KEYS, "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), n_parts - 1)))
    return (
        dealt.drop("n_parts")
        .repartition(partitions, *_KEYS, "part")
        .join(known.drop("n_parts").hint("merge"), [*_KEYS, "part"])
        .where((distance_floor <= most) & ~found & (distance >= 0))
        .select("name", "station_key")
        .repartition(partitions, "station_key")
        .distinct()
    )


def fuzzy_matches(names: DataFrame, name_map: DataFrame) -> DataFrame:
    """Best station with a score of at least 85 for each distinct ``name``.

    Equal scores go to the lowest station key. A known name scores 100 with itself
    and less with any other, so only names that are not known are compared.
    """
    itself = name_map.select(F.col("normalized").alias("name"), "station_key", "station_name").hint("merge")
    same = names.where(F.length("name") > 0).join(itself, "name").withColumn("score", F.lit(100.0))
    known = name_map.select("*", match_masks(F.col("normalized")).alias("masks"))
    score = indel_ratio(F.col("name"), F.col("normalized"), F.col("masks"))
    near = (
        _candidate_pairs(names.join(itself, "name", "left_anti"), name_map)
        .join(known.hint("merge"), "station_key")
        .select("name", "station_key", "station_name", score.alias("score"))
        .where(F.col("score") >= THRESHOLD)
    )
    ranked = F.struct("score", -F.col("station_key"))
    return (
        same.select(*near.columns)
        .unionByName(near)
        .groupBy("name")
        .agg(F.max_by(F.struct("station_key", "station_name", "score"), ranked).alias("best"))
        .select("name", "best.*")
    )


def resolve_stations(names: DataFrame, name_map: DataFrame) -> DataFrame:
    """Distinct (xml_station, file_station) -> station, null where unresolved."""
    exact = exact_matches(names.select("xml_station", "file_station").distinct(), name_map)
    unresolved = exact.where("station_key is null")
    open_names = unresolved.select(F.explode(F.array("xml_norm", "file_norm")).alias("name")).distinct()
    fuzzy = fuzzy_matches(open_names, name_map)

    def lookup(prefix: str) -> DataFrame:
        return fuzzy.select(
            F.col("name").alias(f"{prefix}_norm"),
            F.struct("station_key", "station_name").alias(f"{prefix}_match"),
        )

    station = F.coalesce("xml_match", "file_match")
    guessed = (
        unresolved.select("xml_station", "file_station", "xml_norm", "file_norm")
        .join(lookup("xml").hint("merge"), "xml_norm", "left")
        .join(lookup("file").hint("merge"), "file_norm", "left")
        .select(
            "xml_station", "file_station",
            station["station_key"].alias("station_key"), station["station_name"].alias("station_name"),
            F.when(station.isNotNull(), "fuzzy").alias("match"),
        )
    )
    found = exact.where("station_key is not null").select(
        "xml_station", "file_station", "station_key", "station_name", F.lit("exact").alias("match")
    )
    return found.unionByName(guessed)
