"""Join shapes that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HASH = "__key_hash"


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join whose hot left keys can be split over tasks.

    The right side is usually an aggregate or a window result, and a join that
    reuses its partitioning cannot be split when a left key is hot. A hash of
    the keys as one more join column gives the (already reduced) right side an
    exchange of its own, so adaptive execution can split the hot partition of
    the left side - or turn the join into a broadcast once it has measured the
    right side to be small.
    """
    key_hash = F.xxhash64(*keys)
    joined = left.withColumn(_HASH, key_hash).join(right.withColumn(_HASH, key_hash), [_HASH, *keys], how)
    return joined.drop(_HASH)


def left_lookup(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join to a table that has one row per key."""
    return split_join(left, right, keys, "left")


def stored_lookup(left: DataFrame, right: DataFrame, keys: list[str], small: int = 10_000) -> DataFrame:
    """Left join to a stored table that has one row per key.

    Its rows are counted first, which reads footers only: Spark guesses the size of rows from that of compressed
    files, and would pass long tables through the driver. More than ``small`` rows are merged.
    """
    return left_lookup(left, right.hint("merge") if right.count() > small else right, keys)


def semi_join(left: DataFrame, members: DataFrame, key: str, small: int = 100_000) -> DataFrame:
    """Left rows whose key is a member.

    Members are counted first, up to ``small``: so few are broadcast and the
    left side, which may carry whole documents, is not shuffled at all. More of
    them are joined by shuffle.
    """
    members = members.select(key).where(F.col(key).isNotNull()).distinct()
    if members.limit(small + 1).count() <= small:
        return left.join(F.broadcast(members), key, "left_semi")
    return split_join(left, members, [key], "left_semi")


def new_members(candidates: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Distinct candidate keys that ``existing`` does not hold yet."""
    return candidates.where(F.col(key).isNotNull()).join(existing.select(key), key, "left_anti")


def spread_by_work(df: DataFrame, *keys: str) -> DataFrame:
    """One partition per shuffle partition, whatever the size.

    For rows of few bytes but much work: adaptive execution would merge them
    into few tasks because it goes by bytes. The keys are hashed once more so
    that the exchange is not folded into an equal one below it.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, F.xxhash64(*keys))
