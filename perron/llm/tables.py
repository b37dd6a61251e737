"""Intermediate tables, bounded broadcasts and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.session import shared_dir

# Rows of at most some 50 bytes: 50 MB at most on every executor.
BROADCAST_ROWS = 1_000_000
# Rows that may be broadcast where several tables are at once, some 10 MB on the driver each while they are built.
JOIN_ROWS = 100_000
# Bits of a filter over members, in rows of 4096: 2 MB for all of them, however many members there are.
FILTER_BITS = 1 << 24


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the job.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is.

    ``df`` should be a stored or small table, as it is counted.
    """
    few = df.limit(rows + 1).count() <= rows
    return F.broadcast(df) if few else df


def is_short(df: DataFrame) -> bool:
    """True for at most JOIN_ROWS rows. ``df`` should be a stored table."""
    return df.limit(JOIN_ROWS + 1).count() <= JOIN_ROWS


def sided(df: DataFrame, short: bool) -> DataFrame:
    """A side of a join, broadcast where it is ``short``, else merged.

    Spark goes by bytes: ids in compressed files or blocks take some tenth of what a broadcast of them takes on the driver.
    """
    return F.broadcast(df) if short else df.hint("merge")


def member_flag(rows: DataFrame, key: Column, members: DataFrame) -> tuple[DataFrame, Column]:
    """``rows`` with a column more, and a flag over it: false where the bigint ``key`` is surely no member, or null.

    ``members`` has one bigint column. What is broadcast is a bit per hash, at most 2 MB; some keys that are
    no members share theirs, so rows with the flag still have to be joined.
    """

    def place(of: Column) -> tuple[Column, Column, Column]:
        at = F.pmod(F.xxhash64(of), F.lit(FILTER_BITS))
        return F.shiftright(at, 12).alias("bucket"), F.shiftright(at, 6).bitwiseAND(F.lit(63)).cast("int"), at.bitwiseAND(F.lit(63)).cast("int")

    bucket, word, bit = place(members[members.columns[0]])
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = members.groupBy(bucket, word.alias("word")).agg(F.bit_or(one).alias("bits"))
    rowed = words.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("found"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("found", i), F.lit(0).cast("long")))
    rowed = rowed.select(F.col("bucket").alias("member_bucket"), filled.alias("member_bits"))
    bucket, word, bit = place(key)
    joined = rows.join(F.broadcast(rowed), bucket == F.col("member_bucket"), "left").drop("member_bucket")
    is_set = F.call_function("shiftright", F.get("member_bits", word), bit).bitwiseAND(F.lit(1)) == 1
    return joined, F.coalesce(is_set & key.isNotNull(), F.lit(False))


def task_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b), component being the least id reachable.

    Every round hooks each vertex on its least neighbour, follows the hook once
    more, and contracts the graph; hooks are kept in a table per round, and no
    vertex needs its whole neighbourhood in one place.
    """
    spark = edges.sparkSession
    edges = saved(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), purpose)
    labels = None
    while edges.head(1):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = saved(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("up")), purpose)
        short = is_short(hooks)
        above = hooks.select(F.col("id").alias("up"), F.col("up").alias("top"))
        hooks = saved(hooks.join(sided(above, short), "up").select("id", F.col("top").alias("up")), purpose)
        if labels is None:
            labels = hooks.select("id", F.col("up").alias("component"))
        else:
            moved = hooks.select(F.col("id").alias("component"), "up")
            labels = saved(
                labels.join(sided(moved, short), "component", "left").select("id", F.coalesce("up", "component").alias("component")),
                purpose,
            )
        ends = edges.join(sided(hooks.select(F.col("id").alias("a"), F.col("up").alias("up_a")), short), "a")
        ends = ends.join(sided(hooks.select(F.col("id").alias("b"), F.col("up").alias("up_b")), short), "b").filter("up_a <> up_b")
        edges = saved(ends.select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b")).distinct(), purpose)
    if labels is None:
        return spark.createDataFrame([], "id long, component long")
    return labels
