"""Surrogate keys without a global sort.

A running number over a whole table would pass it through one task. Members
are spread over 4096 buckets by a digest of their natural key and numbered
within their bucket, so a key is ``bucket * 2^40 + running number``: unique,
reproducible, and extendable by later loads without renumbering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "__bucket"
_DIGITS = 3
_SEQUENCE_BITS = 40


def _text(columns: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def key_bucket(columns: list[str]) -> Column:
    return F.conv(F.substring(F.md5(_text(columns)), 1, _DIGITS), 16, 10).cast("long")


def add_keys(members: DataFrame, natural: list[str], key: str, existing: DataFrame | None = None) -> DataFrame:
    """Number ``members``, continuing after the keys that ``existing`` uses."""
    bucketed = members.withColumn(_BUCKET, key_bucket(natural))
    number = F.row_number().over(Window.partitionBy(_BUCKET).orderBy(*natural)).cast("long")
    first = F.shiftleft(F.col(_BUCKET), _SEQUENCE_BITS)
    if existing is None:
        return bucketed.withColumn(key, first + number).drop(_BUCKET)
    # at most 4096 rows, one per bucket
    used = existing.groupBy(F.shiftright(F.col(key), _SEQUENCE_BITS).alias(_BUCKET)).agg(F.max(key).alias("__used"))
    return (
        bucketed.withColumn("__number", number)
        .join(F.broadcast(used), _BUCKET, "left")
        .withColumn(key, F.coalesce(F.col("__used"), first) + F.col("__number"))
        .drop(_BUCKET, "__used", "__number")
    )


def minute_key(ts: Column) -> Column:
    """``YYYYMMDDHHMM`` as a number: the feeds' times have minute grain, so a
    time's key is a function of the time and needs no lookup."""
    date = F.year(ts).cast("long") * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)
    return date * 10000 + F.hour(ts) * 100 + F.minute(ts)


def movement_id(columns: list[str]) -> Column:
    """Digest of a movement's place in the feed. 128 bits: at 10^12 rows a
    64-bit digest would already collide, and a running number needs a sort."""
    return F.md5(_text(columns))
