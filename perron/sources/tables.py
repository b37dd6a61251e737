"""Parquet tables of the lake and the warehouse."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def stored(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The table, or None where nothing was written yet."""
    try:
        return read_table(spark, root, name)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_table(df: DataFrame, root: str, name: str, partition_by: tuple[str, ...] = ()) -> str:
    """Add rows; the table, which may have very many files, is not listed."""
    path = f"{root.rstrip('/')}/{name}"
    out = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    out.write.mode("append").partitionBy(*partition_by).parquet(path)
    return path


def of_new_files(df: DataFrame, known: DataFrame | None, path: str = "file_path") -> DataFrame:
    """Rows of the files that ``known`` has no rows of; a file never changes once it was loaded.

    Paths are merged: in Parquet they take some hundredth of their length, so Spark would guess a long list
    of them to be small and broadcast it through the driver.
    """
    if known is None:
        return df
    return df.join(known.select(path).distinct().hint("merge"), path, "left_anti").select(*df.columns)


def overwrite_table(df: DataFrame, root: str, name: str) -> str:
    """Replace a table as a whole."""
    path = f"{root.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def overwrite_units(df: DataFrame, root: str, name: str, unit: str = "unit") -> None:
    """Replace only the units that ``df`` holds."""
    out = df.hint("rebalance", F.col(unit)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy(unit).parquet(f"{root.rstrip('/')}/{name}")


def overwrite_by_date(
    df: DataFrame,
    root: str,
    name: str,
    ts: str,
    date_column: str = "service_date",
    sort_by: str | None = None,
    units: tuple[str, ...] = (),
) -> str:
    """Replace only the dates that ``df`` holds, so that a rerun adds nothing twice.

    With ``units`` the dates lie below these columns, and only the dates of the
    units that ``df`` holds are replaced: two units may share dates. The rebalance hint lets adaptive execution split large dates over several
    tasks and merge small ones; ``sort_by`` tightens Parquet min/max statistics.
    """
    path = f"{root.rstrip('/')}/{name}"
    dated = df.withColumn(date_column, F.to_date(ts)).hint("rebalance", *[F.col(c) for c in (*units, date_column)])
    if sort_by:
        dated = dated.sortWithinPartitions(*units, date_column, sort_by)
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*units, date_column)
        .parquet(path)
    )
    return path
