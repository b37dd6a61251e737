"""Loaded tables against the declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from perron import schemas
from perron.plans.warehouse import Warehouse


def _fields(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def mismatch(df: DataFrame, declared: str) -> list[tuple[str, str]]:
    """Fields that only one of the two sides has, in order of appearance."""
    have, want = _fields(df.schema), _fields(T.StructType.fromDDL(declared))
    return [f for f in have if f not in want] + [f for f in want if f not in have]


def differences(house: Warehouse) -> dict[str, list[tuple[str, str]]]:
    """Per table, fields that differ from the declaration; empty when all agree."""
    checked = {
        "dim_train": mismatch(house.dim_train, schemas.DIM_TRAIN),
        "dim_time": mismatch(house.dim_time, schemas.DIM_TIME),
        "fact_train_movement": mismatch(house.fact, schemas.FACT_TRAIN_MOVEMENT),
    }
    return {name: fields for name, fields in checked.items() if fields}
