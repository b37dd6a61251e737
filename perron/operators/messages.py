"""Messages attached to movements."""

from __future__ import annotations

from pyspark.sql import DataFrame


def movement_messages(fact: DataFrame, bridge: DataFrame, messages: DataFrame) -> DataFrame:
    """One row per movement and message; sort by ``message_sequence`` within a movement.

    Rows are not collected into arrays: a movement may carry any number.
    """
    return bridge.join(messages, "message_key").join(fact, "movement_id")
