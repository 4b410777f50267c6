"""Guard against messages that a stream delivers more than once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from txrisk.schemas import POSITION

TIME = "ingested_at"
# How long after its first delivery a message is still known.
GUARD = "10 minutes"


def once(rows: DataFrame, within: str = GUARD, keys: Sequence[str] = POSITION) -> DataFrame:
    """The rows without those whose ``keys`` came before, no longer than
    ``within`` ago by event time. State holds the keys of that period; a copy
    that comes later still is older than the watermark and dropped as late."""
    return rows.withWatermark(TIME, within).dropDuplicatesWithinWatermark(list(keys))
