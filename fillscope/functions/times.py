"""Parsing of block times, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the time format of the block table, UTC.
BLOCK_TIME_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
SECONDS_PER_DAY = 86400


def block_epoch(text: Column) -> Column:
    """Seconds since 1970 UTC, NULL for text that is not a block time.

    The cast parses this one format several times faster than a format pattern.
    """
    return F.when(text.rlike(BLOCK_TIME_SHAPE), F.unix_seconds(text.try_cast("timestamp")))


def utc_time(epoch: Column) -> Column:
    """The UTC wall-clock time as a timestamp without zone."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.expr("INTERVAL '1' SECOND") * epoch
