"""Timestamp expressions.  Timestamps carry no zone and are read as UTC."""

from __future__ import annotations

from pyspark.sql import Column

from .text import strip_zone_mark


def lenient_timestamp(text: Column) -> Column:
    """ISO text as a timestamp without zone; null where it can't be read."""
    return strip_zone_mark(text).try_cast("timestamp_ntz")
