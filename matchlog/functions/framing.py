"""Column expressions that cut a raw client log line into time and message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import CHAT_TAG, MATCH_START_MESSAGE, MESSAGE_PATTERN, TIME_OF_DAY_PATTERN


def is_chat_line(value: Column) -> Column:
    """The chat tag anywhere in the line (literal substring, no regex)."""
    return value.contains(CHAT_TAG)


def event_time(value: Column) -> Column:
    """Leading ``[HH:mm:ss]`` as text; ``''`` when the line has none."""
    return F.regexp_extract(value, TIME_OF_DAY_PATTERN, 1)


def message(value: Column) -> Column:
    """Text after the chat tag and the blanks that follow it, space-trimmed.

    ``trim`` strips spaces only, so tabs inside the message survive.
    """
    return F.trim(F.regexp_extract(value, MESSAGE_PATTERN, 1))


def is_start_line(value: Column) -> Column:
    """1 if the raw line is a chat event whose message is exactly the start
    marker.  The literal ``contains`` test rejects almost every line before any
    regex."""
    guard = value.contains(MATCH_START_MESSAGE) & is_chat_line(value)
    return F.when(guard & (message(value) == F.lit(MATCH_START_MESSAGE)), F.lit(1)).otherwise(F.lit(0))
