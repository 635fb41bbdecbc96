"""Line -> event framing: keep chat lines, cut time and message, drop blanks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import framing as fr
from ..functions.once import select_once


def filter_chat(lines: DataFrame, value: str = "value") -> DataFrame:
    """Keep lines that carry the chat tag (narrow filter, no shuffle)."""
    return lines.where(fr.is_chat_line(F.col(value)))


def frame(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ("log_id", "line_no")) -> DataFrame:
    """Chat lines -> ``(*keep, event_time, message)``; empty messages dropped.

    Time and message are cut once per line (``select_once``); the blank
    filter then tests the stored message instead of re-running the regex.
    """
    v = F.col(value)
    framed = select_once(
        filter_chat(lines, value),
        keep,
        {"event_time": fr.event_time(v), "message": fr.message(v)},
    )
    return framed.where(F.length("message") > 0)
