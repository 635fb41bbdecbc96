"""Text -> lines, the way a text file reader splits a file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ``\r\n``, a lone ``\n`` and a lone ``\r`` all end a line.
LINE_BREAK = r"\r\n|\r|\n"


def split_lines(df: DataFrame, *, key: str, text: str) -> DataFrame:
    """``(key, text)`` -> ``(key, line_idx bigint, line)``, 0-based.

    A final line break does not open an empty last line and an empty text
    has no lines, as with a text file reader.  One ``posexplode`` directly
    over the split (a single generator stage, no shuffle).
    """
    t = F.col(text)
    body = F.regexp_replace(t, f"({LINE_BREAK})\\z", "")
    parts = F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(body, LINE_BREAK, -1))
    exploded = df.select(key, F.posexplode(parts).alias("_pos", "line"))
    return exploded.select(key, F.col("_pos").cast("long").alias("line_idx"), "line")
