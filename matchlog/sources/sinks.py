"""Sinks for the event table and marts: distributed writers, no collect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame


BOM = "\ufeff"


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite", bom: bool = False) -> None:
    """CSV with a header, UTF-8, nulls as empty fields (one file per task).

    Quotes inside values are doubled and blanks are kept, as any CSV reader
    expects.  ``bom=True`` starts each file with a byte-order mark (part of the
    first header field), which some spreadsheets want.

    CSV cannot tell ``''`` from null: an empty ``event_time`` reads back as
    null.  Use the Parquet sink when that matters.
    """
    if bom:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    options = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"'}
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(**options, **keep_blanks).csv(path)


def write_parquet(df: DataFrame, path: str, *, partition_by: Sequence[str] = ("category",), mode: str = "overwrite") -> None:
    """Columnar sink, partitioned so category filters prune directories.

    The rows are rebalanced by the partition columns first: AQE merges small
    pieces and splits a hot category, so files follow the data's size and not
    the number of tasks times the number of categories."""
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def keep(df: DataFrame) -> DataFrame:
    """Persist a table several marts read (memory, spilling to disk)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
