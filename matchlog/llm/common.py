"""Shared helpers of the corpus operators: inputs, folds, scratch tables and
bounded Arrow batches.

Scratch tables go under the session's ``spark.checkpoint.dir`` (shared by all
executors on a cluster); a temporary folder is used only when it is unset.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Characters that one vectorised step handles at most (a longer text is a step
# of its own).
STEP_CHARS = 1_000_000
# Rows of one Arrow batch sent to a Python worker, so that a run of very long
# texts stays within a worker's memory.
BATCH_ROWS = 1000

# The white space of all contracts here: space, \t, \n, \v, \f, \r.
SPACES = " \t\n\x0b\x0c\r"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def fold_of(doc_id: Column) -> Column:
    """``crc32(doc_id as text) mod 3``; remainder 1 is held out of training."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


def held_out(doc_id: Column) -> Column:
    """A null id counts as held out: it never trains a model."""
    return F.coalesce(fold_of(doc_id) == 1, F.lit(True))


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back, which
    cuts its lineage at files that outlive any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def bounded_batches(spark: SparkSession) -> None:
    """Prepare the session for Python stages: Arrow batches of few rows, as
    texts may be very long, and this package on the executors' path."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    package = Path(__file__).resolve().parent.parent
    app = spark.sparkContext.applicationId
    if app in _shipped or not package.is_dir():  # already inside an archive that was submitted
        return
    _shipped.add(app)
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))


def steps(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = STEP_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text each (one row
    at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        end = np.cumsum(size)
        at = 0
        while at < n:
            done = end[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(end, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts, null as empty."""
    return ["" if t is None else t for t in batch.column(text).to_pylist()]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` of all rows, in order."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts.astype(np.int64) - first, lengths) + np.arange(total, dtype=np.int64)
