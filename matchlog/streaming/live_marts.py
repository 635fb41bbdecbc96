"""Marts that are kept up to date as new logs come in.

A batch of events is reduced to partial aggregates, which merge by sums, smallest
and largest values, and only those are written, each batch under its own number.
Reading a mart merges the partials of all batches, so it costs the number of
groups and not the number of events.  A batch that is run again overwrites its own
partials, so nothing is counted twice; a batch of corrected logs may be given again
under its number and replaces what it gave before.  ``compact`` merges the batches
before a number into one, which keeps the number of partials small; those batches
can then not be replaced any more.

A match of a log may be spread over batches: its first and last event are told by
line number.

Defined results: null groups are groups; an empty batch changes nothing; without
batches every mart is empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import marts


@dataclass(frozen=True)
class Partial:
    """A mart's groups, the columns of its partials, and how two partials of a
    group merge, by column."""

    by: tuple[str, ...]
    schema: str
    merged: dict[str, str]

    def merge(self, partials: DataFrame) -> DataFrame:
        return partials.groupBy(*self.by).agg(*[F.expr(f"{how}({c})").alias(c) for c, how in self.merged.items()])


PARTIALS = {
    "categories": Partial(("log_id", "match_id", "category"), "log_id {log}, match_id bigint, category string, n bigint", {"n": "sum"}),
    "spans": Partial(
        ("log_id", "match_id"),
        "log_id {log}, match_id bigint, n bigint, first struct<line_no: bigint, clock: int>, last struct<line_no: bigint, clock: int>",
        {"n": "sum", "first": "min", "last": "max"},
    ),
    "xp": Partial(("log_id", "match_id"), "log_id {log}, match_id bigint, xp_mid bigint, xp_end bigint", {"xp_mid": "sum", "xp_end": "sum"}),
    "resources": Partial(("log_id", "match_id", "resource"), "log_id {log}, match_id bigint, resource string, qty bigint", {"qty": "sum"}),
    "players": Partial(
        ("player",), "player string, kills bigint, deaths bigint, final_kills bigint", {"kills": "sum", "deaths": "sum", "final_kills": "sum"}
    ),
}


def partials_of(ev: DataFrame) -> dict[str, DataFrame]:
    """The partial aggregates of a batch of events."""
    edge = F.struct("line_no", marts.clock_number().alias("clock"))
    return {
        "categories": marts.events_by_match_category(ev, ordered=False),
        "spans": ev.groupBy("log_id", "match_id").agg(F.count(F.lit(1)).alias("n"), F.min(edge).alias("first"), F.max(edge).alias("last")),
        "xp": marts.xp_by_match(ev),
        "resources": marts.resources_by_match(ev),
        "players": marts.kd_by_player(ev).drop("kd_ratio"),
    }


class LiveMarts:
    """The partials of all batches under ``folder`` (shared storage)."""

    def __init__(self, spark: SparkSession, folder: str, *, log_type: str = "string"):
        self.spark, self.folder, self.log_type = spark, folder.rstrip("/"), log_type

    def _path(self, name: str, batch: str) -> str:
        return f"{self.folder}/{name}/batch={batch}"

    def add(self, ev: DataFrame, batch: int) -> None:
        """Put the events of one batch in, or in place of what it gave before."""
        for name, partial in partials_of(ev).items():
            partial.write.mode("overwrite").parquet(self._path(name, str(batch)))

    def _partials(self, name: str, batches: int, compacted: int = 0) -> DataFrame:
        schema = PARTIALS[name].schema.format(log=self.log_type)
        paths = [self._path(name, f"to-{compacted}")] if compacted else []
        paths += [self._path(name, str(b)) for b in range(compacted, batches)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def compact(self, batches: int, compacted: int = 0) -> None:
        """Merge the first ``batches`` batches (of which ``compacted`` were merged
        before) into one table; reads then name ``compacted=batches``."""
        for name, partial in PARTIALS.items():
            merged = partial.merge(self._partials(name, batches, compacted))
            merged.write.mode("overwrite").parquet(self._path(name, f"to-{batches}"))

    def _merged(self, name: str, batches: int, compacted: int) -> DataFrame:
        return PARTIALS[name].merge(self._partials(name, batches, compacted))

    def events_by_match_category(self, batches: int, compacted: int = 0) -> DataFrame:
        return self._merged("categories", batches, compacted)

    def match_spans(self, batches: int, compacted: int = 0) -> DataFrame:
        merged = self._merged("spans", batches, compacted)
        clock = merged.select("log_id", "match_id", "n", F.col("first.clock").alias("first"), F.col("last.clock").alias("last"))
        return marts.span_times(clock)

    def xp_by_match(self, batches: int, compacted: int = 0) -> DataFrame:
        return self._merged("xp", batches, compacted)

    def resources_by_match(self, batches: int, compacted: int = 0) -> DataFrame:
        return self._merged("resources", batches, compacted)

    def kd_by_player(self, batches: int, compacted: int = 0) -> DataFrame:
        merged = self._merged("players", batches, compacted)
        return merged.withColumn("kd_ratio", F.try_divide(F.col("kills").cast("double"), F.col("deaths").cast("double")))
