"""Lines -> the flat event table (the ETL proper).

``build_events`` = frame -> classify -> enrich -> segment, all DataFrame to
DataFrame; building runs nothing.  The row-local, regex-heavy work runs in the scan
stage, whose parallelism follows the input splits; only the segmentation
shuffles, and after it only the window and the offset join remain.  Marts
that do not need ``match_id`` call it with ``with_match=False`` and skip the
shuffle altogether.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import enrich as en
from ..functions.framing import is_start_line
from ..functions.once import select_once
from ..functions.rules import MATCH_START_MESSAGE, classify, sql_literal
from .framing import frame
from .segment import DEFAULT_CHUNK_ROWS, assign_match_ids

EVENT_COLUMNS = (
    "log_id",
    "line_no",
    "match_id",
    "event_time",
    "message",
    "category",
    "target",
    "actor",
    "detail",
    "is_final",
    "is_own",
    "detail_name",
    "detail_qty",
)


def classify_events(events: DataFrame, message: str = "message") -> DataFrame:
    """Add ``category`` (ordered rule pack, first match wins), once per row."""
    return select_once(events, events.columns, {"category": classify(message)})


# Rows of ``owners`` that may be broadcast (one per log, tens of bytes each).
BROADCAST_OWNERS = 500_000


def with_owner(lines: DataFrame, owners: DataFrame) -> DataFrame:
    """``lines`` with the ``owner`` of each log from ``owners(log_id, owner)``;
    logs without one get a null owner.  Two rows for a log raise, also if they
    name the same owner: they would double its lines.  Up to ``BROADCAST_OWNERS``
    owners are broadcast, so a log with a third of all lines is no hot key;
    counting them is the one job that runs here."""
    own = owners.groupBy("log_id").agg(F.min("owner").alias("owner"), F.count(F.lit(1)).alias("_rows"))
    twice = F.raise_error(F.concat(F.lit("several owners for log "), F.coalesce(F.col("log_id").cast("string"), F.lit("null")))).cast("string")
    own = own.select(F.col("log_id").alias("_log"), F.when(F.col("_rows") == 1, F.col("owner")).otherwise(twice).alias("owner"))
    if owners.limit(BROADCAST_OWNERS + 1).count() <= BROADCAST_OWNERS:
        own = F.broadcast(own)
    return lines.join(own, lines["log_id"].eqNullSafe(own["_log"]), "left").drop("_log")


def owner_of(rows: DataFrame, protagonist: str | None) -> str:
    """The log owner as SQL text: one name for all logs, or the column ``owner``
    (``with_owner``).  There is no default: a wrong name silently credits one
    player's purchases and experience to another."""
    if protagonist is not None:
        return sql_literal(protagonist)
    if "owner" not in rows.columns:
        raise ValueError("name the owner of the logs: protagonist=..., or an owner column (with_owner)")
    return "owner"


def enrich(events: DataFrame, protagonist: str | None = None, *, exact_name: bool = False) -> DataFrame:
    """Classified events -> target, actor, detail, flags and typed details."""
    me = owner_of(events, protagonist)
    # Captures once per row (one regex run per capture group), then plain
    # string operations; a filter on these columns pushed below the
    # projection copies only those cheap operations.
    staged = events.select("*", en.captures().alias(en.CAPTURES))
    parts = staged.select(
        *events.columns,
        en.target().alias("target"),
        en.actor(me).alias("actor"),
        en.detail().alias("detail"),
        en.is_final().alias("is_final"),
        en.detail_name().alias("detail_name"),
        en.detail_qty().alias("detail_qty"),
    )
    return parts.withColumn("is_own", en.is_own(me, exact_name=exact_name))


def build_events(
    lines: DataFrame,
    protagonist: str | None = None,
    *,
    with_match: bool = True,
    by_log: bool = True,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    exact_name: bool = False,
    categories: tuple[str, ...] | None = None,
) -> DataFrame:
    """``lines(log_id, line_no, value)`` -> event table (``EVENT_COLUMNS``).

    ``protagonist`` names the owner of all logs; without it the lines carry an
    ``owner`` column of their own (``with_owner``).

    ``with_match=False`` leaves ``match_id`` null and needs no shuffle.  When
    the lines already carry per-log ``match_id`` (``read_logs`` computes them
    in its numbering pass) they are kept and no second segmentation runs;
    with ``by_log=False`` they are recomputed over all rows in ``line_no``
    order, which needs ``line_no`` to be one order across logs (as in the
    rendered fixture log, or ``read_logs(global_line_no=True)``).

    ``categories`` keeps only events of those categories.  Catalyst cannot
    push such a filter below the match-id window, so it is applied here by
    hand: a row's match id depends only on the start markers before it, so
    only the wanted rows plus the marker rows enter the shuffle (the chunk
    totals still count every marker), and the ids are unchanged.
    """
    owner = ("owner",) if protagonist is None and "owner" in lines.columns else ()
    owner_of(lines, protagonist)
    wanted = None if categories is None else F.col("category").isin(*categories)
    if "match_id" in lines.columns and not (with_match and by_log):
        lines = lines.drop("match_id")  # carried ids are per log: recompute as asked
    if "match_id" in lines.columns:
        framed = frame(lines, keep=("log_id", "line_no", "match_id", *owner))
        ev = enrich(classify_events(framed), protagonist, exact_name=exact_name)
        return (ev if wanted is None else ev.where(wanted)).select(*EVENT_COLUMNS)
    framed = frame(lines, keep=("log_id", "line_no", *owner))
    ev = enrich(classify_events(framed), protagonist, exact_name=exact_name)
    if with_match:
        if wanted is not None:
            ev = ev.where(wanted | (F.col("message") == F.lit(MATCH_START_MESSAGE)))
        # Sizes and chunk totals come from the plain lines: the message regex
        # runs on marker lines only.
        marks = lines.select("log_id", "line_no", is_start_line(F.col("value")).alias("match_id"))
        ev = assign_match_ids(ev, by_log=by_log, chunk_rows=chunk_rows, totals_from=marks)
    else:
        ev = ev.withColumn("match_id", F.lit(None).cast("long"))
    if wanted is not None:
        ev = ev.where(wanted)
    return ev.select(*EVENT_COLUMNS)
