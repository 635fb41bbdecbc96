"""Analytics over the event table.  Each mart is ``DataFrame -> DataFrame``.

Aggregates use Spark's partial + final hash aggregation, so a hot group (one
player, one team) is pre-combined on the map side before the shuffle.
Several counts over one table are one conditional aggregate (one pass), not
several actions.  Top-k is ``orderBy().limit()`` (a bounded per-task heap).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import framing as fr
from ..functions.rules import MATCH_START_MESSAGE
from .events import with_owner


def _cat() -> Column:
    return F.col("category")


def _ratio(num: Column, den: Column) -> Column:
    """num / den as double, null when den is 0 (no infinity, no error)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


# --- listings ---------------------------------------------------------------

def preview(ev: DataFrame, n: int = 200) -> DataFrame:
    """First ``n`` events in line order (a bounded top-n, not a collect)."""
    return ev.select("log_id", "line_no", "message", "category").orderBy("log_id", "line_no").limit(n)


def pvp_log(ev: DataFrame) -> DataFrame:
    return ev.where(_cat() == "pvp").select(
        "log_id", "line_no", "match_id", "event_time", "target", "actor", "is_final", "message"
    )


def purchase_log(ev: DataFrame) -> DataFrame:
    return ev.where(_cat() == "purchase").select("log_id", "line_no", "match_id", "event_time", "detail")


def bed_log(ev: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Destroyed beds in chronological (line) order; ``ordered=False`` leaves
    the rows as they come, for storage."""
    beds = ev.where(_cat() == "bed_destroyed").select(
        "log_id", "line_no", "match_id", "event_time", "target", "actor", "message"
    )
    return beds.orderBy("log_id", "line_no") if ordered else beds


def xp_log(ev: DataFrame) -> DataFrame:
    """XP rows of the protagonist; ``is_own`` null counts as not own."""
    return ev.where((_cat() == "xp") & F.col("is_own")).select("log_id", "line_no", "match_id", "event_time", "detail")


def chat_log(ev: DataFrame) -> DataFrame:
    return ev.where(_cat() == "chat").select("log_id", "line_no", "match_id", "event_time", "message")


# --- aggregates -------------------------------------------------------------

def events_by_match_category(ev: DataFrame, *, ordered: bool = True) -> DataFrame:
    counts = ev.groupBy("log_id", "match_id", "category").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("log_id", "match_id", F.desc("n"), "category") if ordered else counts


def _me(protagonist: str | DataFrame, ev: DataFrame) -> tuple[DataFrame, Column]:
    """One name for all logs, or ``owners(log_id, owner)``."""
    if isinstance(protagonist, str):
        return ev, F.lit(protagonist)
    return with_owner(ev, protagonist), F.col("owner")


def protagonist_summary(ev: DataFrame, protagonist: str | DataFrame) -> DataFrame:
    """Kills, deaths, final kills and K/D of the log owners in one pass."""
    ev, me = _me(protagonist, ev.where(_cat() == "pvp"))
    counts = ev.agg(
        F.count_if(F.col("actor") == me).alias("kills"),
        F.count_if(F.col("target") == me).alias("deaths"),
        F.count_if((F.col("actor") == me) & F.col("is_final")).alias("final_kills"),
    )
    return counts.withColumn("kd_ratio", _ratio(F.col("kills"), F.col("deaths")))


def pvp_share(ev: DataFrame, protagonist: str | DataFrame) -> DataFrame:
    """Kills against deaths with percentage shares (two rows)."""
    s = protagonist_summary(ev, protagonist)
    total = F.col("kills") + F.col("deaths")
    rows = s.select(
        F.explode(
            F.array(
                F.struct(F.lit("kills").alias("label"), F.col("kills").alias("n")),
                F.struct(F.lit("deaths").alias("label"), F.col("deaths").alias("n")),
            )
        ).alias("r"),
        total.alias("_total"),
    )
    return rows.select(
        F.col("r.label").alias("label"),
        F.col("r.n").alias("n"),
        _ratio(F.col("r.n") * F.lit(100.0), F.col("_total")).alias("pct"),
    )


def top_items(ev: DataFrame, k: int = 5) -> DataFrame:
    return (
        ev.where((_cat() == "purchase") & F.col("detail").isNotNull())
        .groupBy("detail")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "detail")
        .limit(k)
    )


def event_volume_in_match(ev: DataFrame) -> DataFrame:
    """Events per category inside matches (lobby rows, match 0, left out)."""
    return ev.where(F.col("match_id") > 0).groupBy("category").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "category")


def top_killers(ev: DataFrame, k: int = 5) -> DataFrame:
    return (
        ev.where((_cat() == "pvp") & F.col("actor").isNotNull())
        .groupBy(F.col("actor").alias("player"))
        .agg(F.count(F.lit(1)).alias("kills"))
        .orderBy(F.desc("kills"), "player")
        .limit(k)
    )


def beds_by_team(ev: DataFrame) -> DataFrame:
    return (
        ev.where((_cat() == "bed_destroyed") & F.col("target").isNotNull())
        .groupBy(F.col("target").alias("team"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "team")
    )


def events_by_category(ev: DataFrame) -> DataFrame:
    """Events per category plus a grand-total row (``category`` null).

    Counted first, so the rollup doubles a row per category, not every event."""
    return ev.groupBy("category").agg(F.count(F.lit(1)).alias("n")).rollup("category").agg(F.sum("n").alias("n"))


def match_spans(ev: DataFrame) -> DataFrame:
    """Events per match with first and last time by line order (midnight safe).

    Times are carried as numbers (``hhmmss``, -1 for a line without a time):
    fixed width keeps the aggregate on the hash path before the shuffle."""
    per = ev.select("log_id", "match_id", "line_no", clock_number().alias("clock")).groupBy("log_id", "match_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("clock", "line_no").alias("first"),
        F.max_by("clock", "line_no").alias("last"),
    )
    return span_times(per)


def clock_number() -> Column:
    """``event_time`` as ``hhmmss``, -1 for a line without a time."""
    return F.when(F.col("event_time") == "", -1).otherwise(F.translate("event_time", ":", "").cast("int"))


def span_times(spans: DataFrame) -> DataFrame:
    """``(log_id, match_id, n, first, last)`` with the clock numbers as text."""
    return spans.select("log_id", "match_id", "n", _clock_text("first").alias("first_time"), _clock_text("last").alias("last_time"))


def _clock_text(name: str) -> Column:
    digits = F.lpad(F.col(name).cast("string"), 6, "0")
    text = F.concat_ws(":", *[F.substring(digits, k, 2) for k in (1, 3, 5)])
    return F.when(F.col(name) >= 0, text).when(F.col(name) == -1, F.lit(""))


def line_funnel(lines: DataFrame) -> DataFrame:
    """Lines, chat lines, events and matches in one pass over the lines.

    Every match id above 0 is opened by exactly one start marker, so the
    number of matches is the number of start-marker events.
    """
    v = F.col("value")
    chat = fr.is_chat_line(v)
    msg = F.when(chat, fr.message(v))
    return lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(chat).alias("chat_lines"),
        F.count_if(F.length(msg) > 0).alias("events"),
        F.count_if(msg == F.lit(MATCH_START_MESSAGE)).alias("matches"),
    )


def xp_by_match(ev: DataFrame) -> DataFrame:
    """XP summed per match, mid-match gains and end-of-match totals apart."""
    qty, kind = F.col("detail_qty"), F.col("detail_name")
    return (
        ev.where(_cat() == "xp")
        .groupBy("log_id", "match_id")
        .agg(
            F.sum(F.when(kind == "mid", qty)).alias("xp_mid"),
            F.sum(F.when(kind == "end", qty)).alias("xp_end"),
        )
    )


def resources_by_match(ev: DataFrame) -> DataFrame:
    return (
        ev.where(_cat() == "pickup")
        .groupBy("log_id", "match_id", F.col("detail_name").alias("resource"))
        .agg(F.sum("detail_qty").alias("qty"))
    )


def kd_by_player(ev: DataFrame) -> DataFrame:
    """Kills, deaths, final kills and K/D for every player.

    Each PvP row becomes two (player, role) rows with ``explode`` (one pass,
    no union, no join), then one partially pre-aggregated ``groupBy``.
    """
    roles = ev.where(_cat() == "pvp").select(
        F.explode(
            F.array(
                F.struct(F.col("actor").alias("player"), F.lit(True).alias("killer"), F.col("is_final").alias("fin")),
                F.struct(F.col("target").alias("player"), F.lit(False).alias("killer"), F.lit(False).alias("fin")),
            )
        ).alias("r")
    )
    per = (
        roles.where(F.col("r.player").isNotNull())
        .groupBy(F.col("r.player").alias("player"))
        .agg(
            F.count_if(F.col("r.killer")).alias("kills"),
            F.count_if(~F.col("r.killer")).alias("deaths"),
            F.count_if(F.col("r.killer") & F.col("r.fin")).alias("final_kills"),
        )
    )
    return per.withColumn("kd_ratio", _ratio(F.col("kills"), F.col("deaths")))
