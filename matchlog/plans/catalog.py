"""

Every query reads the driver's tables under ``sf_dir`` (the rendered log
``L`` comes from ``events``, the text operators from ``documents``), so its
work grows with the tables.  Queries return DataFrames; the caller acts.  Most
run nothing before that; those on growing logs, live marts, global ranks and
distinct players write an intermediate table first.  Column names equal the DuckDB oracle's in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import enrich as en
from ..functions.charset import decode_cp1252, encode_single_byte
from ..functions.rule_index import classify_indexed
from ..functions.rules import LOBBY_JOIN_WORDS, LOBBY_LEAVE_WORDS, RULES, Rule, is_match_start
from ..operators import marts, timeline
from ..operators.contract import original_contract
from ..operators.distinct import players_by_everything
from ..operators.events import build_events, classify_events, enrich
from ..operators.framing import filter_chat, frame
from ..operators.funnel import ordered_funnel
from ..operators.intervals import overlap_counts
from ..operators.lines import split_lines
from ..operators.ranking import global_ranks
from ..operators.scan import ordered_scan
from ..operators.segment import assign_match_ids
from ..operators.sessions import sessions
from ..session import scratch_path
from ..sources.fixture import PROTAGONIST, render_log
from ..sources.tables import deal_single_split, read_table
from ..streaming.growing import GrowingLogs, batches_done, start_growing_stream
from ..streaming.live_marts import LiveMarts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Chunk size of the explicitly chunked segmentation query: small on purpose so
# that even the test scale runs many chunks per log.
SMALL_CHUNK_ROWS = 997
# Files in which the growing logs' lines arrive, read in four micro-batches.
ARRIVAL_FILES = 16
SESSION_GAP_SECONDS = 30 * 60


def query(fn: Query | None = None, *, name: str | None = None):
    """Register ``fn`` under ``name`` (default: its own name)."""

    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        return f

    return register(fn) if fn is not None else register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return deal_single_split(read_table(spark, sf_dir, name))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered log ``L``: ``(log_id, line_no, value)``."""
    return render_log(table(spark, sf_dir, "events"))


def events(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return build_events(log_lines(spark, sf_dir), PROTAGONIST, **kw)


def _framed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(log_lines(spark, sf_dir))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_events(_framed(spark, sf_dir))


def _by_category(spark: SparkSession, sf_dir: str, category: str, parts: Callable) -> DataFrame:
    c = _classified(spark, sf_dir).where(F.col("category") == category)
    cols = parts()
    return c.select(F.col("line_no").alias("event_id"), *[v.alias(k) for k, v in cols.items()])


# --- S: sources ---------------------------------------------------------------

@query
def decode_legacy_text(spark, sf_dir):
    """S1: documents as legacy single-byte bytes, decoded as Windows-1252."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", decode_cp1252(encode_single_byte("text")).alias("text"))


@query
def scan_lines(spark, sf_dir):
    """S2: text -> one row per line with its 0-based index."""
    return split_lines(table(spark, sf_dir, "documents"), key="doc_id", text="text")


# --- F / P: framing -----------------------------------------------------------

@query(name="filter_chat")
def filter_chat_lines(spark, sf_dir):
    return filter_chat(log_lines(spark, sf_dir)).select(F.col("line_no").alias("event_id"), "value")


@query
def frame_events(spark, sf_dir):
    return _framed(spark, sf_dir).select(F.col("line_no").alias("event_id"), "event_time", "message")


# --- W: match segmentation ------------------------------------------------------

@query
def mark_match_start(spark, sf_dir):
    f = _framed(spark, sf_dir)
    return f.select(F.col("line_no").alias("event_id"), is_match_start(F.col("message")).alias("is_start"))


@query
def segment_matches_global(spark, sf_dir):
    s = assign_match_ids(_framed(spark, sf_dir), by_log=False, levels=2)
    return s.select(F.col("line_no").alias("event_id"), "match_id")


@query
def segment_matches_per_log(spark, sf_dir):
    s = assign_match_ids(_framed(spark, sf_dir), by_log=True)
    return s.select(F.col("line_no").alias("event_id"), "log_id", "match_id")


@query
def segment_matches_chunked(spark, sf_dir):
    s = assign_match_ids(_framed(spark, sf_dir), by_log=False, chunk_rows=SMALL_CHUNK_ROWS, levels=3)
    return s.select(F.col("line_no").alias("event_id"), "match_id")


# --- C: classification and extraction -------------------------------------------

@query(name="classify_events")
def classify_messages(spark, sf_dir):
    return _classified(spark, sf_dir).select(F.col("line_no").alias("event_id"), "category")


@query
def extract_pvp(spark, sf_dir):
    return _by_category(spark, sf_dir, "pvp", en.pvp_parts)


@query
def extract_beds(spark, sf_dir):
    return _by_category(spark, sf_dir, "bed_destroyed", en.bed_parts)


@query
def extract_teams(spark, sf_dir):
    return _by_category(spark, sf_dir, "team_eliminated", en.team_parts)


@query
def extract_lobby(spark, sf_dir):
    return _by_category(spark, sf_dir, "lobby", en.lobby_parts)


@query
def extract_purchases(spark, sf_dir):
    return _by_category(spark, sf_dir, "purchase", en.purchase_parts)


@query
def extract_pickups(spark, sf_dir):
    return _by_category(spark, sf_dir, "pickup", en.pickup_parts)


@query
def extract_xp(spark, sf_dir):
    return _by_category(spark, sf_dir, "xp", en.xp_parts)


@query
def extract_chat(spark, sf_dir):
    return _by_category(spark, sf_dir, "chat", en.chat_parts)


def _enriched(spark, sf_dir) -> DataFrame:
    return enrich(_classified(spark, sf_dir), PROTAGONIST)


@query
def enrich_target(spark, sf_dir):
    return _enriched(spark, sf_dir).select(F.col("line_no").alias("event_id"), "target")


@query
def enrich_actor(spark, sf_dir):
    return _enriched(spark, sf_dir).select(F.col("line_no").alias("event_id"), "actor")


@query
def enrich_detail(spark, sf_dir):
    return _enriched(spark, sf_dir).select(F.col("line_no").alias("event_id"), "detail")


@query
def flag_final(spark, sf_dir):
    return _enriched(spark, sf_dir).select(F.col("line_no").alias("event_id"), "is_final")


@query
def flag_own(spark, sf_dir):
    return _enriched(spark, sf_dir).select(F.col("line_no").alias("event_id"), "is_own")


@query
def build_event_table(spark, sf_dir):
    return events(spark, sf_dir)


@query
def original_contract_events(spark, sf_dir):
    """P13 with the original column names, labels and detail wording."""
    return original_contract(events(spark, sf_dir))


# --- listings and marts ---------------------------------------------------------

@query
def preview_events(spark, sf_dir):
    return marts.preview(events(spark, sf_dir, with_match=False), 200)


@query
def events_by_match_category(spark, sf_dir):
    return marts.events_by_match_category(events(spark, sf_dir))


@query
def pvp_log(spark, sf_dir):
    return marts.pvp_log(events(spark, sf_dir, categories=("pvp",)))


@query
def protagonist_summary(spark, sf_dir):
    return marts.protagonist_summary(events(spark, sf_dir, with_match=False), PROTAGONIST)


@query
def purchase_log(spark, sf_dir):
    return marts.purchase_log(events(spark, sf_dir, categories=("purchase",)))


@query
def bed_log(spark, sf_dir):
    return marts.bed_log(events(spark, sf_dir, categories=("bed_destroyed",)))


@query
def xp_log(spark, sf_dir):
    return marts.xp_log(events(spark, sf_dir, categories=("xp",)))


@query
def chat_log(spark, sf_dir):
    return marts.chat_log(events(spark, sf_dir, categories=("chat",)))


@query
def top_items(spark, sf_dir):
    return marts.top_items(events(spark, sf_dir, with_match=False))


@query
def event_volume_in_match(spark, sf_dir):
    return marts.event_volume_in_match(events(spark, sf_dir))


@query
def top_killers(spark, sf_dir):
    return marts.top_killers(events(spark, sf_dir, with_match=False))


@query
def pvp_share(spark, sf_dir):
    return marts.pvp_share(events(spark, sf_dir, with_match=False), PROTAGONIST)


@query
def beds_by_team(spark, sf_dir):
    return marts.beds_by_team(events(spark, sf_dir, with_match=False))


@query
def events_by_category(spark, sf_dir):
    return marts.events_by_category(events(spark, sf_dir, with_match=False))


@query
def match_spans(spark, sf_dir):
    return marts.match_spans(events(spark, sf_dir))


@query
def line_funnel(spark, sf_dir):
    return marts.line_funnel(log_lines(spark, sf_dir))


@query
def xp_by_match(spark, sf_dir):
    return marts.xp_by_match(events(spark, sf_dir, categories=("xp",)))


@query
def resources_by_match(spark, sf_dir):
    return marts.resources_by_match(events(spark, sf_dir, categories=("pickup",)))


@query
def kd_by_player(spark, sf_dir):
    return marts.kd_by_player(events(spark, sf_dir, with_match=False))


# --- order and time inside a log --------------------------------------------------

@query
def last_losses(spark, sf_dir):
    """As-of lookup: the last bed loss, elimination and lobby row before each event."""
    return timeline.last_losses(events(spark, sf_dir, with_match=False))


@query
def event_clock(spark, sf_dir):
    """Day-rollover clock and pauses between neighbouring events."""
    return timeline.event_clock(events(spark, sf_dir, with_match=False))


@query
def match_durations(spark, sf_dir):
    return timeline.match_durations(timeline.event_clock(events(spark, sf_dir, with_match=False)))


@query
def player_sessions(spark, sf_dir):
    """Sessions of each player in the events, over half an hour apart."""
    return sessions(table(spark, sf_dir, "events"), SESSION_GAP_SECONDS)


@query
def growing_log_match_ids(spark, sf_dir):
    """W4 on logs that are still written: the lines arrive shuffled, in files
    that a stream reads over several micro-batches."""
    numbered = ordered_scan(log_lines(spark, sf_dir), by=["log_id"], order_by="line_no", sums={"place": F.lit(1)})
    folder = scratch_path(spark, "growing")
    arriving = numbered.select("log_id", F.col("line_no").alias("event_id"), (F.col("place") - 1).alias("line_no"), "value")
    arriving.repartition(ARRIVAL_FILES, F.xxhash64("event_id")).write.parquet(f"{folder}/arriving")
    lines = spark.readStream.schema(arriving.schema).option("maxFilesPerTrigger", ARRIVAL_FILES // 4).parquet(f"{folder}/arriving")
    logs = GrowingLogs(spark, f"{folder}/logs", log_type=arriving.schema["log_id"].dataType.simpleString())
    stream = start_growing_stream(lines, logs, f"{folder}/checkpoint", available_now=True)
    stream.awaitTermination()
    found = logs.numbered(batches_done(stream))
    events_of = spark.read.schema(arriving.schema).parquet(f"{folder}/arriving").select("log_id", "line_no", "event_id")
    return frame(found.join(events_of, ["log_id", "line_no"]), keep=("event_id", "log_id", "match_id")).select("event_id", "log_id", "match_id")


# --- matches in time, ranks, sets -------------------------------------------------

@query
def match_overlaps(spark, sf_dir):
    """How many other matches were played while a match was, by time of events."""
    at = table(spark, sf_dir, "events").select(F.col("event_id").alias("line_no"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    ev = events(spark, sf_dir).select("log_id", "line_no", "match_id").join(at, "line_no")
    spans = ev.groupBy("log_id", "match_id").agg(F.min("at").alias("start"), F.max("at").alias("end"))
    return overlap_counts(spans, ["log_id", "match_id"])


@query
def match_funnel(spark, sf_dir):
    """Ordered funnel: bed loss, then a final kill, then an elimination."""
    return ordered_funnel(events(spark, sf_dir))


@query
def player_ranking(spark, sf_dir):
    """All players by kills: row number, rank, share and decile."""
    players = marts.kd_by_player(events(spark, sf_dir, with_match=False)).select("player", "kills")
    return global_ranks(players, ["kills"], then="player", descending=True, tiles=10)


@query
def distinct_players(spark, sf_dir):
    """Exact distinct players by match and category, rolled up along the lattice."""
    return players_by_everything(events(spark, sf_dir))


def _live(spark, sf_dir) -> tuple[LiveMarts, int]:
    """The events in four batches, cut by line so that matches are spread over
    them; the second is given twice, as after a failure."""
    stored = scratch_path(spark, "events")
    events(spark, sf_dir).write.parquet(stored)
    ev = spark.read.parquet(stored)
    live = LiveMarts(spark, scratch_path(spark, "live-marts"), log_type=ev.schema["log_id"].dataType.simpleString())
    for batch in (0, 1, 1, 2, 3):
        live.add(ev.where(F.pmod(F.floor(F.col("line_no") / 50), F.lit(4)) == batch), batch)
    return live, 4


@query
def live_kd_by_player(spark, sf_dir):
    live, batches = _live(spark, sf_dir)
    return live.kd_by_player(batches)


@query
def live_match_spans(spark, sf_dir):
    live, batches = _live(spark, sf_dir)
    live.compact(2)
    return live.match_spans(batches, compacted=2)


# --- rule packs -------------------------------------------------------------------

def detailed_rules() -> tuple[Rule, ...]:
    """A pack of 241 rules: one per lobby player and direction, one per item and
    level, then the general rules."""
    lobby = [
        Rule(f"{way}{k}", f"lobby:{way}:p{k}", rf"^p{k} {words} \(\d+/\d+\)\.$", starts=f"p{k} {words} (")
        for k in range(100)
        for way, words in (("join", LOBBY_JOIN_WORDS), ("leave", LOBBY_LEAVE_WORDS))
    ]
    items = [
        Rule(f"item{k}.{n}", f"purchase:{k}:{n}", rf"^Você comprou Item {k} \(Nível {n}\)\.$", starts=f"Você comprou Item {k} (Nível {n})")
        for k in range(10)
        for n in range(3)
    ]
    return (*lobby, *items, *RULES)


@query
def classify_indexed_rules(spark, sf_dir):
    """C1 through the rule index: the same categories as the one CASE."""
    return classify_indexed(_framed(spark, sf_dir), RULES).select(F.col("line_no").alias("event_id"), "category")


@query
def classify_rule_pack(spark, sf_dir):
    """A pack of hundreds of rules in one projection."""
    return classify_indexed(_framed(spark, sf_dir), detailed_rules()).select(F.col("line_no").alias("event_id"), "category")


@query
def decode_byte_table(spark, sf_dir):
    """S1 over the whole byte range: each character of the documents, by its code
    modulo 256 as one byte, decoded as Windows-1252, with its count."""
    d = table(spark, sf_dir, "documents").where(F.char_length("text") > 0)
    codes = d.select(F.explode(F.expr("transform(split(text, ''), c -> CAST(ascii(c) % 256 AS INT))")).alias("byte"))
    counts = codes.groupBy("byte").agg(F.count(F.lit(1)).alias("n"))
    byte = F.unhex(F.lpad(F.hex(F.col("byte").cast("long")), 2, "0"))
    return counts.select("byte", decode_cp1252(byte).alias("shown"), "n")
