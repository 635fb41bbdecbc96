"""The incremental ETL equals the batch ETL and never repeats a file."""

import os
import tempfile

from matchlog.operators.events import build_events
from matchlog.sources.logs import read_logs
from matchlog.streaming.ingest import start_event_stream


def _log(path, messages):
    text = "".join(f"[10:00:{i:02d}] [Client thread/INFO]: [CHAT] {m}\r\n" for i, m in enumerate(messages))
    with open(path, "wb") as f:
        f.write(text.encode("cp1252"))


def test_stream_matches_batch_and_is_incremental(spark):
    root = tempfile.mkdtemp(prefix="matchlog-stream-")
    logs, out, ckpt = (os.path.join(root, d) for d in ("logs", "out", "ckpt"))
    os.makedirs(logs)
    _log(os.path.join(logs, "a.log"), ["oi", "O jogo iniciou!", "ana morreu para p7.", "O jogo iniciou!", "+3 Ouro"])
    _log(os.path.join(logs, "b.log"), ["Você comprou Lã.", "O jogo iniciou!", "TIME ELIMINADO » O Time Rosa foi eliminado."])

    start_event_stream(spark, logs, out, ckpt, protagonist="p7", available_now=True, max_files_per_trigger=1).awaitTermination(120)
    got = spark.read.parquet(out)
    cols = ["log_id", "line_no", "match_id", "category", "actor", "detail"]
    batch = build_events(read_logs(spark, logs), "p7")
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))
    assert got.select("batch_id").distinct().count() == 2  # one file per trigger

    _log(os.path.join(logs, "c.log"), ["O jogo iniciou!", "bob morreu no void."])
    start_event_stream(spark, logs, out, ckpt, protagonist="p7", available_now=True).awaitTermination(120)
    again = spark.read.parquet(out)
    assert again.count() == batch.count() + 2
    assert again.where("log_id like '%c.log'").select("match_id").distinct().collect()[0].match_id == 1


def test_file_names_are_taken_literally(spark, tmp_path):
    """Names with pattern characters are read once each, and only they are."""
    logs, out, ckpt = (str(tmp_path / d) for d in ("logs", "out", "ckpt"))
    os.makedirs(logs)
    for name, text in (("a[1].log", "um"), ("a1.log", "dois"), ("a [1].log", "tres"), ("b{x,y}.log", "quatro"), ("bx.log", "cinco")):
        _log(os.path.join(logs, name), [text])
    start_event_stream(spark, logs, out, ckpt, protagonist="p7", available_now=True, max_files_per_trigger=2).awaitTermination(120)
    got = sorted(r.message for r in spark.read.parquet(out).select("message").collect())
    assert got == sorted(["um", "dois", "tres", "quatro", "cinco"])


def test_stream_keeps_marts_up_to_date(spark, tmp_path):
    from matchlog.operators import marts
    from matchlog.streaming.live_marts import LiveMarts

    logs, out, ckpt = (str(tmp_path / d) for d in ("logs", "out", "ckpt"))
    os.makedirs(logs)
    live = LiveMarts(spark, str(tmp_path / "live"))
    for k, name in enumerate(("a.log", "b.log")):
        _log(os.path.join(logs, name), ["O jogo iniciou!", "ana morreu para p7.", "p7 morreu para bob.", f"+{k + 1} Ouro", "+5 XP"])
        start_event_stream(spark, logs, out, ckpt, protagonist="p7", available_now=True, live=live).awaitTermination(120)
    ev = spark.read.parquet(out)
    for name in ("kd_by_player", "match_spans", "resources_by_match", "xp_by_match"):
        whole = getattr(marts, name)(ev)
        mine = getattr(live, name)(2).select(*whole.columns)
        assert mine.exceptAll(whole).isEmpty() and whole.exceptAll(mine).isEmpty(), name
