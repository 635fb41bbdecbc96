"""Text logs on disk: bytes, line ends, several files and splits."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from matchlog.functions.charset import decode_cp1252, encode_single_byte
from matchlog.sources.logs import read_logs


def test_decode_all_256_bytes(spark):
    raw = bytes(range(256))
    df = spark.createDataFrame([(bytearray(raw),)], "b binary")
    got = df.select(decode_cp1252("b").alias("t")).collect()[0].t
    assert got == raw.decode("cp1252", errors="replace")
    assert got[0x81 - 0] == "�" and got[0x80] == "€" and got[0x9F] == "Ÿ"


def test_encode_single_byte_round_trip(spark):
    df = spark.createDataFrame([("ação » Í",), ("ĀB",)], "t string")
    got = [r.t for r in df.select(decode_cp1252(encode_single_byte("t")).alias("t")).collect()]
    assert got == ["ação » Í", "?B"]


@pytest.fixture()
def log_dir():
    d = tempfile.mkdtemp(prefix="matchlog-logs-")
    big = "".join(f"[12:00:{i % 60:02d}] [Client thread/INFO]: [CHAT] linha {i} ação\r\n" for i in range(3000))
    with open(os.path.join(d, "a.log"), "wb") as f:
        f.write(big.encode("cp1252"))
    small = "[00:00:01] [x]: [CHAT] Você comprou Espada.\n\x80 \x81\r[CHAT] CAMA DESTRUÍDA\n"
    with open(os.path.join(d, "b.log"), "wb") as f:
        f.write(small.encode("cp1252", errors="strict") if "\x81" not in small else small.encode("latin-1"))
    return d


@pytest.mark.parametrize("chunk_rows,levels", [(7, 1), (7, 2), (1 << 18, 1)])
def test_read_logs_orders_lines_across_splits(spark, log_dir, chunk_rows, levels):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = read_logs(spark, log_dir, chunk_rows=chunk_rows, levels=levels)
        rows = lines.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    a = sorted((r.line_no, r.value) for r in rows if r.log_id.endswith("a.log"))
    assert [ln for ln, _ in a] == list(range(3000))
    assert all(v.endswith(f"linha {i} ação") for i, v in a)
    b = sorted((r.line_no, r.value) for r in rows if r.log_id.endswith("b.log"))
    assert [v for _, v in b] == ["[00:00:01] [x]: [CHAT] Você comprou Espada.", "€ �", "[CHAT] CAMA DESTRUÍDA"]


def test_split_count_is_really_several(spark, log_dir):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        n = spark.read.text(log_dir).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert n > 10


def test_utf8_logs(spark, tmp_path):
    p = tmp_path / "u.log"
    p.write_text("[01:02:03] [t]: [CHAT] Você ganhou 5 de XP nessa partida!\n", encoding="utf-8")
    rows = read_logs(spark, str(p), charset="utf-8").collect()
    assert rows[0].value.endswith("Você ganhou 5 de XP nessa partida!") and rows[0].line_no == 0


def test_end_to_end_from_files(spark, log_dir):
    from matchlog.operators.events import build_events

    ev = build_events(read_logs(spark, log_dir), "p7")
    cats = {r.category: r["count"] for r in ev.groupBy("category").count().collect()}
    assert cats["purchase"] == 1 and cats["system"] == 3001
    assert ev.where(F.col("match_id") != 0).count() == 0


def test_match_ids_in_the_read_pass_equal_segmentation(spark, tmp_path):
    from matchlog.operators.events import build_events

    body = []
    for i in range(2500):
        msg = "O jogo iniciou!" if i % 97 == 5 else ("[CHAT]   " if i % 13 == 0 else f"linha {i}")
        body.append(f"[12:00:00] [t]: [CHAT] {msg}" if not msg.startswith("[CHAT]") else msg)
        if i % 11 == 0:
            body.append(f"[12:00:00] [t]: [CHAT]  O jogo iniciou!  ")  # marker with blanks: still a marker
    (tmp_path / "m.log").write_bytes(("\n".join(body) + "\n").encode("cp1252"))
    (tmp_path / "n.log").write_bytes("[CHAT] O jogo iniciou!\r\nx\r\n[CHAT] y\r\n".encode("cp1252"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        one = build_events(read_logs(spark, str(tmp_path), with_match_ids=True, chunk_rows=5), "p7")
        two = build_events(read_logs(spark, str(tmp_path), with_match_ids=False), "p7", chunk_rows=50)
        a = sorted((r.log_id, r.line_no, r.match_id) for r in one.collect())
        b = sorted((r.log_id, r.line_no, r.match_id) for r in two.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert a == b
    assert max(m for _, _, m in a) > 20


def test_split_lines_like_a_file_reader(spark):
    from matchlog.operators.lines import split_lines

    texts = {1: "", 2: "a", 3: "a\n", 4: "a\n\n", 5: "\n", 6: "a\r\nb\rc\nd", 7: "a\r\n", 8: None}
    df = spark.createDataFrame(list(texts.items()), "k long, t string")
    got = {}
    for r in split_lines(df, key="k", text="t").collect():
        got.setdefault(r.k, []).append((r.line_idx, r.line))
    assert got == {
        2: [(0, "a")],
        3: [(0, "a")],
        4: [(0, "a"), (1, "")],
        5: [(0, "")],
        6: [(0, "a"), (1, "b"), (2, "c"), (3, "d")],
        7: [(0, "a")],
    }


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_fixture_clock_ignores_session_zone(spark, zone):
    import datetime as dt

    from matchlog.sources.fixture import render_log

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [(1, dt.datetime(2024, 3, 10, 2, 30, 15), 3, "view", 1.0, '{"k": 4}')]
        ntz = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
        (r,) = render_log(ntz).collect()
        assert r.value.startswith("[02:30:15] ")
        aware = dt.datetime(2024, 1, 5, 23, 59, 58, tzinfo=dt.timezone.utc)
        ltz = spark.createDataFrame(
            [(1, aware, 3, "view", 1.0, '{"k": 4}')],
            "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
        )
        (r,) = render_log(ltz).collect()
        assert r.value.startswith("[23:59:58] ")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_global_numbering_recomputes_carried_ids(spark, tmp_path):
    from pyspark.sql import functions as F

    from matchlog.operators.events import build_events

    (tmp_path / "a.log").write_bytes("[CHAT] O jogo iniciou!\n[CHAT] oi\n[CHAT] O jogo iniciou!\n".encode("cp1252"))
    lines = read_logs(spark, str(tmp_path))
    assert "match_id" in lines.columns
    # carried ids replaced: a recomputed global numbering with a shifted order
    shifted = lines.withColumn("line_no", F.col("line_no") + 1000)
    glob = sorted((r.line_no, r.match_id) for r in build_events(shifted, "p7", by_log=False).collect())
    assert glob == [(1000, 1), (1001, 1), (1002, 2)]
    assert build_events(lines, "p7", with_match=False).where("match_id is not null").count() == 0


def test_fixture_render_keeps_rows_with_nulls(spark):
    from matchlog.operators.framing import frame
    from matchlog.sources.fixture import render_log

    rows = [(3, None, 5, "view", 1.0, '{"k": 4}'), (8, None, 5, "view", 1.0, None)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    lines = render_log(df).orderBy("line_no").collect()
    assert [r.value for r in lines] == ["[] [Client thread/INFO]: [CHAT] +5 XP", "[] [Client thread/INFO]: [CHAT] + XP"]
    assert [(r.event_time, r.message) for r in frame(render_log(df)).orderBy("line_no").collect()] == [("", "+5 XP"), ("", "+ XP")]


@pytest.mark.parametrize("levels", [1, 2])
def test_global_line_numbers_across_files(spark, tmp_path, levels):
    from matchlog.operators.events import build_events

    (tmp_path / "a.log").write_bytes("[CHAT] O jogo iniciou!\n[CHAT] oi\n".encode("cp1252"))
    (tmp_path / "b.log").write_bytes("[CHAT] O jogo iniciou!\n[CHAT] oi\nx\n".encode("cp1252"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    try:
        lines = read_logs(spark, str(tmp_path), global_line_no=True, chunk_rows=1, levels=levels)
        got = sorted((r.line_no, r.log_id.rsplit("/", 1)[-1]) for r in lines.collect())
        ev = sorted((r.line_no, r.match_id) for r in build_events(lines, "p7", by_log=False).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert "match_id" not in lines.columns
    assert got == [(0, "a.log"), (1, "a.log"), (2, "b.log"), (3, "b.log"), (4, "b.log")]
    assert ev == [(0, 1), (1, 1), (2, 2), (3, 2)]


def test_a_table_is_listed_anew_at_every_read(spark, tmp_path):
    from matchlog.sources.tables import read_table

    rows = spark.range(5)
    rows.write.parquet(str(tmp_path / "t.parquet"))
    assert read_table(spark, str(tmp_path), "t").count() == 5
    rows.write.mode("append").parquet(str(tmp_path / "t.parquet"))
    assert read_table(spark, str(tmp_path), "t").count() == 10


def test_literal_names(spark, tmp_path):
    for name in ("a[1].log", "a1.log", "a [1].log"):
        (tmp_path / name).write_text(f"[CHAT] {name}\n")
    got = read_logs(spark, [str(tmp_path / "a[1].log"), str(tmp_path / "a [1].log")], literal=True).collect()
    assert sorted(r.value for r in got) == ["[CHAT] a [1].log", "[CHAT] a[1].log"]
    assert [r.value for r in read_logs(spark, str(tmp_path / "a[1].log")).collect()] == ["[CHAT] a1.log"]


def test_scans_that_are_split_differently_raise(spark, log_dir):
    """Totals from a scan with another split layout: an error, not fewer rows."""
    from pyspark.errors import PySparkException

    from matchlog.operators.segment import running_totals

    def scan(split):
        value = F.col("id")
        return spark.range(0, 1000, 1, 4).select(value.alias("_pos"), F.floor(value / split).alias("_split"))

    chunk = F.struct(F.col("_split").alias("split"), F.expr("_pos div 50").alias("run"))
    how = {"order_by": "_pos", "sums": {"n": F.lit(1)}, "chunk": chunk, "checked": True}
    same = running_totals(scan(100), totals_from=scan(100).withColumn("n", F.lit(1)), **how)
    assert sorted((r["_pos"], r["n"]) for r in same.collect()) == [(i, i + 1) for i in range(1000)]
    for other in (scan(70), scan(100).where("_pos < 900"), scan(100).where("_pos % 97 <> 5")):
        with pytest.raises(PySparkException, match="different chunks"):
            running_totals(scan(100), totals_from=other.withColumn("n", F.lit(1)), **how).collect()
