"""Sessions by gap against a plain pass; batch and stream agree; late rows."""

import random
from datetime import datetime, timedelta

import pytest

from matchlog.operators.sessions import sessions, streaming_sessions

T0 = datetime(2024, 1, 1)
SCHEMA = "event_id long, user_id string, ts timestamp"


def make_events(seed, n=300):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        player = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None])
        rows.append((i, player, None if rnd.random() < 0.05 else T0 + timedelta(seconds=rnd.randrange(0, 6000, 5))))
    return rows


def brute(rows, gap):
    out = []
    for player in {r[1] for r in rows}:
        times = sorted(r[2] for r in rows if r[1] == player and r[2] is not None)
        own = []
        for t in times:
            if own and (t - own[-1][1]).total_seconds() <= gap:
                own[-1][1:] = [t, own[-1][2] + 1]
            else:
                own.append([t, t, 1])
        out += [(str(player), k, *s) for k, s in enumerate(own)]
    return sorted(out)


@pytest.mark.parametrize("chunk_rows", [1, 7, 50, 1 << 18])
def test_sessions_against_a_plain_pass(spark, chunk_rows):
    rows = make_events(chunk_rows)
    found = sessions(spark.createDataFrame(rows, SCHEMA), 60, chunk_rows=chunk_rows).collect()
    assert sorted((str(r.player), r.session, r.first_ts, r.last_ts, r.n) for r in found) == brute(rows, 60)
    assert all(r.seconds == (r.last_ts - r.first_ts).total_seconds() for r in found)


def test_exact_gap_joins_and_empty_input(spark):
    rows = [(1, "a", T0), (2, "a", T0 + timedelta(seconds=61)), (3, "a", T0 + timedelta(seconds=121)), (4, "a", T0 + timedelta(seconds=121))]
    found = sessions(spark.createDataFrame(rows, SCHEMA), 60).collect()
    assert sorted((r.session, r.n) for r in found) == [(0, 1), (1, 3)]
    assert sessions(spark.createDataFrame([], SCHEMA), 60).count() == 0
    with pytest.raises(ValueError):
        sessions(spark.createDataFrame([], SCHEMA), 0)


def run_stream(spark, folder, batches, gap, delay):
    source, out, checkpoint = (str(folder / d) for d in ("in", "out", "checkpoint"))
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        events = spark.readStream.schema(SCHEMA).parquet(source)
        writer = streaming_sessions(events, gap, delay).writeStream.format("parquet").outputMode("append")
        writer.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination(120)
    return sorted((str(r.player), r.first_ts, r.last_ts, r.n) for r in spark.read.parquet(out).collect())


def test_stream_equals_batch_where_no_row_is_too_late(spark, tmp_path):
    rows = [r for r in make_events(5, n=120) if r[2] is not None]
    rnd = random.Random(3)
    # Rows arrive up to 200 seconds late, less than the allowed delay.
    rows.sort(key=lambda r: r[2] + timedelta(seconds=rnd.randrange(200)))
    end = [(10_000 + i, "end", T0 + timedelta(days=1 + i)) for i in range(2)]  # moves the watermark on
    got = run_stream(spark, tmp_path, [rows[:60], rows[60:], end[:1], end[1:]], 60, 300)
    batch = [(p, a, b, n) for p, _, a, b, n in brute(rows, 60)]
    assert [r for r in got if r[0] != "end"] == sorted(batch)


def test_late_rows_are_dropped_once_their_session_is_out(spark, tmp_path):
    at = lambda s: T0 + timedelta(seconds=s)
    first = [(1, "a", at(0)), (2, "a", at(30)), (3, "b", at(1000))]
    # The watermark is 1000 - 100 = 900: a's session ended at 90.  The row of 20 is
    # too late; the one of 880 (880 + 60 > 900) is not.
    late = [(4, "a", at(20)), (5, "c", at(880))]
    end = [[(6, "end", at(9000))], [(7, "end", at(99000))]]
    got = run_stream(spark, tmp_path, [first, late, *end], 60, 100)
    assert [r for r in got if r[0] != "end"] == [("a", at(0), at(30), 2), ("b", at(1000), at(1000), 1), ("c", at(880), at(880), 1)]
