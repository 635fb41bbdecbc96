"""Helpers and constants of the tests; ``conftest.py`` holds fixtures only, as
every folder of tests may have one of that name."""

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def chat_line(message: str, time: str = "12:00:00") -> str:
    return f"[{time}] [Client thread/INFO]: [CHAT] {message}"


def lines_df(spark, values, log_id=1):
    """``lines(log_id, line_no, value)`` from raw line strings in order."""
    rows = [(log_id, i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "log_id long, line_no long, value string")


def events_of(spark, messages, protagonist="p7", **kw):
    from matchlog.operators.events import build_events

    ev = build_events(lines_df(spark, [chat_line(m) for m in messages]), protagonist, **kw)
    return {r["message"]: r for r in ev.collect()}
