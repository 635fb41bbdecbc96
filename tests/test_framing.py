"""Line framing: time, message, blank and non-chat lines."""

from helpers import lines_df

from matchlog.operators.framing import frame


def framed(spark, values):
    return [(r.line_no, r.event_time, r.message) for r in frame(lines_df(spark, values)).orderBy("line_no").collect()]


def test_time_and_message(spark):
    out = framed(spark, ["[23:59:59] [Client thread/INFO]: [CHAT]  - aviso 1"])
    assert out == [(0, "23:59:59", "- aviso 1")]


def test_no_leading_time(spark):
    assert framed(spark, ["[x] [CHAT] oi"]) == [(0, "", "oi")]


def test_blank_and_non_chat_lines_dropped(spark):
    out = framed(spark, ["[CHAT]", "[CHAT]   ", "[12:00:00] [Client thread/INFO]: chunk 3", "[CHAT] ok"])
    assert out == [(3, "", "ok")]


def test_tabs_survive_trim_spaces_do_not(spark):
    # \s after the tag eats the tab; trim inside strips spaces only.
    out = framed(spark, ["[CHAT]\tab \t"])
    assert out == [(0, "", "ab \t")]


def test_first_tag_wins(spark):
    assert framed(spark, ["[CHAT] a [CHAT] b"]) == [(0, "", "a [CHAT] b")]


def test_next_line_character_ends_the_message(spark):
    # Java's '.' does not cross U+0085: the extraction fails, the line is dropped.
    assert framed(spark, ["[CHAT] a\u0085b"]) == []
