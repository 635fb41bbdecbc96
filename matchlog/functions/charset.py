"""Legacy single-byte text (Windows-1252) decoded with built-in expressions.

Spark 4 only accepts the standard JVM charsets in ``decode`` unless legacy
flags are switched on, and even then undefined bytes raise.  Windows-1252
equals ISO-8859-1 everywhere except 0x80-0x9F, so we decode as ISO-8859-1
(one code point per byte, total) and then ``translate`` those 32 code points
to the Windows-1252 glyphs.  Bytes that Windows-1252 leaves undefined become
U+FFFD, as a Python ``errors="replace"`` decode would give.

Everything stays a JVM expression: no UDF, no temp file, works per row on
any partition of any file.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Built from the codec tables of the Python runtime, not typed by hand.
_HIGH_CONTROL_BYTES = bytes(range(0x80, 0xA0))
LATIN1_HIGH_CONTROLS = _HIGH_CONTROL_BYTES.decode("latin-1")
CP1252_HIGH_GLYPHS = _HIGH_CONTROL_BYTES.decode("cp1252", errors="replace")


def decode_cp1252(raw: Column | str) -> Column:
    """Binary column of Windows-1252 bytes -> string column."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    return F.translate(F.decode(raw, "ISO-8859-1"), LATIN1_HIGH_CONTROLS, CP1252_HIGH_GLYPHS)


def encode_single_byte(text: Column | str) -> Column:
    """String column -> one byte per character (ISO-8859-1).

    Characters outside U+0000..U+00FF are written as ``?`` first, which is
    what a legacy single-byte writer with replacement does; the cast can then
    never fail under ANSI mode.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.encode(F.regexp_replace(text, "[^\\x{00}-\\x{FF}]", "?"), "ISO-8859-1")
