"""Render the driver's ``events`` table as raw client log lines.

The rendered log (one line per ``events`` row, rules in FIXTURES.md section 3)
is the test input of every query: Spark parses the text, while the DuckDB
oracle computes the expected columns straight from the structured table, so
the two sides share no regex.  Rendering is narrow (a projection of each
row), grows linearly with ``events`` and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.once import select_once

PROTAGONIST = "p7"
LOG_THREAD = "] [Client thread/INFO]: "

# Fixed values of the fixture (FIXTURES.md section 3).
TEAM_COLOURS = ("Azul", "Verde", "Ciano", "Rosa")


def _time_of_day_sql(dtype: T.DataType) -> str:
    """``HH:mm:ss`` of ``ts`` independent of the session time zone.

    ``date_format`` on a zone-less timestamp goes through the session zone and
    shifts wall-clock times that fall into a daylight-saving gap; the field
    functions do not.  Session-zone timestamps give their UTC wall clock.
    """
    if isinstance(dtype, T.TimestampNTZType):
        h, m, s = "hour(ts)", "minute(ts)", "second(ts)"
    else:
        day = "pmod(unix_seconds(ts), 86400)"
        h, m, s = f"{day} div 3600", f"({day} div 60) % 60", f"{day} % 60"
    # plain ``concat``: a null clock stays null (and renders as ``[]``)
    return ", ':', ".join(f"lpad(CAST({x} AS STRING), 2, '0')" for x in (h, m, s)).join(("concat(", ")"))


# One SQL expression (parsed once in the JVM) instead of a few hundred
# Column calls: the body of a rendered line, FIXTURES.md section 3.
# ``concat_ws('', ...)`` skips null parts (a missing clock renders as
# ``[]``), so no row is lost to a null field.
_MESSAGE_SQL = """
CASE event_type
  WHEN 'signup' THEN CASE event_id % 5
    WHEN 0 THEN 'O jogo iniciou!'
    WHEN 1 THEN concat_ws('', 'O jogo inicia em ', k, ' segundos!')
    WHEN 2 THEN concat_ws('', 'p', k, ' entrou na sala (', k % 8 + 1, '/8).')
    WHEN 3 THEN concat_ws('', 'p', k, ' saiu da sala (', k % 8 + 1, '/8).')
    ELSE concat_ws('', 'Bem-vindo ao servidor ', k) END
  WHEN 'purchase' THEN CASE WHEN event_id % 4 = 3 THEN 'Você não tem recursos o suficiente.'
    ELSE concat_ws('', 'Você comprou Item ', k % 10, ' (Nível ', k % 3, ').') END
  WHEN 'click' THEN concat_ws('', 
    CASE WHEN k % 10 = 0 THEN 'p7' ELSE concat_ws('', 'u', user_id) END,
    CASE event_id % 5
      WHEN 0 THEN concat_ws('', ' morreu para p', k % 20, '.')
      WHEN 1 THEN concat_ws('', ' morreu no void para p', k % 20, '.')
      WHEN 2 THEN ' morreu no void.'
      WHEN 3 THEN concat_ws('', ' morreu para p', k % 20, '. KILL FINAL!')
      ELSE concat_ws('', ' morreu para p', k % 20, '. PRIMEIRA KILL FINAL!') END)
  WHEN 'view' THEN CASE event_id % 5
    WHEN 0 THEN concat_ws('', '+', k + 1, ' Ferros')
    WHEN 1 THEN concat_ws('', '+', k + 1, ' Ouro')
    WHEN 2 THEN concat_ws('', '+', k + 1, ' XP (Double XP)')
    WHEN 3 THEN concat_ws('', '+', k + 1, ' XP')
    ELSE concat_ws('', 'Você ganhou ', k + 1, ' de XP nessa partida!') END
  WHEN 'error' THEN CASE event_id % 4
    WHEN 0 THEN concat_ws('', 'CAMA DESTRUÍDA » A Cama do ', element_at(array{colours}, int(k % 4) + 1),
                       ' foi destruída por p', k % 20, '.')
    WHEN 1 THEN concat_ws('', 'TIME ELIMINADO » O Time ', element_at(array{colours}, int(k % 4) + 1), ' foi eliminado.')
    WHEN 2 THEN concat_ws('', '[B] [', k, '?] u', user_id, ': gg ', k)
    ELSE concat_ws('', ' - aviso ', k) END
  ELSE concat_ws('', 'evento ', event_type)
END""".replace("{colours}", "(" + ", ".join(f"'{c}'" for c in TEAM_COLOURS) + ")")

_BODY_SQL = f"""
CASE WHEN event_id % 11 = 0 THEN concat_ws('', 'chunk ', k)
     WHEN event_id % 13 = 0 THEN '[CHAT]   '
     ELSE concat_ws('', '[CHAT] ', {_MESSAGE_SQL}) END"""


def render_log(events: DataFrame) -> DataFrame:
    """``events`` -> ``lines(log_id, line_no, value)``; log = user, line = event."""
    staged = events.selectExpr(
        "event_id", "user_id", "event_type", "ts", "try_cast(get_json_object(props, '$.k') AS BIGINT) AS k"
    )
    stamp = _time_of_day_sql(events.schema["ts"].dataType)
    value = F.expr(f"concat_ws('', '[', {stamp}, '{LOG_THREAD}', {_BODY_SQL})")
    return select_once(
        staged,
        [F.col("user_id").alias("log_id"), F.col("event_id").alias("line_no")],
        {"value": value},
    )
