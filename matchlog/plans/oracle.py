"""Independent DuckDB oracle for every registered query.

The engine parses the rendered log text with the rule pack; this oracle
derives the expected columns straight from the structured ``events`` table
by arithmetic on ``event_id``, ``event_type`` and ``k`` (FIXTURES.md section
3), so the two sides share no regex.  Output column names equal the Spark
queries'; integer sums and counts are cast to BIGINT like Spark's.
"""

from __future__ import annotations

_LINES = r"""
src AS (
  SELECT event_id, user_id, event_type, ts,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
shaped AS (
  SELECT *, event_id % 5 AS s5, event_id % 4 AS s4,
         CASE WHEN k % 10 = 0 THEN 'p7' ELSE concat('u', user_id) END AS vict,
         concat('p', k % 20) AS kil,
         CASE k % 4 WHEN 0 THEN 'Azul' WHEN 1 THEN 'Verde' WHEN 2 THEN 'Ciano' ELSE 'Rosa' END AS colour
  FROM src
),
rendered AS (
  SELECT *,
    CASE event_type
      WHEN 'signup' THEN CASE s5
        WHEN 0 THEN 'O jogo iniciou!'
        WHEN 1 THEN concat('O jogo inicia em ', k, ' segundos!')
        WHEN 2 THEN concat('p', k, ' entrou na sala (', k % 8 + 1, '/8).')
        WHEN 3 THEN concat('p', k, ' saiu da sala (', k % 8 + 1, '/8).')
        ELSE concat('Bem-vindo ao servidor ', k) END
      WHEN 'purchase' THEN CASE WHEN s4 = 3 THEN 'Você não tem recursos o suficiente.'
        ELSE concat('Você comprou Item ', k % 10, ' (Nível ', k % 3, ').') END
      WHEN 'click' THEN concat(vict, CASE s5
        WHEN 0 THEN concat(' morreu para ', kil, '.')
        WHEN 1 THEN concat(' morreu no void para ', kil, '.')
        WHEN 2 THEN ' morreu no void.'
        WHEN 3 THEN concat(' morreu para ', kil, '. KILL FINAL!')
        ELSE concat(' morreu para ', kil, '. PRIMEIRA KILL FINAL!') END)
      WHEN 'view' THEN CASE s5
        WHEN 0 THEN concat('+', k + 1, ' Ferros')
        WHEN 1 THEN concat('+', k + 1, ' Ouro')
        WHEN 2 THEN concat('+', k + 1, ' XP (Double XP)')
        WHEN 3 THEN concat('+', k + 1, ' XP')
        ELSE concat('Você ganhou ', k + 1, ' de XP nessa partida!') END
      WHEN 'error' THEN CASE s4
        WHEN 0 THEN concat('CAMA DESTRUÍDA » A Cama do ', colour, ' foi destruída por ', kil, '.')
        WHEN 1 THEN concat('TIME ELIMINADO » O Time ', colour, ' foi eliminado.')
        WHEN 2 THEN concat('[B] [', k, '?] u', user_id, ': gg ', k)
        ELSE concat(' - aviso ', k) END
      ELSE concat('evento ', event_type)
    END AS chat_text
  FROM shaped
),
lines AS (
  SELECT *, user_id AS log_id, event_id AS line_no,
    coalesce(strftime(ts, '%H:%M:%S'), '') AS event_time,
    concat('[', strftime(ts, '%H:%M:%S'), '] [Client thread/INFO]: ',
           CASE WHEN event_id % 11 = 0 THEN concat('chunk ', k)
                WHEN event_id % 13 = 0 THEN '[CHAT]   '
                ELSE concat('[CHAT] ', chat_text) END) AS value,
    event_id % 11 <> 0 AS is_chat,
    event_id % 11 <> 0 AND event_id % 13 <> 0 AS is_event,
    trim(chat_text, ' ') AS message
  FROM rendered
),
classified AS (
  SELECT *,
    CASE event_type
      WHEN 'signup' THEN CASE WHEN s5 IN (0, 1) THEN 'match_start' WHEN s5 IN (2, 3) THEN 'lobby' ELSE 'system' END
      WHEN 'purchase' THEN CASE WHEN s4 = 3 THEN 'system' ELSE 'purchase' END
      WHEN 'click' THEN 'pvp'
      WHEN 'view' THEN CASE WHEN s5 IN (0, 1) THEN 'pickup' ELSE 'xp' END
      WHEN 'error' THEN CASE s4 WHEN 0 THEN 'bed_destroyed' WHEN 1 THEN 'team_eliminated' WHEN 2 THEN 'chat' ELSE 'system' END
      ELSE 'system'
    END AS category,
    CAST(CASE WHEN event_type = 'signup' AND s5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_start
  FROM lines WHERE is_event
),
parts AS (
  SELECT *,
    CASE category WHEN 'pvp' THEN vict WHEN 'bed_destroyed' THEN concat('Time ', colour) END AS target,
    CASE category
      WHEN 'pvp' THEN CASE WHEN s5 = 2 THEN NULL ELSE kil END
      WHEN 'bed_destroyed' THEN kil
      WHEN 'purchase' THEN 'p7' WHEN 'pickup' THEN 'p7' WHEN 'xp' THEN 'p7'
      WHEN 'lobby' THEN concat('p', k)
    END AS actor,
    CASE category
      WHEN 'purchase' THEN concat('Item ', k % 10, ' (Nível ', k % 3, ')')
      WHEN 'pickup' THEN concat(k + 1, ' x ', CASE s5 WHEN 0 THEN 'Ferros' ELSE 'Ouro' END)
      WHEN 'xp' THEN concat(k + 1, CASE WHEN s5 = 4 THEN ' XP (match end)' ELSE ' XP (mid-match)' END)
      WHEN 'lobby' THEN concat(k % 8 + 1, '/8')
    END AS detail,
    (category = 'pvp' AND s5 IN (3, 4)) OR category = 'team_eliminated' AS is_final,
    CASE category
      WHEN 'purchase' THEN concat('Item ', k % 10, ' (Nível ', k % 3, ')')
      WHEN 'pickup' THEN CASE s5 WHEN 0 THEN 'Ferros' ELSE 'Ouro' END
      WHEN 'xp' THEN CASE WHEN s5 = 4 THEN 'end' ELSE 'mid' END
      WHEN 'lobby' THEN CASE s5 WHEN 2 THEN 'join' ELSE 'leave' END
      WHEN 'bed_destroyed' THEN colour
      WHEN 'team_eliminated' THEN colour
    END AS detail_name,
    CAST(CASE category
      WHEN 'pickup' THEN k + 1 WHEN 'xp' THEN k + 1 WHEN 'lobby' THEN k % 8 + 1
    END AS INTEGER) AS detail_qty
  FROM classified
),
ev AS (
  SELECT *,
    (actor = 'p7') OR (target = 'p7') OR starts_with(message, 'Você') OR starts_with(message, 'p7') AS is_own,
    CAST(SUM(is_start) OVER (PARTITION BY log_id ORDER BY line_no
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS match_id
  FROM parts
)"""


# Time of day from the structured timestamp; a day ends where it runs back.
_CLOCK = """
, t AS (
  SELECT log_id, line_no, match_id, category, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS secs FROM ev
),
c AS (
  SELECT *, lag(secs) OVER w AS was, lead(secs) OVER w AS comes,
         lag(secs) OVER (PARTITION BY log_id, match_id ORDER BY line_no) AS was_in_match
  FROM t WINDOW w AS (PARTITION BY log_id ORDER BY line_no)
),
k AS (
  SELECT *, CAST(sum(CASE WHEN secs < was THEN 1 ELSE 0 END) OVER (PARTITION BY log_id ORDER BY line_no
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS day
  FROM c
),
clock AS (
  SELECT log_id, line_no, match_id, category, day, CAST(day * 86400 + secs AS BIGINT) AS clock,
         CAST((secs - was + 86400) % 86400 AS BIGINT) AS pause_before, CAST((comes - secs + 86400) % 86400 AS BIGINT) AS pause_after,
         CAST((secs - was_in_match + 86400) % 86400 AS BIGINT) AS pause_in_match
  FROM k
)"""


def _last_of(alias: str, category: str) -> str:
    return (
        f"ASOF LEFT JOIN (SELECT * FROM ev WHERE category = '{category}') {alias} "
        f"ON e.log_id = {alias}.log_id AND e.match_id = {alias}.match_id AND e.line_no > {alias}.line_no"
    )


def _on_events(select: str) -> str:
    return "WITH " + _LINES.strip() + "\n" + select.strip()


_EVENT_TABLE = (
    "log_id, line_no, match_id, event_time, message, category, target, actor, detail, "
    "is_final, is_own, detail_name, detail_qty"
)

_DOC_LINES = r"""
WITH p AS (SELECT doc_id, string_split_regex(text, '\r\n|\r|\n') AS parts FROM documents),
x AS (SELECT doc_id, len(parts) AS n, generate_subscripts(parts, 1) AS i, unnest(parts) AS line FROM p)
SELECT doc_id, CAST(i - 1 AS BIGINT) AS line_idx, line FROM x WHERE NOT (i = n AND line = '')
"""


# What Windows-1252 shows for the bytes 0x80 to 0x9F, written out
# here by hand so that the oracle shares no table with the engine.
_WINDOWS_1252 = "€\ufffd‚ƒ„…†‡ˆ‰Š‹Œ\ufffdŽ\ufffd\ufffd‘’“”•–—˜™š›œ\ufffdžŸ"


def _decode_sql() -> str:
    controls = " || ".join(f"chr({c})" for c in range(0x80, 0xA0))
    return (
        "SELECT doc_id, translate(regexp_replace(text, '[^\\x00-\\xFF]', '?', 'g'), "
        f"{controls}, '{_WINDOWS_1252}') AS text FROM documents"
    )


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {
        "decode_legacy_text": _decode_sql(),
        "scan_lines": _DOC_LINES.strip(),
        "filter_chat": _on_events("SELECT event_id, value FROM lines WHERE is_chat"),
        "frame_events": _on_events("SELECT event_id, event_time, message FROM ev"),
        "mark_match_start": _on_events("SELECT event_id, is_start FROM ev"),
        "segment_matches_per_log": _on_events("SELECT event_id, log_id, match_id FROM ev"),
        "classify_events": _on_events("SELECT event_id, category FROM ev"),
        "extract_pvp": _on_events(
            "SELECT event_id, vict AS victim, CASE WHEN s5 = 2 THEN NULL ELSE kil END AS killer, "
            "CASE s5 WHEN 3 THEN 'KILL FINAL!' WHEN 4 THEN 'PRIMEIRA KILL FINAL!' END AS final_text "
            "FROM ev WHERE category = 'pvp'"
        ),
        "extract_beds": _on_events("SELECT event_id, colour AS team, kil AS breaker FROM ev WHERE category = 'bed_destroyed'"),
        "extract_teams": _on_events("SELECT event_id, colour AS team FROM ev WHERE category = 'team_eliminated'"),
        "extract_lobby": _on_events(
            "SELECT event_id, concat('p', k) AS player, CASE s5 WHEN 2 THEN 'join' ELSE 'leave' END AS action, "
            "CAST(k % 8 + 1 AS INTEGER) AS cur, CAST(8 AS INTEGER) AS max FROM ev WHERE category = 'lobby'"
        ),
        "extract_purchases": _on_events(
            "SELECT event_id, concat('Item ', k % 10, ' (Nível ', k % 3, ')') AS item FROM ev WHERE category = 'purchase'"
        ),
        "extract_pickups": _on_events(
            "SELECT event_id, CAST(k + 1 AS INTEGER) AS qty, CASE s5 WHEN 0 THEN 'Ferros' ELSE 'Ouro' END AS resource "
            "FROM ev WHERE category = 'pickup'"
        ),
        "extract_xp": _on_events(
            "SELECT event_id, CAST(k + 1 AS INTEGER) AS xp, CASE WHEN s5 = 4 THEN 'end' ELSE 'mid' END AS kind "
            "FROM ev WHERE category = 'xp'"
        ),
        "extract_chat": _on_events(
            "SELECT event_id, concat('u', user_id) AS speaker, concat('gg ', k) AS text FROM ev WHERE category = 'chat'"
        ),
        "enrich_target": _on_events("SELECT event_id, target FROM ev"),
        "enrich_actor": _on_events("SELECT event_id, actor FROM ev"),
        "enrich_detail": _on_events("SELECT event_id, detail FROM ev"),
        "flag_final": _on_events("SELECT event_id, is_final FROM ev"),
        "flag_own": _on_events("SELECT event_id, is_own FROM ev"),
        "build_event_table": _on_events(f"SELECT {_EVENT_TABLE} FROM ev"),
        "original_contract_events": _on_events(
            """
            SELECT log_id, line_no, match_id, event_time AS hora, message AS mensagem_limpa,
              CASE category
                WHEN 'match_start' THEN 'Início de Partida' WHEN 'bed_destroyed' THEN 'Cama Destruída'
                WHEN 'team_eliminated' THEN 'Time Eliminado' WHEN 'pvp' THEN 'PvP'
                WHEN 'lobby' THEN 'Sala/Lobby' WHEN 'purchase' THEN 'Economia/Compra'
                WHEN 'pickup' THEN 'Economia/Coleta' WHEN 'xp' THEN 'Progressão/XP'
                WHEN 'chat' THEN 'Chat/Toxicidade' ELSE 'Sistema' END AS categoria_evento,
              target AS jogador_alvo, actor AS jogador_agressor_ou_ator,
              CASE WHEN category = 'xp' THEN concat(k + 1, CASE WHEN s5 = 4 THEN ' XP (fim de partida)'
                   ELSE ' XP (mid-game)' END) ELSE detail END AS item_ou_recurso,
              is_final AS is_kill_final, is_own AS is_minha_acao
            FROM ev"""
        ),
        "preview_events": _on_events(
            "SELECT log_id, line_no, message, category FROM ev ORDER BY log_id, line_no LIMIT 200"
        ),
        "events_by_match_category": _on_events(
            "SELECT log_id, match_id, category, COUNT(*) AS n FROM ev GROUP BY log_id, match_id, category"
        ),
        "pvp_log": _on_events(
            "SELECT log_id, line_no, match_id, event_time, target, actor, is_final, message FROM ev WHERE category = 'pvp'"
        ),
        "protagonist_summary": _on_events(
            """
            , c AS (
              SELECT CAST(count_if(actor = 'p7') AS BIGINT) AS kills,
                     CAST(count_if(target = 'p7') AS BIGINT) AS deaths,
                     CAST(count_if(actor = 'p7' AND is_final) AS BIGINT) AS final_kills
              FROM ev WHERE category = 'pvp')
            SELECT kills, deaths, final_kills,
                   CASE WHEN deaths = 0 THEN NULL ELSE CAST(kills AS DOUBLE) / CAST(deaths AS DOUBLE) END AS kd_ratio
            FROM c"""
        ),
        "purchase_log": _on_events(
            "SELECT log_id, line_no, match_id, event_time, detail FROM ev WHERE category = 'purchase'"
        ),
        "bed_log": _on_events(
            "SELECT log_id, line_no, match_id, event_time, target, actor, message FROM ev "
            "WHERE category = 'bed_destroyed' ORDER BY log_id, line_no"
        ),
        "xp_log": _on_events(
            "SELECT log_id, line_no, match_id, event_time, detail FROM ev WHERE category = 'xp' AND is_own"
        ),
        "chat_log": _on_events("SELECT log_id, line_no, match_id, event_time, message FROM ev WHERE category = 'chat'"),
        "top_items": _on_events(
            "SELECT detail, COUNT(*) AS n FROM ev WHERE category = 'purchase' AND detail IS NOT NULL "
            "GROUP BY detail ORDER BY n DESC, detail LIMIT 5"
        ),
        "event_volume_in_match": _on_events(
            "SELECT category, COUNT(*) AS n FROM ev WHERE match_id > 0 GROUP BY category"
        ),
        "top_killers": _on_events(
            "SELECT actor AS player, COUNT(*) AS kills FROM ev WHERE category = 'pvp' AND actor IS NOT NULL "
            "GROUP BY actor ORDER BY kills DESC, player LIMIT 5"
        ),
        "pvp_share": _on_events(
            """
            , c AS (
              SELECT CAST(count_if(actor = 'p7') AS BIGINT) AS kills,
                     CAST(count_if(target = 'p7') AS BIGINT) AS deaths
              FROM ev WHERE category = 'pvp'),
            r AS (
              SELECT 'kills' AS label, kills AS n, kills + deaths AS total FROM c
              UNION ALL SELECT 'deaths', deaths, kills + deaths FROM c)
            SELECT label, n,
                   CASE WHEN total = 0 THEN NULL ELSE CAST(n AS DOUBLE) * 100.0 / CAST(total AS DOUBLE) END AS pct
            FROM r"""
        ),
        "beds_by_team": _on_events(
            "SELECT target AS team, COUNT(*) AS n FROM ev WHERE category = 'bed_destroyed' AND target IS NOT NULL "
            "GROUP BY target"
        ),
        "events_by_category": _on_events("SELECT category, COUNT(*) AS n FROM ev GROUP BY ROLLUP (category)"),
        "match_spans": _on_events(
            "SELECT log_id, match_id, COUNT(*) AS n, arg_min(event_time, line_no) AS first_time, "
            "arg_max(event_time, line_no) AS last_time FROM ev GROUP BY log_id, match_id"
        ),
        "line_funnel": _on_events(
            "SELECT CAST(COUNT(*) AS BIGINT) AS lines, CAST(count_if(is_chat) AS BIGINT) AS chat_lines, "
            "CAST(count_if(is_event) AS BIGINT) AS events, "
            "CAST(count_if(is_event AND event_type = 'signup' AND s5 = 0) AS BIGINT) AS matches FROM lines"
        ),
        "xp_by_match": _on_events(
            "SELECT log_id, match_id, CAST(SUM(CASE WHEN detail_name = 'mid' THEN detail_qty END) AS BIGINT) AS xp_mid, "
            "CAST(SUM(CASE WHEN detail_name = 'end' THEN detail_qty END) AS BIGINT) AS xp_end "
            "FROM ev WHERE category = 'xp' GROUP BY log_id, match_id"
        ),
        "resources_by_match": _on_events(
            "SELECT log_id, match_id, detail_name AS resource, CAST(SUM(detail_qty) AS BIGINT) AS qty "
            "FROM ev WHERE category = 'pickup' GROUP BY log_id, match_id, detail_name"
        ),
        "kd_by_player": _on_events(
            """
            , roles AS (
              SELECT actor AS player, TRUE AS killer, is_final AS fin FROM ev WHERE category = 'pvp'
              UNION ALL SELECT target, FALSE, FALSE FROM ev WHERE category = 'pvp'),
            c AS (
              SELECT player, CAST(count_if(killer) AS BIGINT) AS kills,
                     CAST(count_if(NOT killer) AS BIGINT) AS deaths,
                     CAST(count_if(killer AND fin) AS BIGINT) AS final_kills
              FROM roles WHERE player IS NOT NULL GROUP BY player)
            SELECT player, kills, deaths, final_kills,
                   CASE WHEN deaths = 0 THEN NULL ELSE CAST(kills AS DOUBLE) / CAST(deaths AS DOUBLE) END AS kd_ratio
            FROM c"""
        ),
    }
    q["last_losses"] = _on_events(
        "SELECT e.log_id, e.line_no, e.match_id, e.category, b.line_no AS bed_line, b.target AS bed_team, "
        "t.line_no AS team_line, t.detail_name AS team_out, l.line_no AS lobby_line, l.actor AS lobby_player FROM ev e "
        + " ".join([_last_of("b", "bed_destroyed"), _last_of("t", "team_eliminated"), _last_of("l", "lobby")])
    )
    q["event_clock"] = _on_events(_CLOCK + " SELECT * FROM clock")
    q["match_durations"] = _on_events(
        _CLOCK + " SELECT log_id, match_id, COUNT(*) AS events, min(day) AS first_day, max(clock) - min(clock) AS seconds, "
        "max(pause_in_match) AS longest_pause FROM clock GROUP BY log_id, match_id"
    )
    q["growing_log_match_ids"] = q["segment_matches_per_log"]
    q["player_sessions"] = """
        WITH g AS (
          SELECT user_id, event_id, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS apart
          FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
        ),
        s AS (SELECT *, CAST(sum(apart) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM g)
        SELECT user_id AS player, session, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n,
               epoch_us(max(ts) - min(ts)) / 1000000 AS seconds
        FROM s GROUP BY user_id, session"""
    q["live_kd_by_player"] = q["kd_by_player"]
    q["live_match_spans"] = q["match_spans"]
    q["match_overlaps"] = _on_events(
        """
        , m AS (SELECT log_id, match_id, min(ts) AS s, max(ts) AS e FROM ev GROUP BY log_id, match_id)
        SELECT a.log_id, a.match_id, CAST(COUNT(*) - 1 AS BIGINT) AS overlaps
        FROM m a JOIN m b ON a.s <= b.e AND b.s <= a.e GROUP BY a.log_id, a.match_id"""
    )
    q["match_funnel"] = _on_events(
        """
        , b AS (SELECT log_id, match_id, min(CASE WHEN category = 'bed_destroyed' THEN line_no END) AS bed_line FROM ev GROUP BY ALL),
        f AS (SELECT b.*, (SELECT min(line_no) FROM ev e WHERE e.log_id = b.log_id AND e.match_id = b.match_id
                AND e.category = 'pvp' AND e.is_final AND e.line_no > b.bed_line) AS final_line FROM b),
        o AS (SELECT f.*, (SELECT min(line_no) FROM ev e WHERE e.log_id = f.log_id AND e.match_id = f.match_id
                AND e.category = 'team_eliminated' AND e.line_no > f.final_line) AS out_line FROM f)
        SELECT *, CAST(CASE WHEN out_line IS NOT NULL THEN 3 WHEN final_line IS NOT NULL THEN 2 WHEN bed_line IS NOT NULL THEN 1
               ELSE 0 END AS INTEGER) AS steps_done FROM o"""
    )
    q["player_ranking"] = (
        "SELECT player, kills, row_number() OVER w AS row_number, rank() OVER (ORDER BY kills DESC) AS rank, "
        "percent_rank() OVER (ORDER BY kills DESC) AS percent_rank, ntile(10) OVER w AS tile "
        f"FROM ({q['kd_by_player']}) WINDOW w AS (ORDER BY kills DESC, player)"
    )
    q["distinct_players"] = _on_events(
        """
        , p AS (
          SELECT log_id, match_id, category, actor AS player FROM ev WHERE actor IS NOT NULL
          UNION ALL SELECT log_id, match_id, category, target FROM ev WHERE category = 'pvp' AND target IS NOT NULL)
        SELECT log_id, match_id, category,
               CASE grouping_id(log_id, match_id, category) WHEN 0 THEN 'log_id,match_id,category' WHEN 1 THEN 'log_id,match_id'
                 WHEN 2 THEN 'log_id,category' WHEN 3 THEN 'log_id' WHEN 6 THEN 'category' ELSE '' END AS level,
               COUNT(DISTINCT player) AS n
        FROM p GROUP BY GROUPING SETS ((log_id, match_id, category), (log_id, match_id), (log_id, category), (log_id), (category), ())"""
    )
    q["classify_indexed_rules"] = q["classify_events"]
    q["classify_rule_pack"] = _on_events(
        "SELECT event_id, CASE category WHEN 'lobby' THEN concat('lobby:', CASE s5 WHEN 2 THEN 'join' ELSE 'leave' END, ':p', k) "
        "WHEN 'purchase' THEN concat('purchase:', k % 10, ':', k % 3) ELSE category END AS category FROM ev"
    )
    q["decode_byte_table"] = f"""
        WITH c AS (SELECT unnest(string_split(text, '')) AS c FROM documents WHERE length(text) > 0),
        b AS (SELECT CAST(ord(c) % 256 AS INTEGER) AS byte, count(*) AS n FROM c GROUP BY 1)
        SELECT byte, CASE WHEN byte BETWEEN 128 AND 159 THEN '{_WINDOWS_1252}'[byte - 127] ELSE chr(byte) END AS shown, n FROM b"""
    global_ids = (
        "SELECT event_id, CAST(SUM(is_start) OVER (ORDER BY line_no "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS match_id FROM ev"
    )
    q["segment_matches_global"] = _on_events(global_ids)
    q["segment_matches_chunked"] = _on_events(global_ids)
    return q
