"""Business columns derived from ``category`` and ``message``.

Classify first, extract second: a row's capture groups are extracted by its
own category's regex only, once, into the ``_cap`` struct (``captures``);
the contract columns are string operations on that struct.  The
``*_parts`` functions give the same captures as named columns for the
single-category ``extract_*`` queries.

The columns are generated as SQL text from the rule pack and parsed once in
the JVM (one call per column instead of one per operand).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import (
    FINAL_KILL_PHRASE,
    LOBBY_JOIN_WORDS,
    OWN_ACTION_PREFIX,
    RULE,
    TEAM_ELIMINATED_PHRASE,
    TEAM_TARGET_PREFIX,
    sql_literal,
)

# Labels of the text detail column.
XP_MID_LABEL = " XP (mid-match)"
XP_END_LABEL = " XP (match end)"

MSG = "message"
CAT = "category"


def _g(rule: str, name: str) -> str:
    return RULE[rule].group_sql(name, MSG)


def _blank_to_null(sql: str) -> str:
    return f"nullif({sql}, '')"


def _int(sql: str) -> str:
    # ``cast`` raises under ANSI mode on '' or overflow; the original
    # non-ANSI cast gave null there, so does try_cast.
    return f"try_cast({sql} AS INT)"


def _is(category: str) -> str:
    return f"{CAT} = {sql_literal(category)}"


def _exprs(parts: dict[str, str]) -> dict[str, Column]:
    return {name: F.expr(sql) for name, sql in parts.items()}


# --- single-category extractions (the ``extract_*`` query outputs) ----------

def _xp_value() -> str:
    return _int(f"coalesce({_blank_to_null(_g('xp_mid', 'xp'))}, {_g('xp_end', 'xp')})")


def _lobby_action() -> str:
    return f"CASE WHEN {_g('lobby', 'action')} = {sql_literal(LOBBY_JOIN_WORDS)} THEN 'join' ELSE 'leave' END"


def pvp_parts() -> dict[str, Column]:
    return _exprs(
        {
            "victim": _g("death", "victim"),
            "killer": _blank_to_null(_g("death", "killer")),
            "final_text": _blank_to_null(_g("death", "final_text")),
        }
    )


def bed_parts() -> dict[str, Column]:
    return _exprs({"team": _g("bed", "team"), "breaker": _g("bed", "breaker")})


def team_parts() -> dict[str, Column]:
    return _exprs({"team": _g("team", "team")})


def lobby_parts() -> dict[str, Column]:
    return _exprs(
        {
            "player": _g("lobby", "player"),
            "action": _lobby_action(),
            "cur": _int(_g("lobby", "cur")),
            "max": _int(_g("lobby", "max")),
        }
    )


def purchase_parts() -> dict[str, Column]:
    return _exprs({"item": _g("purchase", "item")})


def pickup_parts() -> dict[str, Column]:
    return _exprs({"qty": _int(_g("pickup", "qty")), "resource": _g("pickup", "resource")})


def xp_parts() -> dict[str, Column]:
    kind = f"CASE WHEN {_g('xp_mid', 'xp')} <> '' THEN 'mid' ELSE 'end' END"
    return _exprs({"xp": _xp_value(), "kind": kind})


def chat_parts() -> dict[str, Column]:
    return _exprs({"speaker": _g("chat", "speaker"), "text": _g("chat", "text")})


# --- contract columns -------------------------------------------------------
#
# Each row's captures are extracted once, by its own category's regex, into
# one struct ``_cap`` (fields g1..g4); the contract columns are then plain
# string operations on those fields.  Extracting inside every column's own
# CASE would run the same regex up to five times per row: common
# subexpression elimination does not reach into different CASE branches.

CAPTURES = "_cap"
_CAPTURE_GROUPS = (
    ("pvp", "death", ("victim", "killer")),
    ("bed_destroyed", "bed", ("team", "breaker")),
    ("team_eliminated", "team", ("team",)),
    ("lobby", "lobby", ("player", "action", "cur", "max")),
    ("purchase", "purchase", ("item",)),
    ("pickup", "pickup", ("qty", "resource")),
)


def _struct(values: list[str]) -> str:
    values = values + ["CAST(NULL AS STRING)"] * (4 - len(values))
    return "named_struct(" + ", ".join(f"'g{i + 1}', {v}" for i, v in enumerate(values)) + ")"


def captures() -> Column:
    """Per-category capture groups as ``struct<g1..g4: string>`` (null for
    categories without captures)."""
    branches = [f"WHEN {_is(cat)} THEN {_struct([_g(rule, f) for f in fields])}" for cat, rule, fields in _CAPTURE_GROUPS]
    branches.append(f"WHEN {_is('xp')} THEN {_struct([_g('xp_mid', 'xp'), _g('xp_end', 'xp')])}")
    return F.expr("CASE " + " ".join(branches) + " END")


def _c(i: int) -> str:
    return f"{CAPTURES}.g{i}"


def target() -> Column:
    """Victim of a death, or ``Time <colour>`` for a destroyed bed."""
    return F.expr(
        f"CASE WHEN {_is('pvp')} THEN {_c(1)} "
        f"WHEN {_is('bed_destroyed')} THEN concat({sql_literal(TEAM_TARGET_PREFIX)}, {_c(1)}) END"
    )


def actor(me: str) -> Column:
    """``me`` is the log owner as SQL text.  Killer, bed breaker, the log owner for economy and XP, lobby player."""
    return F.expr(
        f"CASE WHEN {_is('pvp')} THEN {_blank_to_null(_c(2))} "
        f"WHEN {_is('bed_destroyed')} THEN {_c(2)} "
        f"WHEN {CAT} IN ('purchase', 'pickup', 'xp') THEN {me} "
        f"WHEN {_is('lobby')} THEN {_c(1)} END"
    )


def detail() -> Column:
    """Item; ``<n> x <resource>``; ``<n> XP (...)``; ``<cur>/<max>``."""
    xp = (
        f"coalesce(concat({_blank_to_null(_c(1))}, {sql_literal(XP_MID_LABEL)}), "
        f"concat({_blank_to_null(_c(2))}, {sql_literal(XP_END_LABEL)}))"
    )
    lobby = f"concat(CAST({_int(_c(3))} AS STRING), '/', CAST({_int(_c(4))} AS STRING))"
    return F.expr(
        f"CASE WHEN {_is('purchase')} THEN {_c(1)} "
        f"WHEN {_is('pickup')} THEN concat({_c(1)}, ' x ', {_c(2)}) "
        f"WHEN {_is('xp')} THEN {xp} "
        f"WHEN {_is('lobby')} THEN {lobby} END"
    )


def detail_name() -> Column:
    """Typed companion of ``detail``: the name part."""
    return F.expr(
        f"CASE WHEN {_is('purchase')} THEN {_c(1)} "
        f"WHEN {_is('pickup')} THEN {_c(2)} "
        f"WHEN {_is('xp')} THEN CASE WHEN {_c(1)} <> '' THEN 'mid' ELSE 'end' END "
        f"WHEN {_is('lobby')} THEN CASE WHEN {_c(2)} = {sql_literal(LOBBY_JOIN_WORDS)} THEN 'join' ELSE 'leave' END "
        f"WHEN {CAT} IN ('bed_destroyed', 'team_eliminated') THEN {_c(1)} END"
    )


def detail_qty() -> Column:
    """Typed companion of ``detail``: the quantity part (int)."""
    return F.expr(
        f"CASE WHEN {_is('pickup')} THEN {_int(_c(1))} "
        f"WHEN {_is('xp')} THEN {_int(f'coalesce({_blank_to_null(_c(1))}, {_c(2)})')} "
        f"WHEN {_is('lobby')} THEN {_int(_c(3))} END"
    )


def is_final() -> Column:
    """Final-kill phrase or team-eliminated phrase anywhere in the message."""
    return F.expr(
        f"contains({MSG}, {sql_literal(FINAL_KILL_PHRASE)}) OR contains({MSG}, {sql_literal(TEAM_ELIMINATED_PHRASE)})"
    )


def is_own(me: str, exact_name: bool = False) -> Column:
    """Log owner (``me``, SQL text) involved.  Three-valued on purpose: a null actor or target
    makes the comparison null, and null OR false stays null.

    The default name test is a plain prefix (a player whose name only starts
    with the protagonist's counts too); ``exact_name`` requires a word end.
    """
    if exact_name:
        quoted = f"replace({me}, {sql_literal(chr(92) + 'E')}, {sql_literal(chr(92) + 'E' + chr(92) * 2 + 'E' + chr(92) + 'Q')})"
        name_test = f"{MSG} RLIKE concat({sql_literal('^' + chr(92) + 'Q')}, {quoted}, {sql_literal(chr(92) + 'E(?![' + chr(92) + 'p{L}' + chr(92) + 'p{N}_])')})"
    else:
        name_test = f"startswith({MSG}, {me})"
    return F.expr(
        f"(actor = {me}) OR (target = {me}) OR startswith({MSG}, {sql_literal(OWN_ACTION_PREFIX)}) OR {name_test}"
    )

