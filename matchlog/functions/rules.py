"""The rule pack: how a chat message is recognised and what it carries.

A rule is data (category, literal guard, regex, named groups).  ``classify``
turns the ordered rule list into one ``CASE WHEN`` expression: the first rule
whose pattern matches wins, the fallback category is ``system``.  Priority is
semantic -- a chat line quoting a death sentence is a ``pvp`` event because the
death rule comes first -- so the order must never be changed for speed.

Each rule may carry a cheap literal ``guard`` (``startswith`` or ``contains``)
implied by its regex.  The guard is tested first; the regex only runs on rows
that pass it, which keeps the common "system" rows on the codegen fast path.

All regexes are Java regexes evaluated by ``rlike`` (find semantics) and
``regexp_extract`` (empty string when there is no match).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The game server's chat wording (the input format).  These
# strings and patterns must stay exactly as they are for results to match the
# logs the server writes.  Listed in rule priority order.
# ---------------------------------------------------------------------------
CHAT_TAG = "[CHAT]"
TIME_OF_DAY_PATTERN = r"^\[(\d\d:\d\d:\d\d)\]"
MESSAGE_PATTERN = r"\[CHAT\]\s*(.+)$"

MATCH_START_MESSAGE = "O jogo iniciou!"
COUNTDOWN_PATTERN = r"^O jogo inicia em \d+"
BED_PATTERN = r"^CAMA DESTRU[IÍ]DA\s+»\s+A Cama do (.+?) foi destru[ií]da por (.+?)\.$"
TEAM_PATTERN = r"^TIME ELIMINADO\s+»\s+O Time (.+?) foi eliminado\.$"
DEATH_PATTERN = r"^(.+?) morreu(?:\s+no void)?(?:\s+para\s+(.+?))?\.(?:\s*((?:PRIMEIRA\s+)?KILL FINAL!))?"
LOBBY_PATTERN = r"^(.+?) (entrou na sala|saiu da sala) \((\d+)/(\d+)\)\.$"
PURCHASE_PATTERN = r"^Você comprou (.+?)\.$"
PICKUP_PATTERN = r"^\+(\d+)\s+(?!XP)([A-Za-zÀ-ÿ]+)$"
XP_MID_PATTERN = r"^\+(\d+)\s+XP"
XP_END_PATTERN = r"^Você ganhou (\d+) de XP nessa partida!$"
CHAT_PATTERN = r"^\[B\]\s+\[.+?\]\s+(.+?):\s+(.+)$"

LOBBY_JOIN_WORDS = "entrou na sala"
LOBBY_LEAVE_WORDS = "saiu da sala"
FINAL_KILL_PHRASE = "KILL FINAL!"
TEAM_ELIMINATED_PHRASE = "TIME ELIMINADO"
OWN_ACTION_PREFIX = "Você"
TEAM_TARGET_PREFIX = "Time "
# ---------------------------------------------------------------------------

FALLBACK_CATEGORY = "system"

CATEGORIES = (
    "match_start",
    "bed_destroyed",
    "team_eliminated",
    "pvp",
    "lobby",
    "purchase",
    "pickup",
    "xp",
    "chat",
    FALLBACK_CATEGORY,
)


@dataclass(frozen=True)
class Rule:
    """One recognisable message shape.

    ``equals`` makes the rule an exact string comparison; otherwise
    ``pattern`` is a regex.  ``starts``/``contains`` are literal guards that
    every match of the pattern satisfies; they are tested before the regex.
    """

    name: str
    category: str
    pattern: str | None = None
    groups: tuple[str, ...] = field(default=())
    equals: str | None = None
    starts: str | None = None
    contains: str | None = None

    def matches_sql(self, message: str) -> str:
        """The same test as SQL text over the SQL expression ``message``."""
        if self.equals is not None:
            return f"{message} = {sql_literal(self.equals)}"
        tests = []
        if self.starts is not None:
            tests.append(f"startswith({message}, {sql_literal(self.starts)})")
        if self.contains is not None:
            tests.append(f"contains({message}, {sql_literal(self.contains)})")
        tests.append(f"{message} RLIKE {sql_literal(self.pattern)}")
        return " AND ".join(tests)

    def group_sql(self, name: str, message: str = "message") -> str:
        """Capture group by name as SQL text (``''`` when there is no match)."""
        return f"regexp_extract({message}, {sql_literal(self.pattern)}, {self.groups.index(name) + 1})"


RULES: tuple[Rule, ...] = (
    Rule("start", "match_start", equals=MATCH_START_MESSAGE),
    Rule("countdown", "match_start", COUNTDOWN_PATTERN, starts="O jogo inicia em "),
    Rule("bed", "bed_destroyed", BED_PATTERN, ("team", "breaker"), starts="CAMA DESTRU"),
    Rule("team", "team_eliminated", TEAM_PATTERN, ("team",), starts="TIME ELIMINADO"),
    Rule("death", "pvp", DEATH_PATTERN, ("victim", "killer", "final_text"), contains=" morreu"),
    Rule("lobby", "lobby", LOBBY_PATTERN, ("player", "action", "cur", "max"), contains=" sala ("),
    Rule("purchase", "purchase", PURCHASE_PATTERN, ("item",), starts="Você comprou "),
    Rule("pickup", "pickup", PICKUP_PATTERN, ("qty", "resource"), starts="+"),
    Rule("xp_mid", "xp", XP_MID_PATTERN, ("xp",), starts="+"),
    Rule("xp_end", "xp", XP_END_PATTERN, ("xp",), starts="Você ganhou "),
    Rule("chat", "chat", CHAT_PATTERN, ("speaker", "text"), starts="[B]"),
)

RULE = {r.name: r for r in RULES}


def sql_literal(s: str) -> str:
    """A constant Spark SQL expression holding exactly ``s``, whatever the
    session's ``escapedStringLiterals`` says: backslashes and quotes are given
    by their codes, so no literal holds one."""
    parts = [f"char({ord(part)})" if part in ("\\", "'") else f"'{part}'" for part in re.split(r"([\\'])", s) if part]
    return f"concat({', '.join(parts)})" if len(parts) > 1 else (parts or ["''"])[0]


def classify_sql(message: str = "message", rules: tuple[Rule, ...] = RULES) -> str:
    """Ordered first-match-wins classification as SQL ``CASE`` text."""
    branches = " ".join(f"WHEN {r.matches_sql(message)} THEN {sql_literal(r.category)}" for r in rules)
    return f"CASE {branches} ELSE {sql_literal(FALLBACK_CATEGORY)} END"


def classify(message: str = "message", rules: tuple[Rule, ...] = RULES) -> Column:
    """Ordered first-match-wins classification as one CASE expression.

    Generated as SQL text and parsed once in the JVM: one call instead of
    one per rule operand.
    """
    return F.expr(classify_sql(f"`{message}`", rules))


def is_match_start(message: Column) -> Column:
    """1 for the exact start marker, else 0 (``null`` only for a null message)."""
    return (message == F.lit(MATCH_START_MESSAGE)).cast("int")
