"""The original nine-column output contract, for users switching over.

``build_events`` speaks English codes (``pvp``, ``detail`` ...).  Existing
dashboards and CSV consumers of the original job expect its Portuguese
column names, category labels and detail wording; ``original_contract``
renames and relabels with built-in expressions (a ``CASE`` over ten labels,
no join, no UDF).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The original output contract.  Column names in output order,
# then category labels (our code -> label), then the XP detail wording.
# ---------------------------------------------------------------------------
ORIGINAL_COLUMNS = (
    ("match_id", "match_id"),
    ("event_time", "hora"),
    ("message", "mensagem_limpa"),
    ("category", "categoria_evento"),
    ("target", "jogador_alvo"),
    ("actor", "jogador_agressor_ou_ator"),
    ("detail", "item_ou_recurso"),
    ("is_final", "is_kill_final"),
    ("is_own", "is_minha_acao"),
)
ORIGINAL_CATEGORY_LABELS = (
    ("match_start", "Início de Partida"),
    ("bed_destroyed", "Cama Destruída"),
    ("team_eliminated", "Time Eliminado"),
    ("pvp", "PvP"),
    ("lobby", "Sala/Lobby"),
    ("purchase", "Economia/Compra"),
    ("pickup", "Economia/Coleta"),
    ("xp", "Progressão/XP"),
    ("chat", "Chat/Toxicidade"),
    ("system", "Sistema"),
)
ORIGINAL_XP_MID = " XP (mid-game)"
ORIGINAL_XP_END = " XP (fim de partida)"
# ---------------------------------------------------------------------------


def original_contract(ev: DataFrame, *, keep_provenance: bool = True) -> DataFrame:
    """Event table -> the original nine columns (plus ``log_id``/``line_no``)."""
    cat = F.col("category")
    label = None
    for code, text in ORIGINAL_CATEGORY_LABELS:
        label = F.when(cat == code, F.lit(text)) if label is None else label.when(cat == code, F.lit(text))
    # The XP digits stay as written in the log; only the wording changes.
    xp_suffix = F.when(F.col("detail_name") == "mid", F.lit(ORIGINAL_XP_MID)).otherwise(F.lit(ORIGINAL_XP_END))
    detail = F.when(cat == "xp", F.concat(F.regexp_extract("detail", r"^(\d+) XP", 1), xp_suffix)).otherwise(
        F.col("detail")
    )
    values = {
        "category": label.otherwise(cat),
        "detail": detail,
    }
    cols = [(values.get(src, F.col(src))).alias(dst) for src, dst in ORIGINAL_COLUMNS]
    prov = [F.col("log_id"), F.col("line_no")] if keep_provenance else []
    return ev.select(*prov, *cols)
