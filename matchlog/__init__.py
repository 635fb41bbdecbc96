"""matchlog: game-client chat logs to analytic tables on Spark (see README.md)."""

from .operators.events import build_events
from .sources.logs import read_logs

__all__ = ["build_events", "read_logs"]
