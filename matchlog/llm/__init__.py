"""Operators of a training-data pipeline over large corpora.

Nothing else in the library imports this subpackage; ``QUERIES`` and
``ORACLE_SQL`` are added to the registry when it can be imported.
"""

from .queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
