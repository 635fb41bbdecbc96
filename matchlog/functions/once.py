"""Compute expensive columns once per row.

Catalyst pushes a filter below a projection by copying the defining
expression of every column the filter reads.  For the regex-heavy columns of
this engine (the message, the category ``CASE`` over eleven rules) that means
running the same regexes again for each pushed filter, and one generated
class that grows with every copy.

A column produced by a generator is different: a filter on a generator's
output stays above it.  ``select_once`` therefore emits the expensive columns
from ``inline`` over a one-element array -- exactly one output row per input
row, codegen supported, no shuffle -- so they are evaluated once and later
filters test the stored value.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_once(df: DataFrame, keep: Iterable[str], columns: Mapping[str, Column]) -> DataFrame:
    """``select(*keep, *columns)`` with ``columns`` materialised per row."""
    packed = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    return df.select(*keep, F.inline(F.array(packed)))
