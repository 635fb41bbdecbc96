"""Ordered first-match classification with packs of hundreds of rules.

``rules.classify`` tests every rule's guard in one ``CASE``; with hundreds of rules
the generated code outgrows what is compiled and every message meets every guard.
Here each rule is filed under one literal that any message it matches must hold: a
whole word, the start of a word, or the first character.  The literals are a flat
trie: a message looks up its words, their prefixes of the lengths in use and its
first character in an array of buckets (by CRC-32), which yields the few rules that
can match.  Those are tried in order of their numbers, guard first, then regex, so
the result is that of the ``CASE``.  A rule without such a literal is always tried.

All of it is one projection of built-in functions: no join, no shuffle, no Python.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import FALLBACK_CATEGORY, Rule, sql_literal

# Words are runs of letters and digits.
_WORD = r"[^\W_]+"
_GAPS = r"[^\\p{L}\\p{N}]+"


def literal_keys(rule: Rule) -> list[str]:
    """The keys under which a rule may be filed: ``=word`` for a whole word,
    ``*start`` for the start of one, ``^c`` for the first character."""
    keys = []
    for text, whole, first in ((rule.equals, True, True), (rule.starts, False, True), (rule.contains, False, False)):
        if not text or not text.isascii() and any(_doubtful(c) for c in text):
            continue
        for m in re.finditer(_WORD, text):
            if m.start() == 0 and not first:
                continue  # the word may begin earlier
            ends = m.end() < len(text) or whole
            keys.append(("=" if ends else "*") + m.group())
        if first:
            keys.append("^" + text[0])
    return keys


def _doubtful(c: str) -> bool:
    """Characters that Python and Java may sort differently into words: all
    beyond Latin letters, and numbers that are no digits."""
    return not (c.isascii() or c.isalpha() and ord(c) < 0x250) and c.isalnum()


def file_rules(rules: Sequence[Rule]) -> tuple[dict[str, list[int]], list[int]]:
    """Rule numbers by key, each rule under its key that fewest rules share (of
    those the longest), and the rules that have none."""
    shared = Counter(k for r in rules for k in set(literal_keys(r)))
    filed: dict[str, list[int]] = {}
    always = []
    for number, rule in enumerate(rules):
        keys = literal_keys(rule)
        if keys:
            filed.setdefault(min(keys, key=lambda k: (shared[k], -len(k), k)), []).append(number)
        else:
            always.append(number)
    return filed, always


def _array(items: Sequence[str], kind: str) -> str:
    return f"CAST(array({', '.join(items)}) AS array<{kind}>)"


def candidates_sql(message: str, rules: Sequence[Rule]) -> str:
    """SQL of the ascending numbers of the rules that can match ``message``."""
    filed, always = file_rules(rules)
    size = max(1, 4 * len(filed))
    buckets: list[list[int]] = [[] for _ in range(size)]
    for key, numbers in filed.items():
        buckets[crc32(key.encode()) % size].extend(numbers)
    table = _array([_array([str(n) for n in b], "int") for b in buckets], "array<int>")
    words = f"filter(split({message}, '{_GAPS}'), w -> w <> '')"
    keys = [f"transform({words}, w -> concat('=', w))"]
    keys += [f"transform({words}, w -> concat('*', substring(w, 1, {n})))" for n in sorted({len(k) - 1 for k in filed if k[0] == "*"})]
    keys.append(f"array(concat('^', substring({message}, 1, 1)))")
    found = f"flatten(transform(concat({', '.join(keys)}), k -> {table}[CAST(crc32(CAST(k AS BINARY)) % {size} AS INT)]))"
    return f"array_sort(array_distinct(concat({_array([str(n) for n in always], 'int')}, {found})))"


def first_rule_sql(message: str, candidates: str, rules: Sequence[Rule]) -> str:
    """SQL of the first of ``candidates`` that matches, -1 if none does."""
    text = lambda values: _array(["NULL" if v is None else sql_literal(v) for v in values], "string")
    equals, starts = text([r.equals for r in rules]), text([r.starts for r in rules])
    contains, patterns = text([r.contains for r in rules]), text([r.pattern for r in rules])
    matches = (
        f"CASE WHEN {equals}[r] IS NOT NULL THEN {message} = {equals}[r] "
        f"ELSE startswith({message}, coalesce({starts}[r], '')) AND contains({message}, coalesce({contains}[r], '')) AND {message} RLIKE {patterns}[r] END"
    )
    return f"aggregate({candidates}, -1, (a, r) -> CASE WHEN a >= 0 THEN a WHEN {matches} THEN r ELSE a END)"


def classify_indexed(events: DataFrame, rules: Sequence[Rule], message: str = "message", category: str = "category") -> DataFrame:
    """``events`` with ``category``: that of the first rule which matches, else
    the fallback (also for a null message)."""
    # One row each, so that the candidates are found once per message.
    staged = events.select("*", F.inline(F.expr(f"array(struct({candidates_sql(f'`{message}`', rules)} AS _candidates))")))
    first = F.expr(first_rule_sql(f"`{message}`", "_candidates", rules))
    names = F.expr(_array([sql_literal(r.category) for r in rules], "string"))
    number = F.coalesce(first, F.lit(-1))
    found: Column = F.when(number >= 0, F.get(names, number)).otherwise(F.lit(FALLBACK_CATEGORY))
    return staged.select(*events.columns, found.alias(category))
