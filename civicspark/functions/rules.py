"""Deterministic classification and scoring from rule tables given as parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import fold


def any_of(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def first_match(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first rule (pattern, label) that the folded text matches."""
    t = fold(text)
    out = F.lit(default)
    for pattern, label in reversed(rules):
        out = F.when(t.rlike(pattern), label).otherwise(out)
    return out


def graded(text: Column, strong: list[str], weak: list[str], weak_only: list[str] = ()) -> Column:
    """'forte', 'media', 'infra' (weak only by terms of ``weak_only``) or null."""
    t = fold(text)
    firm = [p for p in weak if p not in weak_only]
    return F.when(t.rlike(any_of(strong)), "forte").when(t.rlike(any_of(firm)), "media").when(t.rlike(any_of(list(weak_only) or ["(?!)"])), "infra")


def tags(text: Column, words: list[tuple[int, list[str]]], most: int = 6) -> Column:
    """Ids of the word lists of which the folded text contains a word: ascending, ``most`` at most."""
    t = fold(text)
    hits = [F.when(F.greatest(*[t.contains(w) for w in ws]) if len(ws) > 1 else t.contains(ws[0]), F.lit(i)) for i, ws in words]
    return F.slice(F.array_sort(F.array_distinct(F.array_compact(F.array(*hits)))), 1, most)


def capped_score(criteria: dict[str, tuple[Column, int]], low: int = 0, high: int = 100) -> Column:
    """Sum of criteria, each null as 0 and capped at its own maximum; the sum clamped."""
    parts = [F.least(F.coalesce(c, F.lit(0)), F.lit(cap)) for c, cap in criteria.values()]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return F.greatest(F.lit(low), F.least(F.lit(high), total))


def band(score: Column, edges: list[tuple[int, str]], below: str) -> Column:
    """The label of the highest edge the score reaches."""
    out = F.lit(below)
    for edge, label in sorted(edges):
        out = F.when(score >= edge, label).otherwise(out)
    return out


def flags(rules: dict[str, Column]) -> Column:
    """Labels of the rules that hold, in order, as an array."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in rules.items()]))


def backoff(attempts: Column, base: int = 60, most: int = 86400) -> Column:
    """Seconds to wait: base * 2^attempts, the exponent up to 10, at most ``most``."""
    return F.least(F.lit(most), (F.lit(base) * F.pow(F.lit(2), F.least(attempts, F.lit(10)))).cast("bigint"))
