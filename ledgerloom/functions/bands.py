"""Labels and points read off a ladder of thresholds.

A ladder is a list of ``(threshold, result)`` pairs. The first step that holds wins, and a null value holds
on no step, so it always gets the fallback.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, functions as F

Ladder = Sequence[tuple[float, Any]]


def _climb(steps: list[tuple[Column, Any]], fallback: Any) -> Column:
    chosen = F.lit(fallback)
    for holds, result in reversed(steps):
        chosen = F.when(holds, F.lit(result)).otherwise(chosen)
    return chosen


def below(value: Column, ladder: Ladder, fallback: Any) -> Column:
    """Result of the first step the value lies below; thresholds ascend."""
    return _climb([(value < limit, result) for limit, result in ladder], fallback)


def above(value: Column, ladder: Ladder, fallback: Any) -> Column:
    """Result of the first step the value exceeds; thresholds descend."""
    return _climb([(value > limit, result) for limit, result in ladder], fallback)


def at_least(value: Column, ladder: Ladder, fallback: Any) -> Column:
    """Result of the first step the value reaches; thresholds descend."""
    return _climb([(value >= limit, result) for limit, result in ladder], fallback)


def ladder_sql(value: str, operator: str, ladder: Ladder, fallback: Any) -> str:
    """The same ladder as SQL text, for functions registered in the session."""
    steps = " ".join(f"WHEN {value} {operator} {limit} THEN {result!r}" for limit, result in ladder)
    return f"CASE {steps} ELSE {fallback!r} END"
