"""Decisions as data: ordered rules, reason codes, points and votes over columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def true(condition: Column) -> Column:
    """A condition with null as false."""
    return F.coalesce(condition, F.lit(False))


def first_rule(rules: list[tuple[Column, str]], default: str | None) -> Column:
    """The label of the first rule that holds; a null condition does not hold."""
    out = F.lit(default)
    for condition, label in reversed(rules):
        out = F.when(condition, F.lit(label)).otherwise(out)
    return out


def last_rule(rules: list[tuple[Column, str]], default: str | None) -> Column:
    """The label of the last rule that holds: later rules overwrite earlier ones."""
    return first_rule(list(reversed(rules)), default)


def reasons(checks: list[tuple[Column, str]], most: int | None = None) -> Column:
    """The codes of all checks that hold, in order; an empty array if none does."""
    out = F.array_compact(F.array(*(F.when(condition, F.lit(code)) for condition, code in checks)))
    return F.slice(out, 1, most) if most else out


def points(terms: list[tuple[Column, float]]) -> Column:
    """The sum of the points of all conditions that hold."""
    return reduce(lambda a, b: a + b, (F.when(c, F.lit(float(p))).otherwise(F.lit(0.0)) for c, p in terms))


def tiers(score: Column, thresholds: list[tuple[float, str]], lowest: str) -> Column:
    """The first tier whose threshold the score reaches, ``thresholds`` from the highest down."""
    return first_rule([(score >= t, name) for t, name in thresholds], lowest)


def keyword_vote(text: Column, keywords: dict[str, list[str]], default: str) -> Column:
    """The label most of whose keywords occur in a case-folded text; of equals the first, ``default`` without any."""
    low = F.lower(F.coalesce(text, F.lit("")))
    votes = F.array(*(sum((F.contains(low, F.lit(k)).cast("int") for k in words), F.lit(0)) for words in keywords.values()))
    labels = F.array(*map(F.lit, keywords))
    best = F.array_max(votes)
    return F.when(best > 0, F.element_at(labels, F.array_position(votes, best).cast("int"))).otherwise(F.lit(default))


def holding(conditions: list[Column]) -> Column:
    """How many conditions hold."""
    return reduce(lambda a, b: a + b, (true(c).cast("int") for c in conditions))
