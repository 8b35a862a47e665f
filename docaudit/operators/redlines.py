"""All places of terms in a text with their context, as columns: what stands between the matches tells where they are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docaudit.functions import text as X


def places(text: Column, patterns: list[str]) -> Column:
    """``matched, start, end`` of each match of any of the patterns, case folded, by start, in one pass.

    The text is split at the matches: the lengths of the pieces and of the matches before one add up to
    its start. Of overlapping matches the leftmost counts, of those that begin together the first pattern's.
    """
    pattern = "(?iU)(" + "|".join(f"(?:{p})" for p in patterns) + ")"
    t = X.text_or_empty(text)
    hits = F.regexp_extract_all(t, F.lit(pattern), 1)
    gaps = F.slice(F.transform(F.split(t, pattern, -1), F.length), F.lit(1), F.size(hits))
    begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<matched:string,start:int,end:int>>").alias("found"))

    def step(done: Column, one: Column) -> Column:
        start = done["at"] + one["gap"]
        end = start + F.length(one["hit"])
        return F.struct(end.alias("at"), F.concat(done["found"], F.array(F.struct(one["hit"].alias("matched"), start.alias("start"), end.alias("end")))).alias("found"))

    return F.aggregate(F.zip_with(gaps, hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit"))), begun, step)["found"]


def spans(text: Column, patterns: list[str], window: int = 140) -> Column:
    """The ``places`` of a text with ``context``: ``window`` characters on either side in single spaces."""
    t = X.text_or_empty(text)

    def shown(p: Column) -> Column:
        left = F.greatest(F.lit(0), p["start"] - window)
        return X.collapse_spaces(F.substring(t, left + 1, p["end"] + window - left))

    return F.transform(places(text, patterns), lambda p: F.struct(p["matched"].alias("matched"), p["start"].alias("start"), p["end"].alias("end"), shown(p).alias("context")))
