"""Predicates that select rows: all are boolean columns without null, so that a filter and its complement cover all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docaudit.functions import text as X
from docaudit.operators.rules import holding, true


def has_suffix(path: Column, *suffixes: str) -> Column:
    """Whether a path ends in one of the suffixes, case folded."""
    low = F.lower(path)
    out = F.lit(False)
    for s in suffixes:
        out = out | true(low.endswith(s.lower()))
    return out


def declared_or_suffix(declared: Column, path: Column, kinds: list[str], *suffixes: str) -> Column:
    """Whether the declared format is one of ``kinds``, or the path has such a suffix."""
    return true(F.lower(F.trim(declared)).isin(kinds)) | has_suffix(path, *suffixes)


def any_term(text: Column, terms: list[str]) -> Column:
    """Whether any term occurs in the text, case folded."""
    low = F.lower(X.text_or_empty(text))
    return F.exists(F.array(*map(F.lit, terms)), lambda t: F.contains(low, t)) if terms else F.lit(False)


def positive_title(title: Column, wanted: str, noise: str) -> Column:
    """Whether a title matches the wanted pattern and not that of noise."""
    return true(title.rlike(wanted)) & ~true(title.rlike(noise))


def usable_excerpt(part: Column, whole: Column, least: int = 1800, low: float = 0.18, high: float = 1.25) -> Column:
    """Whether a text is long enough in itself and as a share of the whole it was taken from."""
    n, m = F.length(X.text_or_empty(part)), F.length(X.text_or_empty(whole))
    return (n >= least) & (n >= m * low) & (n <= m * high)


def generic_title(title: Column, generic: list[str]) -> Column:
    """Whether a title without dashes and bars around it is one of those that say nothing."""
    return F.btrim(X.collapse_spaces(F.lower(title)), F.lit(" -|")).isin(generic)


def overlay_text(text: Column, strong: list[str], weak: list[str], strong_below: int = 1500, weak_below: int = 360, bare_below: int = 80) -> Column:
    """Whether a node that lies over a page is a notice: a strong term and not too long, a weak one and shorter, or hardly any text."""
    n = F.length(X.text_or_empty(text))
    return F.when(any_term(text, strong), n < strong_below).when(any_term(text, weak), n < weak_below).otherwise(n < bare_below)


def unlike_true(flag: Column) -> Column:
    """Whether a flag is anything but true: false and null alike."""
    return ~true(flag)


def at_least(conditions: list[Column], n: int) -> Column:
    """Whether at least ``n`` of the conditions hold; null does not."""
    return holding(conditions) >= n


def in_order(rows: DataFrame, key: str, wanted: list, strict: bool = False) -> DataFrame:
    """The rows whose key is in a list, in the order of the list; keys not found are left out, or with ``strict`` raise at once."""
    kind = rows.schema[key].dataType
    if strict:
        known = {r[0] for r in rows.where(F.col(key).isin(wanted)).select(key).distinct().collect()}  # no more than are wanted
        if missing := [w for w in wanted if w not in known]:
            raise KeyError(f"no rows for {missing}")
    places = F.array(*(F.lit(w).cast(kind) for w in wanted))
    at = F.array_position(places, F.col(key))
    return rows.where(at > 0).orderBy(at)


def routed(rows: DataFrame, accepted: Column, keep_rejected: bool = False) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows; with ``keep_rejected`` the accepted come with the rejected too, marked."""
    flagged = rows.withColumn("accepted", true(accepted))
    return (flagged if keep_rejected else flagged.where("accepted")), flagged.where("not accepted")
