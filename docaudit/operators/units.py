"""Quantities recorded in different units (problem 3), and units found by physical identities.

``declared_quantities`` reads each recorded number with the unit and scale that its source
states: in the entry itself, in the unit hint, or in the texts around it; scale and currency
may stand in different places. Where numbers can be read in several ways (a separator that may
group digits or mark decimals), those of a record are decided together: the combination of least log
residuals, an unusual reading having a price, and a flag where another reading does as well.

``identity_units`` needs no statement at all: where columns obey a product identity, such as
mass = density x volume, it picks per group of rows the combination of units with the least
log residual and flags groups in which another combination does as well.
"""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
from collections.abc import Iterator
from decimal import Decimal, InvalidOperation
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spellings of units: kind of quantity, size in its base unit, spellings (fixed values).
UNITS = (
    ("rate", "1", "% percent pct per·cent pp percentage·points percentage·point 百分点 个百分点 prozent prozentpunkte pour·cent por·ciento パーセント"),
    ("rate", "0.01", "bp bps basis·points basis·point 个基点 基点 basispunkte points·de·base puntos·básicos ベーシスポイント"),
    ("rate", "0.1", "‰ per·mille permille promille"),
    ("rate", "100", "fraction decimal fraction,·1.0·=·100% decimal·(1·=·100%) fraction·(1.0·=·100%) decimal,·1·=·100%"),
    ("valuation", "1", "x × times 倍 multiple multiple·(x) -fach"),
    ("tenor", "1", "month months mth mths 个月 monat monate mois meses"),
    ("tenor", "3", "quarter quarters 个季度 季度 quartal quartale trimestres"),
    ("tenor", "12", "year years yr yrs 年 jahr jahre ans años"),
    ("power", "1", "MW 兆瓦 megawatt megawatts"),
    ("power", "1000", "GW 吉瓦 gigawatt gigawatts"),
    ("power", "0.001", "kW 千瓦 kilowatt kilowatts"),
    ("power", "0.000001", "W 瓦 watt watts"),
    ("power", "1000000", "TW terawatt terawatts"),
    ("mass", "1", "t 吨 tonne tonnes metric·ton metric·tons metric·tonnes tonnen"),
    ("mass", "1000", "kt kilotonne kilotonnes"),
    ("mass", "1000000", "Mt megatonnes"),
    ("mass", "0.001", "kg 千克 公斤 kilogram kilograms"),
    ("dollar_amount", "1", "USD US$ $ dollar dollars US·dollar US·dollars 美元"),
    ("euro_amount", "1", "EUR € euro euros 欧元"),
    ("yuan_amount", "1", "CNY RMB yuan 人民币 元 人民币元 renminbi"),
)
#: Spellings of scales (fixed values).
SCALES = (
    ("1000", "k K thousand thousands '000 000s 千 tsd. tsd"),
    ("10000", "万"),
    ("1000000", "m mn million millions mio. mio 百万"),
    ("100000000", "亿"),
    ("1000000000", "b B bn billion billions mrd. mrd 十亿"),
    ("1000000000000", "trn tn trillion trillions 万亿"),
)
#: The size of each common unit in the base unit of its kind (fixed values).
COMMON = {"percent": "1", "times": "1", "month": "1", "MW": "1", "tonne": "1", "USD": "1", "EUR": "1", "CNY": "1"}
#: Spellings in which the case of letters matters.
CASED = frozenset("MW GW kW TW W t kt Mt kg k K m b B mn bn".split())
AMOUNTS = frozenset(["dollar_amount", "euro_amount", "yuan_amount"])


def _table(rows) -> dict[str, tuple]:
    out: dict[str, tuple] = {}
    for *value, spellings in rows:
        for s in spellings.split(" "):
            s = s.replace("·", " ")
            out[s] = tuple(value)
            if s not in CASED:
                out.setdefault(s.lower(), tuple(value))
    return out


_UNITS, _SCALES = _table(UNITS), _table(SCALES)
_BY_LENGTH = lambda table: "|".join(map(re.escape, sorted(table, key=len, reverse=True)))
_UNIT, _SCALE = _BY_LENGTH(_UNITS), _BY_LENGTH(_SCALES)
PHRASES = tuple(
    re.compile(p, re.I)
    for p in (
        rf"(?P<unit>{_UNIT})",
        rf"(?P<scale>{_SCALE})",
        rf"(?P<scale>{_SCALE})\s*(?:of\s+|de\s+|d')?(?P<unit>{_UNIT})",
        rf"(?P<unit>{_UNIT})\s*[,;/]?\s*(?:in\s+)?(?P<scale>{_SCALE})",
    )
)
NUMBER = re.compile(r"\d(?:[\d.,'’    ]*\d)?")
LEAD = re.compile(r"^(?:单位|單位|单位是|unit|units|einheit|unité|unidad|単位)\s*[:：=]?\s*|^(?:in|en)\s+", re.I)
BRACKETS = re.compile(r"[(（\[【]((?:[^()（）\[\]【】]|[(（][^()（）]*[)）])*)[)）\]】]")
TAIL = re.compile(r"(?:^|.*?[:：=]\s*|.*\bin\s+|.*?,\s+)(?=\S)")
#: No phrase is longer than a lead, a unit, a scale and what joins them, in two pairs of brackets.
MAX_PHRASE = max(map(len, _UNITS)) + max(map(len, _SCALES)) + 32
UNUSUAL = 4.0  # price of an unusual reading: it must bring the numbers of a record together by two orders of magnitude


def _look(table: dict[str, tuple], word: str) -> tuple | None:
    return table.get(word) or table.get(word.lower())


@lru_cache(maxsize=50_000)
def unit_phrase(text: str) -> tuple[str | None, Decimal | None, Decimal | None]:
    """What a whole phrase says: kind of quantity, size of the unit, scale; all None if it is no such phrase."""
    s = text.strip().strip(".;") if text.strip() not in ("Mio.", "Mrd.") else text.strip()
    for _ in range(4):
        if not s or len(s) > MAX_PHRASE:
            return None, None, None
        for pattern in PHRASES:
            m = pattern.fullmatch(s)
            if not m:
                continue
            groups = m.groupdict()
            unit = _look(_UNITS, groups["unit"]) if groups.get("unit") else None
            scale = _look(_SCALES, groups["scale"]) if groups.get("scale") else None
            if groups.get("unit") and not unit or groups.get("scale") and not scale:
                continue
            if unit and scale and unit[0] in ("rate", "valuation", "tenor"):
                continue
            return (unit[0] if unit else None, Decimal(unit[1]) if unit else None, Decimal(scale[0]) if scale else None)
        inner = BRACKETS.fullmatch(s)
        shorter = inner.group(1).strip() if inner else LEAD.sub("", s)
        if shorter == s:
            return None, None, None
        s = shorter
    return None, None, None


NOTHING = (None, None, None)


def stated_unit(line: str) -> tuple[str | None, Decimal | None, Decimal | None]:
    """The unit that a line of text states: as the whole line, in brackets, or behind a colon, ``=``, ``in`` or the last comma."""
    return _stated_short(line) if len(line) <= 200 else _stated(line)  # long lines would fill the table


def _stated(line: str) -> tuple[str | None, Decimal | None, Decimal | None]:
    s = " ".join(unicodedata.normalize("NFKC", line).split())
    if not s:
        return NOTHING
    found = unit_phrase(s)
    if found != NOTHING:
        return found
    for inner in reversed(BRACKETS.findall(s)):
        found = unit_phrase(inner)
        if found != NOTHING:
            return found
    if s[-1:] in ")]】":  # nested brackets, as in [multiple (x)]
        for k in range(max(0, len(s) - MAX_PHRASE - 2), len(s)):
            if s[k] in "([【":
                found = unit_phrase(s[k + 1 : -1])
                if found != NOTHING:
                    return found
    for k in [m.end() for m in re.finditer(r"[:：=]\s*|\bin\s+|[,，]\s*|[–-]\s+", s)]:
        if len(s) - k <= MAX_PHRASE:
            found = unit_phrase(s[k:])
            if found != NOTHING:
                return found
    return NOTHING


_stated_short = lru_cache(maxsize=50_000)(_stated)


def readings(digits: str) -> list[Decimal]:
    """All values that a string of digits and separators may stand for, the likeliest first."""
    s = re.sub("[    '’]", "", digits)
    marks = re.findall("[.,]", s)
    out: list[str] = []
    if not marks:
        out = [s]
    elif len(set(marks)) == 2:
        last = max(s.rfind("."), s.rfind(","))
        out = [re.sub("[.,]", "", s[:last]) + "." + s[last + 1 :]]
    elif len(marks) > 1:
        out = [re.sub("[.,]", "", s)]
    else:
        head, tail = s.split(marks[0])
        decimal, grouped = f"{head}.{tail}", head + tail
        may_group = len(tail) == 3 and 1 <= len(head) <= 3 and head.strip("0") and s == digits
        if not may_group:
            out = [decimal]
        else:
            out = [grouped, decimal] if marks[0] == "," else [decimal, grouped]
    try:
        return [Decimal(x) for x in out]
    except InvalidOperation:
        return []


@lru_cache(maxsize=200_000)
def entry_parts(entry: str) -> tuple[tuple[Decimal, ...], tuple] | None:
    """The readings of an entry, with its sign, and the unit it states itself; None if it is no number."""
    s = unicodedata.normalize("NFKC", entry).replace("−", "-").replace("–", "-").strip()
    found = list(NUMBER.finditer(s))
    if len(found) != 1:
        return None
    m = found[0]
    before, after = s[: m.start()], s[m.end() :]
    values = readings(m.group())
    if not values:
        return None
    negative = "-" in before or before.rstrip().endswith("(") and after.lstrip().startswith(")")
    before = re.sub(r"[-+~≈(±]|ca\.|approx\.", " ", before).strip()
    after = after.strip()
    if negative and after.startswith(")"):
        after = after[1:].strip()
    stated = " ".join(x for x in (before, after) if x)
    unit = unit_phrase(stated) if stated else NOTHING
    if stated and unit == NOTHING:
        a, b = unit_phrase(before) if before else NOTHING, unit_phrase(after) if after else NOTHING
        unit = tuple(x if x is not None else y for x, y in zip(a, b, strict=True))
    return tuple(-v if negative else v for v in values), unit


def _resolve(own: tuple, places: list[tuple]) -> tuple[str, Decimal] | None:
    """Kind and factor of an entry from its own unit and those stated around it, in order."""
    kind, size, scale = own
    if kind:
        return kind, size * (scale or 1)
    if scale is not None:  # only a scale: the unit must be one that takes a scale
        for k, s, _ in places:
            if k in AMOUNTS or k in ("mass", "power"):
                return k, s * scale
        return None
    for i, (k, s, c) in enumerate(places):
        if k and c is not None:
            return k, s * c
        if k:
            if k in AMOUNTS:
                later = next((x[2] for x in places[i + 1 :] if x[2] is not None and (x[0] is None or x[0] == k)), None)
                return k, s * (later or 1)
            return k, s
        if c is not None:
            for k2, s2, _ in places[i + 1 :]:
                if k2 in AMOUNTS or k2 in ("mass", "power"):
                    return k2, s2 * c
            return None
    return None


def _choose(options: list[list[Decimal]], unusual: float = UNUSUAL) -> list[tuple[Decimal, bool]]:
    """One reading of each entry of a record: of all combinations the one of least log residuals, and whether each is unique.

    The residuals are the squared distances of the decimal logarithms from their mean; a reading that is not the usual
    one has a price on top. For a given mean each entry decides for itself, and its decision changes at one point; so the
    best combination is one of those between these points, which are gone through in order. A reading is unique if
    the entry has no other or if the other alone makes the residuals larger by at least 1.
    """
    open_at = [i for i, o in enumerate(options) if len(o) > 1 and all(o)]
    out = [(o[0], len(o) == 1) for o in options]
    if not open_at:
        return out
    usual = {i: math.log10(abs(options[i][0])) for i in open_at}
    other = {i: math.log10(abs(options[i][1])) for i in open_at}
    picked = {i: other[i] < usual[i] for i in open_at}  # as for a mean below all points
    known = [math.log10(abs(o[0])) for o in options if len(o) == 1 and o[0]] + [other[i] if picked[i] else usual[i] for i in open_at]
    n, total, squares, price = len(known), sum(known), sum(x * x for x in known), unusual * sum(picked.values())
    points = sorted(((other[i] ** 2 - usual[i] ** 2 + unusual) / (2 * (other[i] - usual[i])), i) for i in open_at)
    least, best = squares - total * total / n + price, 0
    for k, (_, i) in enumerate(points, 1):
        before, after = (other[i], usual[i]) if picked[i] else (usual[i], other[i])
        total, squares, price = total + after - before, squares + after * after - before * before, price + (-unusual if picked[i] else unusual)
        cost = squares - total * total / n + price
        if cost < least - 1e-9:
            least, best = cost, k
    for _, i in points[:best]:
        picked[i] = not picked[i]
    known = known[: n - len(open_at)] + [other[i] if picked[i] else usual[i] for i in open_at]
    total = sum(known)
    for i in open_at:
        x, y = (other[i], usual[i]) if picked[i] else (usual[i], other[i])
        more = y * y - x * x - ((total + y - x) ** 2 - total**2) / n
        out[i] = options[i][1 if picked[i] else 0], more >= 1
    return out


def record_quantities(numbers, dates, hint, title, caption, nearby) -> list[tuple[int, str, Decimal, bool]]:
    """Of a record: value_no, kind of quantity, value in the base unit of the kind, whether the reading is unique."""
    if numbers is None or not len(numbers):
        return []
    skip = {d for d in dates if d is not None} if dates is not None else set()
    parts = [entry_parts(x) if x is not None and x not in skip else None for x in numbers]
    if not any(parts):
        return []
    places: list[tuple] | None = None
    resolved: list[tuple[str, Decimal] | None] = []
    for p in parts:
        if p is None:
            resolved.append(None)
            continue
        if p[1][0] is None and places is None:
            places = [stated_unit(t) for t in (hint, title) if t]
            places += [stated_unit(line) for t in (caption, nearby) if t for line in t.split("\n")]
            places = [x for x in places if x != NOTHING]
        resolved.append(_resolve(p[1], places or []))
    known = [i for i, r in enumerate(resolved) if r]
    chosen = _choose([[v * resolved[i][1] for v in parts[i][0]] for i in known])
    return [(i + 1, resolved[i][0], value, unique) for i, (value, unique) in zip(known, chosen, strict=True)]


def declared_quantities(
    df: DataFrame,
    common: dict[str, str],
    key: str = "chart_row_id",
    numbers: str = "numbers",
    dates: str = "dates",
    hint: str = "unit_hint",
    title: str = "title",
    caption: str = "caption",
    nearby: str = "nearby_text",
) -> DataFrame:
    """``key, value_no int, common_unit string, milli bigint, is_unique boolean`` of each entry whose unit can be told.

    ``common`` names the unit of each kind of quantity. Entries that are null, no number, without a
    unit, or also among the dates give no row; so do null and empty lists. ``milli`` is 1,000 times
    the value, rounded to even. ``is_unique`` is false where another reading does as well. Repeated
    rows count like all others; rows stay where they are, nothing is shuffled.
    """
    factors = {kind: (unit, Decimal(1000) / Decimal(COMMON[unit])) for kind, unit in common.items() if unit in COMMON}
    columns = [key, numbers, dates, hint, title, caption, nearby]
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for k, *record in zip(*(rows[f"c{i}"].tolist() for i in range(len(columns))), strict=True):
                for number, kind, value, unique in record_quantities(*record):
                    if kind in factors:
                        unit, factor = factors[kind]
                        out.append((k, number, unit, int((value * factor).to_integral_value()), unique))
            yield pd.DataFrame(out, columns=[key, "value_no", "common_unit", "milli", "is_unique"])

    source = df.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns))).where(F.size("c1") > 0)
    return source.mapInPandas(run, f"`{key}` {key_type}, value_no int, common_unit string, milli bigint, is_unique boolean")


def identity_units(df: DataFrame, group: list[str], left: str, right: list[str], units: dict[str, dict[str, float]], tie: float = 0.05) -> DataFrame:
    """The units of columns that obey ``left = product of right``, for each group of rows.

    ``units`` has for each column the possible units and their sizes in the common unit. Every
    combination has the mean log residual of the identity; the least wins, and ``is_unique`` is
    false if another comes within ``tie``. Only rows in which all columns are positive count; a
    group without any has null units. One aggregation over (group): the sums do not depend on the
    combination, so no row is repeated for it.
    """
    columns = [left, *right]
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.coalesce(F.col(c) > 0, F.lit(False))
    log = lambda c: F.when(ok, F.ln(F.col(c).cast("double")))
    residual: Column = log(left) - sum((log(c) for c in right[1:]), log(right[0]))
    per_group = df.groupBy(*group).agg(F.avg(residual).alias("__mean"), F.count(residual).alias("n_rows"))
    combos = []
    for names in itertools.product(*(units[c] for c in columns)):
        sizes = [math.log(units[c][u]) for c, u in zip(columns, names, strict=True)]
        combos.append((sizes[0] - sum(sizes[1:]), names))
    options = F.array(*(F.struct(F.abs(F.col("__mean") + F.lit(shift)).alias("residual"), *(F.lit(u).alias(f"unit_{c}") for c, u in zip(columns, names, strict=True))) for shift, names in combos))
    ranked = F.array_sort(options)
    best, second = F.element_at(ranked, 1), F.element_at(ranked, 2) if len(combos) > 1 else None
    some = F.col("n_rows") > 0
    return per_group.select(
        *group,
        "n_rows",
        *(F.when(some, best[f"unit_{c}"]).alias(f"unit_{c}") for c in columns),
        F.when(some, best["residual"]).alias("residual"),
        F.when(some, (second["residual"] - best["residual"] > tie) if second is not None else F.lit(True)).alias("is_unique"),
    )


def common_units(spark, folder: str) -> dict[str, str]:
    """The fixed table common_units (8 rows, does not grow)."""
    return {r.quantity: r.common_unit for r in spark.read.parquet(f"{folder}/common_units.parquet").collect() if r.quantity and r.common_unit}


def p3_quantities(spark, folder: str) -> DataFrame:
    return declared_quantities(spark.read.parquet(f"{folder}/chart_candidates.parquet"), common_units(spark, folder))


def p3_found(spark, folder: str) -> DataFrame:
    return p3_quantities(spark, folder).select("chart_row_id", "value_no", "common_unit", "milli")


def p3_identities(spark, folder: str) -> DataFrame:
    """Per source the unit in which the recorded size of its documents is given, found from their texts alone."""
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("source", F.col("n_chars").alias("recorded"), F.length("text").alias("counted"))
    found = identity_units(rows, ["source"], "recorded", ["counted"], {"recorded": {"characters": 1.0, "thousands": 1000.0, "dozens": 12.0}, "counted": {"characters": 1.0}})
    return found.select("source", "n_rows", "unit_recorded", F.round("residual", 6).alias("residual"), "is_unique")
