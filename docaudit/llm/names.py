"""Problem 2: spellings of the same institution.

Method: pigeonhole segment join. A name is cut into k+1 segments; within k edits at least one
segment survives, shifted by at most k, so equal segments at shifted positions are looked up in
an inverted index (a join on kind of business, length, segment number and segment), and what is
found is verified by a banded edit distance.

Before that each stored string is read once: accents, case, legal forms, departments, brackets
and order are folded, abbreviated business words are written out, and the rest is the name. Only
distinct strings and distinct readings are joined, never rows. The number of edits grows with the
length of a name. A misspelling goes to the best attested name in reach; each link that is chosen
or stated counts, so an institution is all that links join, and its best attested reading names it.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docaudit.session import shared_checkpoint

#: Business words with their abbreviations (fixed values).
BUSINESS = {
    "asset": "assets",
    "capital": "cap",
    "management": "mgmt mgt mgmnt mngt managment",
    "private": "pvt priv",
    "bank": "bk banks banking",
    "securities": "sec secs security secur",
    "wealth": "wlth",
    "advisers": "advisors adviser advisor advisory advs",
    "insurance": "ins insur",
    "investments": "inv invest invs investment",
    "international": "intl int'l int internat",
    "research": "rsch res",
    "fund": "funds",
    "trust": "trusts tr",
    "futures": "future fut",
    "global": "gbl",
    "partners": "partner",
    "markets": "mkts market",
    "equity": "eq",
    "brokerage": "broker brokers",
    "financial": "fin finance",
    "services": "svcs svc service",
}
_WORDS = {s: full for full, short in BUSINESS.items() for s in (full, *short.split())}
#: Business words of Chinese names: simplified and traditional, and what they are called in English (fixed values).
HAN_BUSINESS = {
    "资产管理": "asset management", "資產管理": "asset management", "基金管理": "fund management", "基金": "fund", "期货": "futures", "期貨": "futures",
    "证券": "securities", "證券": "securities", "信托": "trust", "信託": "trust", "银行": "bank", "銀行": "bank", "保险": "insurance", "保險": "insurance", "资本": "capital", "資本": "capital", "投资": "investments", "投資": "investments",
}
#: Initials that stand for two business words (fixed values).
BUSINESS_INITIALS = {"am": "asset management", "cm": "capital management", "pb": "private bank", "ir": "international research", "wa": "wealth advisers", "ii": "insurance investments"}
#: Legal forms, departments and remarks that do not tell institutions apart (fixed values).
LEGAL = frozenset("ltd pte pty limited gmbh plc co inc llc sa ag corp corporation company nv bv kg se spa lp llp".split())
DEPARTMENTS = ("insights team", "insights", "research team", "research department", "perspectives", "online")
REMARK = re.compile(r"\s*[-–—]\s*(?:third[ -]party mirrors?|mirror(?:ed)?|copy|archive)\s*$", re.I)
HAN_TAIL = re.compile(r"[(（]?(?:股份有限公司|有限责任公司|有限責任公司|股份公司|有限公司|研究所|研究部|研究院|研究中心|研究)[)）]?$")
MISSING = frozenset(["", "n/a", "na", "unknown", "none", "null", "-", "--", "?", "und", "nan", "未知", "不详", "tbd"])
HAN = re.compile("[\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]")
MAX_EDITS = 2
#: A name may differ by one edit for so many letters or ideographs; a misspelling of one at least as long as
#: ``SURE_LETTERS`` is told by itself, of a shorter one by how much less it is attested.
LETTERS_PER_EDIT, HAN_LETTERS_PER_EDIT = 6, 4
SURE_LETTERS = 12
#: Words of a name that may come in any order; longer names are phrases and keep theirs.
SORTED_WORDS = 8


def in_order(words: list[str]) -> str:
    """Words as a key: sorted, as people exchange first and last names, unless they are too many for a name."""
    return " ".join(sorted(words) if len(words) <= SORTED_WORDS else words)


def fold(text: str) -> str:
    s = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text))
    return "".join(c for c in s if not unicodedata.combining(c))


def _latin(text: str) -> tuple[str, str, bool]:
    """Name key, business and whether the first name is an initial, of a name in Latin letters."""
    s = re.sub(r"(?<=[a-z])(?=[A-Z][a-z]{2})", " ", fold(text))
    s = s.lower().replace("’", "'").replace("&", " and ")
    s = re.sub(r"\b([a-z])\.([a-z])\.?(?![a-z])", r"\1\2", s)
    words = [w.strip("'") for w in re.findall(r"[a-z0-9']+", s)]
    while len(words) > 2 and words[-1] in LEGAL:
        words.pop()
    if len(words) > 2 and words[-2:] == ["s", "a"]:
        words = words[:-2]
    for tail_words in DEPARTMENTS:
        t = tail_words.split()
        if len(words) > len(t) + 1 and words[-len(t) :] == t:
            words = words[: -len(t)]
    while len(words) > 2 and words[-1] in LEGAL:
        words.pop()
    if not words:
        return "", "", False
    full = [_WORDS.get(w, w) for w in words]
    known = [w in _WORDS for w in words]
    business: list[str] = []
    name = list(words)
    n = len(words)
    k = n
    while k > 1 and known[k - 1]:
        k -= 1
    if k < n:
        business, name = full[k:], words[:k]
    elif known[0]:
        k = 0
        while k < n - 1 and known[k]:
            k += 1
        business, name = full[:k], words[k:]
        if name and name[0] in ("of", "de", "von"):
            name = name[1:]
    elif n > 1 and words[-1] in BUSINESS_INITIALS:
        business, name = BUSINESS_INITIALS[words[-1]].split(), words[:-1]
    if len(business) > 1 and business[-1] == "research" and business[-2:] != ["international", "research"]:
        business = business[:-1]  # a department
    initial = len(name) > 1 and any(len(w) == 1 for w in name)
    return in_order(name), " ".join(business), initial


def without_tail(text: str) -> str:
    """A Chinese name without its legal form and department."""
    s = re.sub(r"\s+", "", text)
    for _ in range(3):
        shorter = HAN_TAIL.sub("", s)
        if shorter == s or len(shorter) < 2:
            break
        s = shorter
    return s


def _han(text: str) -> tuple[str, str]:
    s = without_tail(unicodedata.normalize("NFKC", text))
    for words, english in HAN_BUSINESS.items():
        if s.endswith(words) and len(s) > len(words):
            return s[: -len(words)], english
    return s, ""


def misread(text: str) -> str:
    """What becomes of UTF-8 text that is read as GBK and loses what that cannot show."""
    return text.encode("utf-8").decode("gbk", "ignore")


def read_name(text: str) -> list[tuple[str, str, str]]:
    """All readings of a stored string: kind (``name``, ``initial``), name key, business."""
    s = REMARK.sub("", unicodedata.normalize("NFKC", text)).strip()
    if s.lower() in MISSING:
        return []
    out: list[tuple[str, str, str]] = []
    for part in re.split(r"\s+/\s+", s):
        bracket = re.fullmatch(r"([A-Z]{2,8})\s*\((.{5,})\)", part)
        if bracket:
            part = bracket.group(2)
        elif not HAN.search(part):
            part = re.sub(r"\s*\([^()]*\)\s*$", "", part) or part
        if HAN.search(part):
            name, business = _han(part)
            out.append(("name", name, business))
        else:
            name, business, initial = _latin(part)
            if name:
                out.append(("initial" if initial else "name", name, business))
    return out


def _sha(*columns: Column | str) -> Column:
    return F.sha2(F.concat_ws("\x1f", *columns), 256)


def _id(r: Column) -> Column:
    """The id of a reading."""
    return _sha(r["kind"], r["name"], r["business"])


def _whole(r: Column) -> Column:
    """Whether a reading names an institution in full: no initial for a name, and a business."""
    return (r["kind"] == "name") & (r["business"] != "")


def ideograph_syllables(spark: SparkSession) -> dict[str, str]:
    """The syllable of each unified ideograph, by the ICU transliterator among Spark's own libraries.

    A cluster without that class fails here with its name, rather than lose the links between scripts unnoticed.
    """
    ideographs = [chr(c) for c in range(0x4E00, 0x9FA6)]
    transliterator = spark._jvm.com.ibm.icu.text.Transliterator.getInstance("Han-Latin; Latin-ASCII; Lower")
    return dict(zip(ideographs, str(transliterator.transliterate(" ".join(ideographs))).split(), strict=True))


SYLLABLE = "(?:zh|ch|sh|[bpmfdtnlgkhjqxrzcsyw])?(?:iang|uang|iong|ang|eng|ing|ong|iao|ian|uai|uan|ai|ei|ao|ou|an|en|in|un|ia|ie|iu|ua|ui|uo|er|a|o|e|i|u)"
TWO_SYLLABLES = re.compile(f"({SYLLABLE})({SYLLABLE})")


def stated_syllables(readings: DataFrame, known: dict[str, str]) -> dict[str, str]:
    """Syllables as strings that give a name in both scripts have them: no more rows than there are ideographs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for found in rows["readings"]:
                han = [r["name"] for r in found if HAN.search(r["name"])]
                latin = [r["name"] for r in found if not HAN.search(r["name"])]
                for h in han:
                    for x in latin:
                        parts = [TWO_SYLLABLES.fullmatch(w) for w in x.split()]
                        if len(h) != 2 * len(parts) or not all(parts):
                            continue
                        words = [p.groups() for p in parts]
                        orders = [[s for w in order for s in w] for order in (words, words[::-1])]  # the words of a key are sorted
                        fits = [sum(known.get(c) == s for c, s in zip(h, order, strict=True)) for order in orders]
                        if max(fits):
                            out.extend(zip(h, orders[fits.index(max(fits))], strict=True))
            yield pd.DataFrame(out, columns=["ideograph", "syllable"])

    votes = readings.where(F.size("readings") > 1).select("readings").mapInPandas(run, "ideograph string, syllable string")
    votes = votes.groupBy("ideograph", "syllable").count()
    return {r.ideograph: r.syllable for r in votes.groupBy("ideograph").agg(F.max_by("syllable", F.struct("count", "syllable")).alias("syllable")).collect()}


def _script(name: Column) -> Column:
    """Whether a name has ideographs: fewer letters carry as much, so an edit weighs more."""
    return F.when(name.rlike(HAN.pattern), F.lit("han")).otherwise(F.lit("latin"))


def _lengths(edits: int, most: int, script: Column) -> tuple[Column, Column]:
    """The least length of names with a budget of ``edits``, and the first length beyond it."""
    step = F.when(script == "han", F.lit(HAN_LETTERS_PER_EDIT)).otherwise(F.lit(LETTERS_PER_EDIT))
    return step * edits, step * (edits + 1) if edits < most else F.lit(2**31 - 1)


def _segments(key: Column, script: Column, most: int, probe: bool) -> Column:
    """(length of the indexed name, segment number, segment) of a key; with ``probe``, of all names as long or longer within reach."""
    n = F.length(key)
    rows = []
    for edits in range(1, most + 1):
        parts = edits + 1
        low, beyond = _lengths(edits, most, script)
        for gap in range(edits + 1) if probe else (0,):
            length = n + gap
            size = F.floor(length / parts).cast("int")
            extra = length - size * parts  # the last segments are one longer
            for i in range(parts):
                start = size * i + F.greatest(F.lit(0), F.lit(i) - (parts - extra))
                width = size + F.when(F.lit(i) >= parts - extra, 1).otherwise(0)
                for shift in range(-edits, edits + 1) if probe else (0,):
                    if abs(shift) > i or abs(gap + shift) > edits - i:
                        continue  # some segment survives with at most i edits before it and the others behind it
                    at = start + shift
                    fits = (length >= low) & (length < beyond) & (at >= 0) & (at + width <= n) & (width > 0)
                    rows.append(F.when(fits, F.struct(length.alias("length"), F.lit(i).alias("part"), F.substring(key, at + 1, width).alias("segment"))))
                    if probe and edits == 1 and i == gap == shift == 0:  # an exchange over the only boundary spares neither segment
                        rows.append(F.when(fits, F.struct(length.alias("length"), F.lit(i).alias("part"), F.concat(F.substring(key, F.lit(1), width - 1), F.substring(key, width + 1, F.lit(1))).alias("segment"))))
    return F.array_distinct(F.array_compact(F.array(*rows)))


def _moved(name: Column) -> Column:
    """A name of sorted words with each word at each other place: an edit may change where a word is sorted to."""
    words = F.split(name, " ")
    last = F.size(words) - 1

    def at_each_place(i: Column) -> Column:
        rest = F.filter(words, lambda _, k: k != i)
        return F.transform(F.sequence(F.lit(0), last), lambda j: F.array_join(F.concat(F.slice(rest, F.lit(1), j), F.array(F.get(words, i)), F.slice(rest, j + 1, F.lit(SORTED_WORDS))), " "))

    several = (last > 0) & (last < SORTED_WORDS)
    return F.when(several, F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), last), at_each_place)))).otherwise(F.array(name))


def _exchanged(a: Column, b: Column) -> Column:
    """Whether two names of one length differ by the exchange of two neighbouring letters and nothing else."""
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1))), lambda i: F.substring(a, i, 1) != F.substring(b, i, 1))
    i, j = F.get(at, F.lit(0)), F.get(at, F.lit(1))
    crossed = (F.substring(a, i, 1) == F.substring(b, j, 1)) & (F.substring(a, j, 1) == F.substring(b, i, 1))
    return F.coalesce((F.length(a) == F.length(b)) & (F.size(at) == 2) & (j - i == 1) & crossed, F.lit(False))


def close_names(groups: DataFrame, edits: int = MAX_EDITS, carried: tuple[str, ...] = (), across: str | None = None) -> DataFrame:
    """Pairs of different ``name``s of one ``business`` within the edits that their length allows.

    The budget is one edit for each ``LETTERS_PER_EDIT`` letters of the longer name
    (``HAN_LETTERS_PER_EDIT`` ideographs), at most ``edits``; an exchange of two neighbouring letters
    counts as one edit. A name too short for any edit is a name of its own: in it a letter tells
    institutions apart. ``groups`` has ``id, name, business``, each name once per business. Both directions
    come out: ``id, other`` and the ``carried`` columns of either, those of the other as ``other_*``.
    With ``across``, a boolean column, only pairs that differ in it are looked for; rows that have null there pair among themselves.
    The distance is verified before anything else is shuffled.
    """
    names = groups.select("id", "name", "business", *carried, (F.coalesce(F.col(across).cast("int"), F.lit(2)) if across else F.lit(2)).alias("side")).withColumn("script", _script(F.col("name")))
    twice = (F.size(F.split("name", " ")) > 2) & (F.length("name") >= 2 * LETTERS_PER_EDIT) & F.lit(edits > 1)  # two edits may move two words: one is moved back here, one in the probe
    index = names.withColumn("name", F.explode(F.when(twice, _moved(F.col("name"))).otherwise(F.array("name"))))
    index = index.select(F.col("id").alias("other"), F.col("name").alias("other_name"), "business", "side", "script", *(F.col(c).alias(f"other_{c}") for c in carried), F.explode(_segments(F.col("name"), F.col("script"), edits, False)).alias("s"))
    index = index.select("*", "s.*").drop("s")
    probe = names.withColumn("name", F.explode(_moved(F.col("name")))).withColumn("side", F.when(F.col("side") == 2, 2).otherwise(1 - F.col("side")))
    probe = probe.select("*", F.explode(_segments(F.col("name"), F.col("script"), edits, True)).alias("s")).select("*", "s.*").drop("s")
    found = probe.join(index, ["business", "side", "script", "length", "part", "segment"]).where(F.col("id") != F.col("other"))
    distance = F.levenshtein("name", "other_name", edits + 1)
    step = F.when(F.col("script") == "han", F.lit(HAN_LETTERS_PER_EDIT)).otherwise(F.lit(LETTERS_PER_EDIT))
    budget = F.least(F.lit(edits), F.floor(F.length("other_name") / step))
    near = ((distance >= 0) & (distance <= budget)) | ((distance == 2) & (budget >= 1) & _exchanged(F.col("name"), F.col("other_name")))
    pair = found.where(near).select("id", "other", *carried, *(f"other_{c}" for c in carried))
    back = pair.select(F.col("other").alias("id"), F.col("id").alias("other"), *(F.col(f"other_{c}").alias(c) for c in carried), *(F.col(c).alias(f"other_{c}") for c in carried))
    return pair.unionByName(back).distinct()


def link_names(names: DataFrame, column: str = "name") -> DataFrame:
    """``name, institution`` of each distinct string of ``column``; missing names have no row.

    ``institution`` is the key of the best attested reading. Strings that no other resembles are
    institutions of their own. Null, empty and repeated strings and extra columns do no harm.
    """
    strings = names.select(F.col(column).alias("name")).where(F.col("name").isNotNull()).groupBy("name").agg(F.count("*").alias("rows"))
    reading = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "name", "business")]))

    @F.pandas_udf(reading)
    def read(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"kind": k, "name": n, "business": b} for k, n, b in read_name(t)])

    readings = shared_checkpoint(strings.select("name", "rows", F.array_distinct(read("name")).alias("readings")).where(F.size("readings") > 0))
    spell = ideograph_syllables(names.sparkSession)
    spell |= stated_syllables(readings, spell)

    # one reading names a string, the first with a business if there is one; the others are aliases
    readings = readings.withColumn("own", F.coalesce(F.get(F.filter("readings", _whole), F.lit(0)), F.get("readings", F.lit(0))))
    own, r = F.col("own"), F.col("r")
    first = readings.select("name", _id(own).alias("id"))
    parts = readings.select("rows", "own", F.explode("readings").alias("r"))
    groups = parts.groupBy("r").agg(F.count_if(r == own).alias("strings"), F.sum(F.when(r == own, F.col("rows")).otherwise(0)).alias("rows"))
    groups = shared_checkpoint(groups.select(_id(r).alias("id"), "r.kind", F.col("r.name").alias("key"), "r.business", _whole(r).alias("whole"), r["name"].rlike(HAN.pattern).alias("han"), "strings", "rows"))
    full = groups.where("kind = 'name'")
    best = F.max_by("other", F.struct("strings", "rows", "other")).alias("other")

    # a) stated in the string: all of these links count; an alias without a business may be that of several institutions and is placed last
    further = parts.where(r != own).select(_id(r).alias("id"), _id(own).alias("other"), "own", "r").distinct()
    stated = shared_checkpoint(further.where(_whole(r) | ~_whole(own)).select("id", "other", r["name"].rlike(HAN.pattern).alias("han"), own["name"].rlike(HAN.pattern).alias("other_han")))
    nicknames = further.where(_whole(own) & (r["kind"] == "name") & (r["business"] == "")).select(F.col("other").alias("id"), F.lit("").alias("business"), F.col("r.name").alias("word"), F.lit("").alias("letter"))

    # b) UTF-8 read as GBK: of several names that are misread so, the best attested
    spoil = F.pandas_udf(lambda s: s.map(lambda t: sorted({misread(t), misread(without_tail(t))})), T.ArrayType(T.StringType()))
    forms = readings.where(own["name"].rlike(HAN.pattern)).select(_id(own).alias("other"), F.explode(spoil("name")).alias("key"))
    spoilt = readings.where(F.col("name").rlike(HAN.pattern)).select(_id(own).alias("id"), F.col("name").alias("key"))
    weights = groups.select(F.col("id").alias("other"), "strings", "rows")
    by_misreading = spoilt.join(forms, "key").where("id != other").select("id", "other").distinct().join(weights, "other").groupBy("id").agg(best)

    # c) the other script, spelt out: of several names that sound so, the best attested
    @F.pandas_udf(T.StringType())
    def spelt(keys: pd.Series) -> pd.Series:
        def one(k: str) -> str | None:
            if len(k) < 2 or not all(c in spell for c in k):
                return None
            syllables = [spell[c] for c in k]
            size = 2 if len(k) % 2 == 0 else len(k)
            return in_order(["".join(syllables[i : i + size]) for i in range(0, len(k), size)])

        return keys.map(one)

    both = full.where("han").select("id", spelt("key").alias("name"), "business", "strings", "rows", F.lit(True).alias("spelt")).where("name is not null")
    both = shared_checkpoint(both.unionByName(full.where("not han").select("id", F.col("key").alias("name"), "business", "strings", "rows", F.lit(False).alias("spelt"))))
    sounds = both.where("spelt").select(F.col("id").alias("other"), "name", "business", "strings", "rows")
    exact = shared_checkpoint(both.where("not spelt").select("id", "name", "business").join(sounds, ["name", "business"]).groupBy("id").agg(best))

    # what whole names offer to those with an initial or without a business, and what these ask for
    words = F.split("key", " ")
    few = F.size(words) <= SORTED_WORDS
    place = ["business", "word", "letter"]
    heard = groups.where("whole").select("id", "key", "business").unionByName(both.where("spelt and business != ''").select("id", F.col("name").alias("key"), "business"))
    letters = F.transform(words, lambda w, i: F.struct(w.alias("word"), F.array_distinct(F.transform(F.filter(words, lambda _, k: k != i), lambda x: F.substring(x, 1, 1))).alias("rest")))
    family = heard.where(few & F.contains("key", F.lit(" "))).select("id", "key", "business", F.explode(letters).alias("w")).select("id", "key", "business", F.col("w.word").alias("word"), F.explode("w.rest").alias("letter"))
    offers = family.select("id", *place).unionByName(heard.select("id", F.lit("").alias("business"), F.col("key").alias("word"), F.lit("").alias("letter")))
    offers = shared_checkpoint(offers.unionByName(nicknames).distinct())
    shortened = groups.where((F.col("kind") == "initial") & few).select("id", "business", "strings", "rows", F.filter(words, lambda w: F.length(w) > 1).alias("long"), F.filter(words, lambda w: F.length(w) == 1).alias("short"))
    asked = shortened.select("id", "business", F.explode(F.array_distinct("long")).alias("word"), "short").select("id", "business", "word", F.explode(F.array_distinct("short")).alias("letter"))
    asked = asked.unionByName(full.where("business = ''").select("id", "business", F.col("key").alias("word"), F.lit("").alias("letter")))
    heeded = shared_checkpoint(asked.join(offers, place, "left_semi").select("id").distinct())

    # d) misspellings; a name that is known by the other script, or an abridged one that fits as it is, is none
    sure = exact.select("id").unionByName(heeded).unionByName(stated.where("other_han and not han").select("id")).unionByName(stated.where("han and not other_han").select(F.col("other").alias("id")))
    spellings = full.select("id", F.col("key").alias("name"), "business", "strings", "rows")
    abridged = shortened.where("size(long) > 0").select("id", F.array_join("long", " ").alias("name"), F.concat_ws("\x1f", "business", F.array_join("short", " ")).alias("business"), "strings", "rows")
    spellings = spellings.unionByName(abridged).join(sure.distinct().withColumn("sure", F.lit(True)), "id", "left").withColumn("sure", F.coalesce("sure", F.lit(False)))
    unheeded = asked.join(heeded, "id", "left_anti")
    spellings = spellings.unionByName(_counterparts(unheeded.select(*place).distinct(), offers.select(*place).distinct()), allowMissingColumns=True)
    spellings = shared_checkpoint(spellings.withColumn("letters", F.length("name")))
    close = shared_checkpoint(close_names(spellings, carried=("sure", "letters", "strings", "rows", "asking", "place"), across="asking"))
    typo = best_attested(close.where("asking is null"))

    links = stated.select("id", "other")
    for frame in (by_misreading, exact, typo):
        links = links.unionByName(frame.select("id", "other"))
    placed = shared_checkpoint(groups.join(_components(links), "id", "left").withColumn("root", F.coalesce("root", "id")))

    # e) for what has no name in ideographs, the best attested that is spelt nearly so: syllables are few, hence one edit, however long
    latin = placed.groupBy("root").agg(F.max("han").alias("han")).where("not han").select("root")
    near = close_names(both, 1, ("spelt", "strings", "rows"), "spelt").where("not spelt").select("id", "other", F.col("other_strings").alias("strings"), F.col("other_rows").alias("rows"))
    near = near.join(placed.select("id", "root"), "id").join(latin, "root", "left_semi").groupBy("root").agg(best)
    near = near.join(placed.select(F.col("id").alias("other"), F.col("root").alias("goal")), "other").select("root", "goal")
    placed = placed.join(near, "root", "left").withColumn("root", F.coalesce("goal", "root"))
    heads = placed.groupBy("root").agg(F.max_by("id", F.struct("strings", "rows", "id")).alias("head"), F.max("whole").alias("settled"), F.sum("strings").alias("s"), F.sum("rows").alias("r"))
    placed = shared_checkpoint(placed.select("id", "root").join(heads, "root").select("id", F.col("head").alias("root"), "settled", "s", "r"))

    # f) an initial for a name, or no business: the institution that fits, if one stands out
    at = placed.select(F.col("id").alias("fit"), F.col("root").alias("found"), "s", "r")
    offered = offers.withColumnRenamed("id", "fit").join(at, "fit").select(*place, "found", "s", "r").distinct()
    # of each key the two largest institutions are enough to see whether one stands out; Spark cuts each task's part to two before the shuffle
    offered = shared_checkpoint(_largest(offered, place))
    by_word = asked.join(offered, place).select("id", "found", "s", "r", F.lit(1).alias("tier"))
    by_all = suited(shortened, family).join(at, "fit").select("id", "found", "s", "r", F.lit(0).alias("tier"))
    alike = unheeded.join(close.where("asking").select("place.*", "other_place"), place)
    by_likeness = alike.select("id", "other_place.*").join(offered, place).select("id", "found", "s", "r", F.lit(2).alias("tier"))
    fits = by_word.unionByName(by_all).unionByName(by_likeness).join(placed.where("not settled").select("id", "root"), "id")
    fits = _largest(fits.select("root", "tier", "found", "s", "r").distinct(), ["root", "tier"])
    ends = fits.groupBy("root", "tier").agg(F.max_by("found", F.struct("s", "r", "found")).alias("found"), F.count("*").alias("n"), F.max("s").alias("most"), F.min("s").alias("next"))
    ends = ends.groupBy("root").agg(F.min_by(F.struct("found", "n", "most", "next"), "tier").alias("e")).where("e.n = 1 or e.most >= 2 * e.next").select("root", "e.found")
    institutions = placed.join(ends, "root", "left").select("id", F.coalesce("found", "root").alias("institution"))
    return first.join(institutions, "id").select("name", "institution")


def _largest(found: DataFrame, by: list[str]) -> DataFrame:
    """The two largest institutions ``found`` of each group."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("s"), F.desc("r"), F.desc("found")))
    return found.withColumn("place", rank).where("place <= 2").drop("place")


def suited(shortened: DataFrame, family: DataFrame) -> DataFrame:
    """``id, fit``: the names that have all words and initials of one with several of them, looked up by the rarest."""
    place = ["business", "word", "letter"]
    several = shortened.where("size(long) > 0 and size(long) + size(short) > 2")
    keys = several.select("id", "business", "long", "short", F.explode("long").alias("word")).withColumn("letter", F.explode("short"))
    counts = family.join(keys.select(*place).distinct(), place, "left_semi").groupBy(*place).count()
    rarest = keys.join(counts, place).groupBy("id", "business", "long", "short").agg(F.min_by(F.struct("word", "letter"), F.struct("count", "word", "letter")).alias("k"))
    both = rarest.select("id", "business", "long", "short", "k.word", "k.letter").join(family.withColumnRenamed("id", "fit"), place)
    words = F.split("key", " ")
    rest = F.transform(F.filter(words, lambda w: ~F.array_contains("long", w)), lambda w: F.substring(w, 1, 1))
    enough = F.forall("short", lambda c: F.size(F.filter("short", lambda x: x == c)) <= F.size(F.filter(rest, lambda x: x == c)))
    return both.where(F.forall("long", lambda w: F.array_contains(words, w)) & enough).select("id", "fit").distinct()


def _counterparts(wanted: DataFrame, offered: DataFrame) -> DataFrame:
    """Rows for ``close_names`` that find, for a ``place`` wanted, those offered with a misspelling of its word."""
    offered = offered.join(wanted.select("business", "letter").distinct(), ["business", "letter"], "left_semi")
    pool = wanted.withColumn("asking", F.lit(True)).unionByName(offered.withColumn("asking", F.lit(False)))
    return pool.select(_sha("business", "word", "letter").alias("id"), F.col("word").alias("name"), F.concat_ws("\x1f", F.lit("?"), "business", "letter").alias("business"), "asking", F.struct("business", "word", "letter").alias("place"))


def best_attested(close: DataFrame) -> DataFrame:
    """``id, other``: each misspelling with the best attested name in reach, by strings, then rows; what nothing surpasses has no row.

    A name that is ``sure`` is no misspelling: it surpasses those that are not, and two of them are no pair.
    A pair counts if the longer name has ``SURE_LETTERS``; of shorter names, where one letter may tell two institutions apart,
    if the rarer is a stray (one or two strings) or half as well attested at most. Two steps are taken, as
    two misspellings of one name may be out of each other's reach.
    """
    weight = lambda p="": F.struct(F.col(f"{p}sure").alias("sure"), F.col(f"{p}strings").alias("strings"), F.col(f"{p}rows").alias("rows"), F.col("other" if p else "id").alias("id"))
    less, more = F.least("strings", "other_strings"), F.greatest("strings", "other_strings")
    told = (F.greatest("letters", "other_letters") >= SURE_LETTERS) | (less <= 2) | (more >= 2 * less)
    edges = close.where(told & ~(F.col("sure") & F.col("other_sure"))).select("id", "other", weight().alias("own"), weight("other_").alias("its"))
    step = edges.groupBy("id").agg(F.greatest(F.max("its"), F.max("own")).alias("best"))
    two = edges.join(step.select(F.col("id").alias("other"), "best"), "other").groupBy("id", "own").agg(F.max("best").alias("best"))
    return two.where("id != best.id and not own.sure").select("id", F.col("best.id").alias("other"))


def _components(links: DataFrame) -> DataFrame:
    """``id, root`` of what ``id, other`` join, in either direction: all but some roots have a row.

    One link of each ``id`` is followed to its end, which joins nearly all. Of the links that still lead from one root to
    another, each root follows that to its least neighbour, if this is less, till none is left.
    """
    links = shared_checkpoint(links.select("id", "other").where("id != other").distinct())
    found = _roots(links.groupBy("id").agg(F.min("other").alias("parent")))
    ways = _between(links, found)
    while not ways.isEmpty():
        both = ways.unionByName(ways.select(F.col("other").alias("id"), F.col("id").alias("other")))
        step = _roots(both.groupBy("id").agg(F.min("other").alias("parent")).where("parent < id"))
        ways = _between(ways, step)
        onward = step.select(F.col("id").alias("at"), F.col("root").alias("next"))
        moved = found.where("id != root").join(onward, F.col("root") == F.col("at"), "left").select("id", F.coalesce("next", "root").alias("root"))
        found = shared_checkpoint(moved.unionByName(step))
    return found


def _between(ways: DataFrame, roots: DataFrame) -> DataFrame:
    """The links from one root to another, once each."""
    onward = roots.select(F.col("id").alias("at"), F.col("root").alias("next"))
    for end in ("id", "other"):
        ways = ways.join(onward, F.col(end) == F.col("at"), "left").withColumn(end, F.coalesce("next", end)).drop("at", "next")
    return shared_checkpoint(ways.where("id != other").distinct())


def _roots(parent: DataFrame) -> DataFrame:
    """``id, root``: the links followed to their ends by doubling; a ring, of any length, ends at its least member."""
    up = shared_checkpoint(parent.select("id", "parent", F.least("id", "parent").alias("least")))
    reach = 1
    while True:
        ahead = up.select(F.col("id").alias("at"), F.col("parent").alias("next"), F.col("least").alias("their_least"))
        step = up.join(ahead, F.col("parent") == F.col("at"), "left")
        step = shared_checkpoint(step.select("id", F.coalesce("next", "parent").alias("parent"), F.least("least", F.coalesce("their_least", "least")).alias("least"), F.col("at").isNotNull().alias("open")))
        reach *= 2
        still = step.where("open").count()
        up = step.drop("open")
        if not still:
            return up.select("id", F.col("parent").alias("root"))
        if reach >= 2 * still:  # fewer links than steps: who has not come to an end has been round a ring
            ring = up.select(F.col("id").alias("at"), F.col("least").alias("their_least"))
            return up.join(ring, F.col("parent") == F.col("at"), "left").select("id", F.coalesce("their_least", "parent").alias("root"))


def with_spellings(linked: DataFrame) -> DataFrame:
    """``name, institution, spellings``, how many strings the institution has: counted by aggregate and joined, so no hot one is gathered."""
    return linked.join(linked.groupBy("institution").agg(F.count("*").alias("spellings")), "institution").select("name", "institution", "spellings")


def name_pairs(linked: DataFrame, block: int = 64) -> DataFrame:
    """``name_a, name_b`` (a before b in binary order) of all strings of an institution.

    The strings of an institution are spread over blocks of about ``block``; each string meets each
    block in a task of its own key, so that a hot institution is spread over many tasks.
    """
    sized = with_spellings(linked).where("spellings > 1")
    blocks = F.ceil(F.col("spellings") / block).cast("int")
    right = sized.select("institution", F.pmod(F.xxhash64("name"), blocks).cast("int").alias("b"), F.col("name").alias("name_b"))
    left = sized.select("institution", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("b"), F.col("name").alias("name_a"))
    return left.join(right, ["institution", "b"]).where("name_a < name_b").select("name_a", "name_b")


def institution_names(spark: SparkSession, folder: str) -> DataFrame:
    def part(table: str, column: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{table}.parquet").select(F.col(column).alias("name"))

    return part("golden_manifest", "institution_name").unionByName(part("article_quality", "institution")).unionByName(part("frozen_html_set", "institution"))


def p2_institutions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per distinct string: its institution and how many strings that has."""
    return with_spellings(shared_checkpoint(link_names(institution_names(spark, folder))))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return name_pairs(shared_checkpoint(link_names(institution_names(spark, folder))))
