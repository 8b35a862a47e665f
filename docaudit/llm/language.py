"""Problem 1: the language of each text and of each segment of a mixed one, with a confidence.

Method: error-correcting output codes. Each language has a codeword; one binary n-gram
classifier per bit says on which side of that bit a text stands; loss-weighted decoding
takes the language whose codeword costs least, and a small lead is flagged as ambiguous.

The bit classifiers are log-odds of hashed character n-grams, fitted on a bounded sample
of labelled texts (``SAMPLE_TEXTS``); their labels are noisy, so the fit is repeated on
what the first fits say. Texts are scored line by line: the n-gram sums of a word are kept
in a table per worker, a line is the sum of its words. The lines of a text are joined into
segments by the cheapest path through the languages, each change having a price.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docaudit.llm import quality
from docaudit.session import spread

LANGUAGES = ("en", "zh", "de", "fr", "es", "ja")
OTHER = "other"  # running words in none of these languages

#: Spellings of labels besides the codes themselves (fixed values).
LABELS = {
    "en": "eng english anglais englisch inglés 英文 英语 英語",
    "zh": "chi zho cmn chinese mandarin hans hant cn tw 中文 汉语 漢語 中国語",
    "de": "ger deu german deutsch allemand 德语 德文",
    "fr": "fra fre french français francais 法语 法文",
    "es": "spa spanish español espanol castellano 西班牙语",
    "ja": "jpn jp japanese 日本語 日语 日文",
}

BITS = 15
BUCKETS = 1 << 15
SAMPLE_TEXTS = 2_000
SAMPLE_CHARS = 4_000  # of a text of the sample
SWITCH = 22.0  # price of a change of language between two lines
UNKNOWN_WORD = 0.35  # weight of a word that the sample has hardly seen, such as a name
UNIT_TABLE = 300_000
LONG_WORD = re.compile("[a-zà-öø-ɏ]{31}")
FOREIGN = "\u0370-\u1dff\ua000-\ud7ff"  # letters of scripts that none of the languages is written in, from Greek to Hangul
UNIT = re.compile(f"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f]|[a-zà-öø-ɏ]+(?:['’][a-zà-öø-ɏ]+)?|[{FOREIGN}]+")
FEW_WORDS, FEW_LETTERS = 10, 12  # fewer cannot tell an unknown language from names or a stray
STRANGE = 0.3  # a language is not the text's if so much smaller a share of the words is known than in its sample
TEMPERATURES = (0.5, 0.7, 1, 1.4, 2, 2.8, 4, 5.6, 8, 11, 16, 23, 32)


def codewords(classes: int = len(LANGUAGES), bits: int = BITS, seed: int = 11) -> np.ndarray:
    """A code of +1 and -1 with the largest least distance found among random splits of the classes."""
    splits = [s for s in range(1, 1 << (classes - 1))]
    rng = np.random.default_rng(seed)
    best, best_distance = None, -1
    for _ in range(300):
        chosen = rng.choice(splits, bits, replace=False)
        code = np.where((chosen[None, :] >> np.arange(classes)[:, None]) & 1, 1, -1)
        distance = min(int((code[a] != code[b]).sum()) for a in range(classes) for b in range(a))
        if distance > best_distance:
            best, best_distance = code, distance
    return best.astype(np.float32)


def unit_features(unit: str) -> list[int]:
    """Hash buckets of a unit's n-grams: an ideograph or kana, or a word with its ends marked."""
    if _foreign(unit):
        return []
    if ord(unit[0]) >= 0x3000:
        block = "kana" if unit[0] < "㐀" or unit[0] >= "ｦ" else "han"
        return [zlib.crc32(unit.encode()) % BUCKETS, zlib.crc32(block.encode()) % BUCKETS]
    padded = f"<{unit}>"
    grams = {padded[i : i + n] for n in (2, 3, 4) for i in range(max(1, len(padded) - n + 1))}
    return [zlib.crc32(g.encode()) % BUCKETS for g in [*grams, padded]]


def _foreign(unit: str) -> bool:
    return 0x370 <= ord(unit[0]) < 0x3000 or 0xA000 <= ord(unit[0]) < 0xD800


def _folded(unit: str) -> int:
    """A word without accents, as some texts are, by a hash."""
    return zlib.crc32("".join(c for c in unicodedata.normalize("NFKD", unit) if not unicodedata.combining(c)).encode())


class LanguageModel:
    """Bit classifiers, their decoding, the words of each language and how far a lead may be trusted."""

    def __init__(self, weights: np.ndarray, reliability: np.ndarray, words: frozenset[int] = frozenset(), vocabulary: list[frozenset[int]] | None = None, usual: list[float] | None = None, temperature: float = 4.0):
        self.code = codewords()
        self.weights, self.reliability, self.words = weights, reliability, words
        self.vocabulary, self.usual, self.temperature = vocabulary, usual, temperature
        self.reset()

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("weights", "reliability", "words", "vocabulary", "usual", "temperature")}

    def __setstate__(self, state):
        self.__init__(**state)

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.vectors = np.zeros((1 << 12, BITS + len(LANGUAGES) + 3), np.float32)

    def _add(self, unit: str) -> int:
        k = len(self.known)
        if k == len(self.vectors):
            self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
        grams = self.weights[unit_features(unit)]
        wide = ord(unit[0]) >= 0x3000
        trust = 0.6 if wide else 1.0 if zlib.crc32(unit.encode()) in self.words else UNKNOWN_WORD
        self.vectors[k, :BITS] = np.clip(grams.sum(0) / (2 if wide else 4), -2.5, 2.5) * trust
        latin = ord(unit[0]) < 0x370
        folded = _folded(unit) if latin and self.vocabulary else 0
        known = [latin and folded in own for own in self.vocabulary or [()] * len(LANGUAGES)]
        self.vectors[k, BITS:] = [*known, latin, len(unit) if _foreign(unit) else 0, len(unit)]
        self.known[unit] = k
        return k

    def sums(self, lines: list[list[str]]) -> np.ndarray:
        """The bit scores of lines given as units."""
        return self.measures(lines)[:, :BITS]

    def measures(self, lines: list[list[str]]) -> np.ndarray:
        """Of lines given as units the bit scores, the words known in each language, those in Latin letters, foreign letters, all letters."""
        if len(self.known) > UNIT_TABLE:
            self.reset()
        known = self.known
        units = [u for line in lines for u in line]
        found = list(map(known.get, units))
        if None in found:
            for i, k in enumerate(found):
                if k is None:
                    k = known.get(units[i])
                    found[i] = self._add(units[i]) if k is None else k
        out = np.zeros((len(lines), self.vectors.shape[1]))
        sizes = np.array([len(line) for line in lines], np.int64)
        some = np.flatnonzero(sizes)
        if len(some):
            starts = (np.cumsum(sizes) - sizes)[some]
            out[some] = np.add.reduceat(self.vectors[np.array(found, np.int64)], starts, axis=0)
        return out

    def known_share(self, units: list[str], language: int) -> tuple[float, int]:
        """The share of the words in Latin letters that the sample has in a language, and how many they are."""
        latin = [u for u in units if ord(u[0]) < 0x370]
        own = self.vocabulary[language] if self.vocabulary else frozenset()
        return sum(_folded(u) in own for u in latin) / max(1, len(latin)), len(latin)

    def strange(self, measures: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the words of each line, decoded as a language, are of none here: a script of its own, or far fewer known words
        than usual; and whether they are too few to say."""
        latin, foreign, letters = measures[:, -3], measures[:, -2], measures[:, -1]
        few = latin < FEW_WORDS
        out = (foreign >= FEW_LETTERS) & (foreign * 2 > letters)
        if self.vocabulary:
            share = measures[np.arange(len(tops)), BITS + tops] / np.maximum(latin, 1)
            spaced = np.array([x not in ("zh", "ja") for x in LANGUAGES])
            out |= spaced[tops] & ~few & (share < STRANGE * np.array(self.usual)[tops])
        return out, few

    def probability(self, scores: np.ndarray) -> np.ndarray:
        """How likely each language is, given what the losses were worth on texts the classifiers had not seen."""
        chance = np.exp((scores - scores.max(-1, keepdims=True)) / self.temperature)
        return chance / chance.sum(-1, keepdims=True)

    def decode(self, sums: np.ndarray) -> np.ndarray:
        """For each row of bit scores the negative weighted loss of each language's codeword."""
        signed = self.code[None, :, :] * sums[:, None, :]
        return -(np.logaddexp(0, -signed) * self.reliability).sum(2)


def fit(texts: list[str], labels: list[str], rounds: int = 3) -> LanguageModel:
    """Bit classifiers from labelled texts; labels that the others contradict are replaced in each round.

    A fifth of the texts is then left out of one more fit, to see how often a lead of which size is right:
    the temperature that makes the confidence of its single lines most likely goes with the model.
    """
    labels = np.array([LANGUAGES.index(x) for x in labels], np.int64)
    units = [UNIT.findall(text[:SAMPLE_CHARS].lower()) for text in texts]
    model, current = _fitted(units, labels, rounds)
    held = np.arange(len(texts)) % 5 == 4
    if held.any() and not held.all():
        part, _ = _fitted([u for u, h in zip(units, held, strict=True) if not h], current[~held], 1)
        # what a whole text and its label agree on is taken as true of its lines; short pieces of them show doubt
        pieces, truth = [], []
        for k in np.flatnonzero(held & (current == labels)).tolist():
            if model.decode(model.sums([units[k]]))[0].argmax() == labels[k]:
                for size in (1, 2, 4, 8, 16):
                    for piece in (units[k][:size], units[k][-size:]):
                        if len(piece) == size:
                            pieces.append(piece)
                            truth.append(labels[k])
        if pieces:
            scores = part.decode(part.sums(pieces))
            def surprise(t: float) -> float:
                part.temperature = t
                return float(-np.log(np.maximum(part.probability(scores)[np.arange(len(truth)), truth], 1e-9)).mean())

            model.temperature = min(TEMPERATURES, key=surprise)
    return model


def _fitted(texts: list[list[str]], labels: np.ndarray, rounds: int) -> tuple[LanguageModel, np.ndarray]:
    """The classifiers fitted on texts given as units, and the labels after ``rounds`` of replacing those that do not fit."""
    code = codewords()
    table: dict[str, int] = {}
    owners = [np.array([table.setdefault(u, len(table)) for u in units], np.int64) for units in texts]
    features = [unit_features(u) for u in table]
    flat = np.array([f for fs in features for f in fs], np.int64)
    of_unit = np.repeat(np.arange(len(features)), [len(fs) for fs in features])
    wide = np.array([ord(u[0]) >= 0x3000 for u in table], bool)
    latin = np.array([ord(u[0]) < 0x370 for u in table], bool)
    model = None
    current, keep = labels.copy(), np.ones(len(texts), bool)
    for _ in range(rounds):
        by_unit = np.zeros((max(1, len(table)), len(LANGUAGES)))
        for k, units in enumerate(owners):
            if keep[k] and len(units):
                ids, n = np.unique(units, return_counts=True)
                mine = wide[ids] == (2 * n[wide[ids]].sum() > n.sum())  # names in another script say nothing of the language
                by_unit[ids[mine], current[k]] += np.minimum(n[mine], 3)
        counts = np.zeros((BUCKETS, len(LANGUAGES)))
        for c in range(len(LANGUAGES)):
            counts[:, c] = np.bincount(flat, by_unit[of_unit, c], BUCKETS) if len(flat) else 0
        share = counts / np.maximum(counts.sum(0), 1) * 20_000  # languages weigh the same, however many texts each has
        # each side of a bit is as likely to use an n-gram as the language of it that uses it most
        plus = np.stack([share[:, code[:, b] > 0].max(1) for b in range(BITS)], 1)
        minus = np.stack([share[:, code[:, b] < 0].max(1) for b in range(BITS)], 1)
        weights = np.log((plus + 0.3) / (minus + 0.3)).astype(np.float32)
        weights[counts.sum(1) == 0] = 0
        words = frozenset(zlib.crc32(u.encode()) for k, u in enumerate(table) if latin[k] and by_unit[k].sum() >= 3)
        model = LanguageModel(weights, np.ones(BITS, np.float32), words)
        sums = model.sums(texts)
        wrong = (np.sign(sums) != code[current]).mean(0) if len(texts) else np.zeros(BITS)
        model.reliability = np.clip(1 - 2 * wrong, 0.2, 1).astype(np.float32)
        scores = model.decode(sums)
        current = scores.argmax(1)
        ordered = np.sort(scores, axis=1)
        keep = ordered[:, -1] - ordered[:, -2] > 5
    if model is not None:
        folded = {u: _folded(u) for k, u in enumerate(table) if latin[k]}
        # a word belongs to a language that uses it at least a fifth as often as the one that uses it most
        often = by_unit / np.maximum(by_unit.sum(0), 1)
        belongs = (by_unit >= 3) & (often * 5 >= often.max(1, keepdims=True))
        model.vocabulary = [frozenset(folded[u] for u, k in table.items() if latin[k] and belongs[k, c]) for c in range(len(LANGUAGES))]
        shares = [[model.known_share(texts[k], c)[0] for k in np.flatnonzero(keep & (current == c)).tolist()[:200]] for c in range(len(LANGUAGES))]
        model.reset()  # what is kept of a word tells which languages have it
        model.usual = [float(np.median(x)) if x else 0.0 for x in shares]
    return model, current


def normal_label(label: Column) -> Column:
    """The code that a label spells; null where it is missing or no language here."""
    text = F.lower(F.trim(label))
    first = F.element_at(F.split(text, "[-_ (]"), 1)
    out = F.lit(None).cast("string")
    for code, names in LABELS.items():
        spellings = [code, *names.split()]
        out = F.when(text.isin(spellings) | first.isin(spellings), code).otherwise(out)
    return out


def _cheapest(scores: np.ndarray, switch: float) -> np.ndarray:
    """The language of each line along the cheapest path."""
    best, back = scores[0].copy(), np.zeros(scores.shape, np.int64)
    stay = np.arange(scores.shape[1])
    for i in range(1, len(scores)):
        top = int(best.argmax())
        change = best[top] - switch > best
        back[i] = np.where(change, top, stay)
        best = np.where(change, best[top] - switch, best) + scores[i]
    out = np.zeros(len(scores), np.int64)
    out[-1] = int(best.argmax())
    for i in range(len(scores) - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def _is_sentence(line: str, units: list[str]) -> bool:
    """Whether a line is running text by itself: it ends like a sentence and has enough words for one."""
    return quality.END.search(line.rstrip()) is not None and len(units) >= (15 if ord(units[0][0]) >= 0x3000 else 7)


def text_segments(texts: list[str | None], model: LanguageModel, switch: float = SWITCH) -> list[list[tuple[int, str, float, bool, int]]]:
    """Of each text its segments: first line (from 1), language, confidence, whether ambiguous, words."""
    lines: list[list[str]] = []
    numbers: list[list[int]] = []
    for text in texts:
        mine: list[int] = []
        if text and not text.isspace():
            lowered = text.lower()
            found = [UNIT.findall(line) for line in lowered.split("\n")]
            letters = sum(sum(map(len, units)) for units in found)
            solid = len(text) - text.count(" ") - text.count("\n")
            kinds = None
            if letters < 0.82 * solid or LONG_WORD.search(lowered) or text.count("|") + text.count("\t") > 3 or quality.repeated(text.strip()):
                _, kinds = quality.line_kinds(text) if not quality.repeated(text.strip()) else (None, [quality.JUNK] * len(found))
            words = 0
            rows: list[list[str]] = []
            for i, units in enumerate(found):
                if kinds and kinds[i] in (quality.JUNK, quality.TABLE):
                    continue
                if units:
                    rows.append(units)
                    mine.append(i + 1)
                    words += len(units)
            figures = sum(k == quality.TABLE for k in kinds) if kinds else 0
            garbled = sum(k == quality.JUNK for k in kinds) if kinds else 0
            if figures and words < 0.5 * sum(map(len, found)) and figures >= len(mine) or garbled > len(mine):
                # the heading of a table of figures is no running text, but a sentence beside it is
                kept = [k for k, i in enumerate(mine) if _is_sentence(text.split("\n")[i - 1], rows[k])] if figures >= garbled else []
                mine, rows = [mine[k] for k in kept], [rows[k] for k in kept]
            lines.extend(rows)
        numbers.append(mine)
    measures = model.measures(lines)
    sums = measures[:, :BITS]
    scores = model.decode(sums)
    tops = scores.argmax(1) if len(lines) else np.zeros(0, np.int64)
    all_strange, all_few = model.strange(measures, tops)
    out = []
    at = 0
    for mine in numbers:
        n = len(mine)
        segments: list[tuple[int, str, float, bool, int]] = []
        if n:
            strange = all_strange[at : at + n]
            if (tops[at : at + n] == tops[at]).all() and (strange == strange[0]).all():
                path = np.full(n, len(LANGUAGES) if strange[0] else tops[at])
            else:  # one more column: a line is strange, is not, or has too few words to say
                top, few = scores[at : at + n].max(1), all_few[at : at + n]
                path = _cheapest(np.column_stack([scores[at : at + n], np.where(strange, top + 2 * switch, np.where(few, top - 1.5 * switch, top - 2 * switch))]), switch)
            cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), n]
            for a, b in zip(cuts, cuts[1:], strict=False):
                total = model.decode(sums[at + a : at + b].sum(0, keepdims=True))[0]
                if path[a] < len(LANGUAGES):
                    confidence = float(model.probability(total)[path[a]])
                    segments.append((mine[a], LANGUAGES[path[a]], confidence, confidence < 0.8, sum(map(len, lines[at + a : at + b]))))
                else:
                    nearest, units = int(total.argmax()), [u for line in lines[at + a : at + b] for u in line]
                    segments.append((mine[a], OTHER, 1 - float(model.probability(total)[nearest]) * model.known_share(units, nearest)[0], True, len(units)))
        out.append(segments)
        at += n
    return out


def labelled_sample(items: DataFrame, label: str, text: str, texts: int = SAMPLE_TEXTS) -> tuple[list[str], list[str]]:
    """About ``texts`` labelled texts, chosen by hash: at most twice as many reach the driver, cut at SAMPLE_CHARS."""
    rows = items.select(F.substring(text, 1, SAMPLE_CHARS).alias("t"), normal_label(F.col(label)).alias("l"))
    total = max(1, items.count())
    share = min(1.0, 1.3 * texts / total)
    chosen = rows.where(F.pmod(F.xxhash64("t"), F.lit(1_000_000)) < int(share * 1_000_000)).where("l is not null and length(t) > 20")
    chosen = chosen.dropDuplicates(["t"]).limit(2 * texts).collect()  # copies have one hash and must not fill the sample
    return [r.t for r in chosen], [r.l for r in chosen]


def language_segments(items: DataFrame, model: LanguageModel, label: str = "label", text: str = "text", keys: tuple[str, ...] = ("item_kind", "item_id"), switch: float = SWITCH) -> DataFrame:
    """``keys, first_line int, language, confidence, ambiguous, words, label, is_case`` of each segment of each item.

    ``label`` comes out as the code it spells (null where missing). ``is_case``: the label is
    missing or another language, or the text has several. Running words in none of the languages are
    ``other``, flagged as ambiguous. The confidence is calibrated on texts left out of the fit. Null,
    empty and blank texts, tables of figures and junk have no segments. Repeated rows count like all others; extra columns are dropped.
    """
    kept = ", ".join(f"`{k}` {items.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kept}, first_line int, language string, confidence double, ambiguous boolean, words int, label string, is_case boolean"
    source = items.select(*keys, normal_label(F.col(label)).alias("__label"), F.col(text).alias("__text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in range(0, len(batch), 512):
                rows = batch.iloc[first : first + 512]
                out = []
                columns = [rows[k].tolist() for k in keys]
                labels = rows["__label"].tolist()
                for i, segments in enumerate(text_segments(rows["__text"].tolist(), model, switch)):
                    given = labels[i]
                    case = len({s[1] for s in segments}) > 1 or any(s[1] != given for s in segments)
                    out.extend((*(c[i] for c in columns), *s, given, case) for s in segments)
                yield pd.DataFrame(out, columns=[*keys, "first_line", "language", "confidence", "ambiguous", "words", "label", "is_case"])

    return spread(source).mapInPandas(run, schema)


def p1_items(spark, folder: str) -> DataFrame:
    def part(table: str, kind: str, key: str, label: str, text: str) -> DataFrame:
        rows = spark.read.parquet(f"{folder}/{table}.parquet")
        return rows.select(F.lit(kind).alias("item_kind"), F.col(key).cast("string").alias("item_id"), F.col(label).alias("label"), F.col(text).alias("text"))

    return (
        part("documents", "document", "doc_id", "lang", "text")
        .unionByName(part("article_quality", "article", "article_id", "language", "text_preview"))
        .unionByName(part("frozen_html_set", "frozen", "sample_id", "language", "title"))
    )


def p1_segments(spark, folder: str) -> DataFrame:
    items = p1_items(spark, folder)
    return language_segments(items, fit(*labelled_sample(items, "label", "text")))


def item_languages(segments: DataFrame, keys: tuple[str, ...] = ("item_kind", "item_id")) -> DataFrame:
    """``keys, language, confidence, languages``: the language of most words of each item, how sure it is, and how
    many languages the item has. The confidence is that of its segments times the share of its words."""
    by_language = segments.groupBy(*keys, "language").agg(F.sum("words").alias("words"), (F.sum(F.col("confidence") * F.col("words")) / F.sum("words")).alias("sure"))
    best = by_language.groupBy(*keys).agg(F.max_by(F.struct("language", "words", "sure"), F.struct("words", "language")).alias("b"), F.sum("words").alias("all"), F.count("*").cast("int").alias("languages"))
    return best.select(*keys, F.col("b.language").alias("language"), (F.col("b.sure") * F.col("b.words") / F.col("all")).alias("confidence"), "languages")


def p1_languages(spark, folder: str) -> DataFrame:
    return item_languages(p1_segments(spark, folder))


def p1_found(spark, folder: str) -> DataFrame:
    return p1_segments(spark, folder).where("is_case").select("item_kind", "item_id", "first_line", "language")
