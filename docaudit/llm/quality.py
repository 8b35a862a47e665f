"""Problem 8: statistics of each text, and whether it is prose, a list, a table or junk.

Method: tables show in the vertical alignment of delimiters (neighbouring lines with the
same number of cells, most of them figures), lists in a marker or indentation that returns
line after line, or in short lines without an end; the line lengths tell a list from
hard-wrapped prose, where a line ends just because the next word would not fit. Together
with the ratios of letters, symbols and sentence ends each line gets a kind; a text has the
kind with most characters.

All of it works on a row at a time, in Arrow batches: nothing is shuffled.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docaudit.session import spread

PROSE, LIST, TABLE, JUNK = "prose", "list", "table", "junk"
KINDS = (PROSE, LIST, TABLE, JUNK)
MEASURES = ["word_count", "mean_word_length", "symbol_ratio", "ended_line_share", "common_word_share", "line_length_autocorrelation", "indent_autocorrelation"]

#: Marks that end a sentence (closing quotes and brackets may follow).
END = re.compile(r"""[.。！!？?…．]["'”’»」』)）\]]*$""")
ENDISH = frozenset(".。！!？?…．\"”»」』:：;；,，)）’")
MARKER = re.compile(r"\s*(?:[•·▪◦‣●○■□◆–—*>+-]|\[[ xX✓]?\]|☐|☑|\(?\d{1,4}[.)）、]|\(\d{1,4}\)|\(?[A-Za-z][.)]|\([ivxlc]+\)|[①-⑳])\s+(?=\S)")
CELL = re.compile(r"\s*(?:[+−-]?[$€¥£]?[\d.,  '’]*\d[\d.,]*\s*[%‰]?|n\.?\s?/?a\.?|[-–—]+|:?-{3,}:?)\s*")
LONGEST_CELL = 40
CODE = re.compile(r"</?[a-zA-Z][^<>]{0,200}>|\{\{|\}\}|\b0x[0-9a-fA-F]{4,32}\b|(?<![\w.])[\w.]{1,60}\s?=\s?\S{1,80};")
BLOB = re.compile(r"[A-Za-z0-9+/=_-]{32,}")
CJK = "぀-ヿ㐀-䶿一-鿿豈-﫿ｦ-ﾟ"
HAS_CJK = re.compile(f"[{CJK}]")
WORD = re.compile(rf"[{CJK}]|(?:(?![{CJK}])[^\W_])+(?:['’](?:(?![{CJK}])[^\W_])+)*")
SEVERAL = re.compile(r"""[.?!]["'”’»)]* +[^\W\d_a-zß-öø-ÿ]|[。！？]["'”’」』]*\S""")  # a sentence end within
LETTER_RUN = re.compile(r"[^\W\d_]+")
DELIMITERS = ("\t", "|", ";", ",", "  ")
WIDE_GAP = re.compile(r" {2,}")
SYMBOL = re.compile(r"[^\w\s.,:;()%/+-]|(?<=[^\w\s])[.,:;()%/+-]")
ODD = re.compile(r"[`|\\^~_@#<>{}=]")
GARBLED = re.compile(r"[A-Za-z][01][A-Za-z]|\s[;:,.']\S|[;:,'][;:,.']|[*&%$+!?/-]{3}")
MIXED = re.compile(r"[A-Za-z][01][A-Za-z]|\s[;:,.']\S|[;:,.'`][;:,.'`]|[a-z][;:,.][a-z]|[a-z][A-Z]")
CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f�]")


def autocorrelation(values: list[int], most: int = 4) -> float:
    """The highest correlation of a sequence with itself ``lag`` places on, for lags up to ``most``; 1 if it never changes, 0 if too short."""
    n = len(values)
    if n < 6:
        return 0.0
    x = np.array(values, float)
    x -= x.mean()
    power = float(x @ x)
    if power == 0:
        return 1.0
    return max(float(x[lag:] @ x[:-lag]) / power * n / (n - lag) for lag in range(1, min(most, n // 3) + 1))


def _cells(line: str, delimiter: str) -> list[str]:
    if delimiter == "  ":
        return WIDE_GAP.split(line.strip())
    if delimiter == "|":
        return line.strip().strip("|").split("|")
    return line.split(delimiter)


def _figures(cells: list[str]) -> int:
    return sum(len(c) <= LONGEST_CELL and CELL.fullmatch(c) is not None for c in cells[1:])


def table_lines(lines: list[str]) -> list[bool]:
    """Lines that belong to rows of aligned cells: at least two in a row with mostly figures, or three with tabs or bars."""
    out = [False] * len(lines)
    for delimiter in DELIMITERS:
        if not any(delimiter in line for line in lines):
            continue
        counts = [len(_cells(line, delimiter)) if delimiter in line.strip() else 0 for line in lines]
        i = 0
        while i < len(lines):
            if counts[i] < 2:
                i += 1
                continue
            j = i
            off = delimiter == "  "  # a wide cell may touch the next one
            while j < len(lines) and (counts[j] == counts[i] or off and counts[j] > 1 and abs(counts[j] - counts[i]) == 1):
                j += 1
            if delimiter in "\t|" and j - i >= 3 and counts[i] >= 3:  # delimiters one below the other, whatever is between
                out[i:j] = [True] * (j - i)
            if j - i >= 2 and not all(out[i:j]):
                width = counts[i] - 1
                full = [_figures(_cells(line, delimiter)) * 2 > width - off for line in lines[i:j]]
                if sum(full) * 2 >= j - i and sum(full):
                    out[i:j] = [True] * (j - i)
            i = max(j, i + 1)
    return out


def repeated(text: str) -> bool:
    """A text made of one short piece over and over."""
    n = len(text)
    if n < 24:
        return False
    p = text.find(text[: min(12, n // 3)], 1)
    if 0 < p <= n // 3 and text[p:] == text[: n - p]:
        return True
    if n >= 400:  # the same with something odd in between; prose never packs that well
        raw = text.encode("utf-8", "replace")
        return len(zlib.compress(raw, 1)) < 0.05 * len(raw)
    return False


def _junk(line: str) -> bool:
    """Garbled, encoded, repeated or markup text."""
    s = line.strip()
    n = len(s)
    if n < 4:
        return not any(c.isalnum() for c in s)
    ascii_only = len(s.encode("ascii", "ignore"))
    high = len(s.encode("latin-1", "ignore")) - ascii_only if ascii_only < n else 0
    if high > 3 and (high > 0.22 * n or high > 0.1 * n and len(CONTROL.findall(s)) > 0.02 * n):
        return True
    blob = BLOB.search(s)
    odd_marks = ODD.search(s)
    if not blob and not odd_marks and not GARBLED.search(s):  # most lines
        return n >= 24 and repeated(s)
    letters = sum(map(len, LETTER_RUN.findall(s)))
    if n >= 24 and letters and repeated(s):
        return True
    marks = CODE.findall(s)
    if marks and sum(map(len, marks)) * 2 > n - 8:
        return True
    if blob:
        blobs = BLOB.findall(s)
        if sum(map(len, blobs)) * 2 > n and any(re.search("[a-z][A-Z]|[A-Za-z][0-9]|[0-9][A-Za-z]", b) for b in blobs):
            return True
    if n >= 12:
        if letters < 0.35 * n and len(SYMBOL.findall(s)) > 0.3 * n:
            return True
        odd = len(ODD.findall(s)) + len(MIXED.findall(s))
        if odd * 9 > n and n > odd * 2 and not HAS_CJK.search(s):
            return True
    return False


def wrapped(lines: list[str]) -> list[bool]:
    """Whether line i runs on in line i+1: it ends only because the next word would not fit the width.

    A line of length n before a word of length m was cut for a width from n to n + m; the
    width that most open lines share is the text's. Lists have no such width.
    """
    out = [False] * len(lines)
    spans: list[tuple[int, int, int]] = []
    for i in range(len(lines) - 1):
        a, b = lines[i].rstrip(), lines[i + 1].strip()
        if len(a) < 30 or not b or len(a) > 160 or MARKER.match(b):
            continue
        first = 1 if HAS_CJK.match(b) else len(b.split(" ", 1)[0])
        if first <= 30 and not END.search(a):
            spans.append((i, len(a), len(a) + first))
    if not spans:
        return out
    votes = np.zeros(202, np.int32)
    for _, low, high in spans:
        votes[low - 1 : high + 2] += 1
    votes[:45] = 0
    width = int(votes.argmax())
    good = [i for i, low, high in spans if low - 3 <= width <= high + 1]
    near = sum(low >= 0.6 * width for _, low, _ in spans)
    last = max((i for i, line in enumerate(lines) if line.strip()), default=0)
    stray = sum(0 < len(a) < 0.6 * width and i != last and not MARKER.match(a) and not END.search(a) for i, a in enumerate(map(str.rstrip, lines)))
    if stray > len(good):  # wrapped text has short open lines only for headings
        return out
    beyond = sum(width + 3 < len(line.rstrip()) <= 160 for line in lines)
    if not votes[width] or len(good) * 20 < 13 * near or beyond * 6 > len(good) or len(good) == 1 and width > 100:
        return out
    for i in good:
        out[i] = True
    for i in range(len(lines) - 1):
        a, b = lines[i].rstrip(), lines[i + 1].strip()
        if not out[i] and b and abs(len(a) - width) <= 0.35 * width and (END.search(a) or out[i - 1 if i else 0]) and not MARKER.match(b):
            out[i] = len(a) + 1 + len(b.split(" ", 1)[0]) > width
    return out


def _items(line: str) -> bool:
    """An enumeration on one line: many short items, no sentence."""
    s = line.strip()
    if END.search(s) and not HAS_CJK.search(s[-1:]) and len(s) > 3 and s.count(". ") + s.count("。"):
        return False
    best = max((s.count(d) for d in ",，;；、|"), default=0)
    if best < 4:
        return False
    for d in "|;；,，、":
        if s.count(d) >= 4:
            items = [x.strip() for x in s.split(d)]
            short = [x for x in items if x and (len(x) <= 16 if HAS_CJK.search(x) else x.count(" ") <= 5 and len(x) <= 48)]
            if len(short) >= 0.9 * len(items) and not re.search(r"[.。!?！？] ?\S", s.replace("n.a.", "")):
                return True
    return False


def line_kinds(text: str) -> tuple[list[str], list[str | None]]:
    """The lines of a text, what stands between line feeds, and the kind of each; None for blank ones."""
    lines = text.split("\n")
    kinds: list[str | None] = [None] * len(lines)
    if "\t" in text or "|" in text or ";" in text or "," in text or "  " in text:
        tables = table_lines(lines)
    else:
        tables = [False] * len(lines)
    runs_on = wrapped(lines) if len(lines) > 1 else [False]
    filled = [i for i, line in enumerate(lines) if line.strip()]
    open_lines: list[int] = []
    marked: list[int] = []
    ended = 0
    for i in filled:
        line = lines[i]
        if tables[i]:
            kinds[i] = TABLE
            continue
        n = len(line)
        marker = MARKER.match(line)
        within = runs_on[i] or i > 0 and runs_on[i - 1]
        if _junk(line[marker.end() :] if marker else line):
            kinds[i] = JUNK
        elif marker and not (i and (runs_on[i - 1] or _continues(lines[i - 1], line))):
            kinds[i] = PROSE
            marked.append(i)
        elif _items(line) and not within:
            kinds[i] = LIST
        else:
            kinds[i] = PROSE
            s = line.rstrip()
            if END.search(s):
                ended += 1
            elif not within and (n <= 40 if HAS_CJK.search(line) else n <= 110 and line.count(" ") <= 14):
                open_lines.append(i)
    place = {i: p for p, i in enumerate(filled)}
    _mark_items(lines, kinds, marked, runs_on, place)
    _mark_open(lines, kinds, open_lines, filled, place, ended)
    return lines, kinds


def _continues(before: str, line: str) -> bool:
    """Whether a line that begins with a letter and a full stop, as ``u. a.``, goes on with the open line before it, which is no item."""
    a = before.rstrip()
    return len(a) >= 45 and line.lstrip()[:1].isalpha() and not END.search(a) and not MARKER.match(before)


def _mark_items(lines: list[str], kinds: list, marked: list[int], runs_on: list[bool], place: dict[int, int]) -> None:
    """Marked lines are items where the marker returns: with the next filled line, or with what hangs on the item in between."""
    quoted = [i for i in marked if lines[i].lstrip().startswith(">")]
    if quoted and sum(SEVERAL.search(lines[i]) is not None for i in quoted) * 2 >= len(quoted):
        marked = [i for i in marked if i not in set(quoted)]  # a letter quoted in paragraphs, not items
    beside = set()
    for a, b in zip(marked, marked[1:], strict=False):
        if place[b] - place[a] == 1 or all(runs_on[k] for k in range(a, b - 1)) and runs_on[a]:
            beside |= {a, b}
    for i in marked:
        s = lines[i].rstrip()
        sentence = END.search(s) and (len(s) >= 20 if HAS_CJK.search(s) else s.count(" ") >= 7)
        if i in beside or len(marked) > 1 and not sentence:
            kinds[i] = LIST
            k = i
            while i in beside and k + 1 < len(lines) and runs_on[k] and k + 1 not in marked:  # an item that is wrapped
                k += 1
                kinds[k] = LIST
        elif len(marked) == 1 and not sentence and len(lines[i]) <= 80 and not END.search(s):
            kinds[i] = LIST


def _mark_open(lines: list[str], kinds: list, open_lines: list[int], filled: list[int], place: dict[int, int], ended: int) -> None:
    """Short lines without an end are items where something recurs: indentation, line length, or they themselves, line after line.

    The ratio of lines that end a sentence decides how much must recur: where hardly any does, the items may stand apart.
    """
    if not open_lines:
        return
    most = len(open_lines) * 2 > len(filled)
    if most:
        longest_item = max(4, len(filled) // 3)
        indents = [len(lines[i]) - len(lines[i].lstrip(" \t")) for i in filled]
        lengths = [len(lines[i].strip()) for i in filled]
        if any(indents) and autocorrelation(indents) > 0.7 or autocorrelation(lengths, longest_item) > 0.7:
            for i in open_lines:
                kinds[i] = LIST
            return
    apart = len(open_lines) >= 3 and ended * 5 < len(open_lines)  # hardly a sentence: blank lines between items do not matter
    run: list[int] = []
    for i in [*open_lines, -1]:
        if run and (i < 0 or place[i] != place[run[-1]] + 1 or not apart and any(not lines[k].strip() for k in range(run[-1] + 1, i))):
            if len(run) >= 3:
                for k in run:
                    kinds[k] = LIST
            run = []
        if i >= 0:
            run.append(i)


def kind_of(text: str | None) -> str | None:
    """``prose``, ``list``, ``table`` or ``junk``, by characters; None without text."""
    if text is None or not text.strip():
        return None
    if repeated(text.strip()):
        return JUNK
    sums = dict.fromkeys(KINDS, 0)
    lines, kinds = line_kinds(text)
    for line, kind in zip(lines, kinds, strict=True):
        if kind:
            sums[kind] += len(line.strip())
    return max(KINDS, key=lambda k: sums[k])


def text_statistics(text: str | None, common: frozenset[str], common_cjk: re.Pattern | None) -> tuple:
    """words, mean word length, symbol ratio, shares of lines that end in punctuation and of common words, autocorrelation of line lengths and of indentations."""
    if text is None or not text.strip():
        return 0, None, None, None, None, None, None
    words = WORD.findall(text)
    n = len(words)
    solid = sum(map(len, text.split()))
    alnum = sum(map(len, words))
    lines = [s for s in map(str.rstrip, text.split("\n")) if s.strip()]
    ends = sum(END.search(s) is not None for s in lines)
    hits = sum(w in common for w in map(str.lower, words)) + (sum(len(m) for m in common_cjk.findall(text)) if common_cjk else 0)
    lengths, indents = [len(s) for s in lines], [len(s) - len(s.lstrip()) for s in lines]
    return n, alnum / n if n else None, 1 - alnum / solid, ends / len(lines), hits / n if n else None, autocorrelation(lengths), autocorrelation(indents)


def text_quality(df: DataFrame, words: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, word_count, mean_word_length, symbol_ratio, ended_line_share, common_word_share,
    line_length_autocorrelation, indent_autocorrelation, kind`` of each row.

    A word is a run of letters and digits, or a single ideograph or kana. ``words`` are the
    common words of all languages. Null, empty and blank texts have 0 words and null else.
    ``ended_line_share`` counts lines that are not blank. Repeated rows count like others.
    """
    spaced = frozenset(w.lower() for w in words if w and not HAS_CJK.search(w))
    joined = sorted((w for w in words if w and HAS_CJK.search(w)), key=len, reverse=True)
    pattern = re.compile("|".join(map(re.escape, joined))) if joined else None
    schema = f"{key} {df.schema[key].dataType.simpleString()}, word_count long, mean_word_length double, symbol_ratio double, ended_line_share double, common_word_share double, line_length_autocorrelation double, indent_autocorrelation double, kind string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            texts = rows[text].tolist()
            found = [text_statistics(t, spaced, pattern) for t in texts]
            out = pd.DataFrame(found, columns=MEASURES, index=rows.index)
            out.insert(0, key, rows[key])
            out["word_count"] = out["word_count"].astype(np.int64)
            yield out.assign(kind=[kind_of(t) for t in texts])

    return spread(df.select(key, text)).mapInPandas(run, schema)


def text_kinds(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, kind`` of each row; kind is null without text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({key: rows[key], "kind": [kind_of(t) for t in rows[text]]})

    return spread(df.select(key, text)).mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, kind string")


def common_words(spark, folder: str) -> list[str]:
    """The words of the fixed table common_words (150 rows, does not grow)."""
    return sorted({r.word for r in spark.read.parquet(f"{folder}/common_words.parquet").select("word").collect() if r.word})


def p8_statistics(spark, folder: str) -> DataFrame:
    return text_quality(spark.read.parquet(f"{folder}/documents.parquet"), common_words(spark, folder))


def p8_found(spark, folder: str) -> DataFrame:
    return text_kinds(spark.read.parquet(f"{folder}/documents.parquet")).where(F.col("kind") != PROSE)
