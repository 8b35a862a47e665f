"""Problem 5: items larger than a limit into overlapping pieces that end where the text pauses.

Method: byte ranges with halos. An item, a text in a row or a file, is a sequence of byte ranges.
Each range is read with a halo on either side, its breaks are found there with their kind, and
only breaks that some piece could end at are kept. The tables of an item's ranges are stitched by
prefix sums of their lengths, and the chain of pieces is walked over the stitched table, so that
the pieces come out as offsets. The ranges of a file are read by different workers, and nobody
loads it as a whole; those of a text in a row, which is in memory anyway, are read one after
another where the row is, without a shuffle.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docaudit.session import spread

PARAGRAPH, LINE, SENTENCE, SPACE = 3, 2, 1, 0

#: Abbreviations after which a sentence never ends (fixed values).
NEVER = frozenset(
    "i.e e.g vs cf fig figs no nos est approx prev sec vol pp ch eq ref refs dr mr mrs ms prof st mt gen col sgt rev hon "
    "jan feb mar apr jun jul aug sep sept oct nov dec "
    "nr abb bzw ca vgl evtl ggf inkl zzgl sog bspw zb d.h z.b u.a u.u s.o s.u str tab kap art abs ziff jg hrsg mind max min "
    "env ex ej p.ex c.-à-d m mme mlle art chap éd fr "
    "aprox núm num pág págs cap fig p.ej sr sra srta dña ee aprox tel".split()
)
#: Abbreviations that may also end a sentence (fixed values).
COMPANY = frozenset("corp inc ltd co bros plc llc gmbh cie cía".split())
PLACES = frozenset("u.s u.k u.n e.u d.c u.s.a uu a.m p.m".split())
AMOUNTS = frozenset("mio mrd tsd bn mn mill md".split())
#: What often follows the name of a state within a sentence (fixed values).
OFFICIAL = frozenset("treasury treasuries federal fed congress senate government dollar department president supreme bureau house army navy air bank economy equities".split())
ORDINAL_BEFORE = frozenset("im am zum vom der des dem den das die seit ab bis beim ins".split())

CLOSERS = "\"'”’»」』）)】》〉]"
ENDERS = ".!?…。！？｡．"
_SPACE = np.array([chr(i).isspace() for i in range(0x3001)] + [False])
_CLOSE = np.array(sorted(map(ord, CLOSERS)), np.uint32)
_END = np.array(sorted(map(ord, ENDERS)), np.uint32)
_FULL_END = np.array(sorted(map(ord, "。！？｡．")), np.uint32)
CONTEXT = 48
TEXT_RANGE = 1 << 15  # bytes of a range of a text in a row
HALO = 1024
NEXT = re.compile(r"[\"'“‘«„(\[¿¡]*([^\W_]+)")


def _is(codes: np.ndarray, members: np.ndarray) -> np.ndarray:
    return np.isin(codes, members)


def really_ends(before: str, after: str) -> bool:
    """Whether a sentence ends between ``before``, up to its closing quotes, and ``after``, which follows white space."""
    stem = before.rstrip(CLOSERS)
    if not stem:
        return False
    quoted = len(stem) < len(before)
    mark = stem[-1]
    nxt = after[:1]
    if mark in "。！？｡．":
        return True
    if nxt.islower():
        return False
    if mark in "!?":
        return True
    if mark == "…" or stem.endswith(".."):
        return bool(nxt)
    words = stem[:-1].rsplit(None, 2)
    token = words[-1] if words else ""
    token = token.lstrip("\"'“‘«„([¿¡-–—")
    if "'" in token or "’" in token:  # an elided article, as in l'art.
        token = re.split("['’]", token)[-1]
    low = token.lower()
    follows = NEXT.match(after)
    word = follows.group(1) if follows else ""
    shouted = len(word) > 1 and word.isupper() and stem[:-1].upper() == stem[:-1] and any(c.isalpha() for c in stem)
    if low in PLACES:
        if word.lower() in OFFICIAL:
            return False
        return not (shouted and low == "uu")
    if quoted and low not in NEVER:
        return True
    if low == "etc":
        return True
    if low in COMPANY:
        return not shouted and not word[:1].isdigit()
    if low in AMOUNTS:
        return not (re.fullmatch(r"[A-Z]{3}|[Ee]uro|[Dd]ollar|[Ff]ranken", word) or after[:1] in "€$£¥")
    if low in NEVER:
        return False
    if len(token) == 1 and token.isalpha():
        return False
    if re.fullmatch(r"(?:[^\W\d_]\.)+[^\W\d_]", token):
        return False
    if token.isdigit() and len(token) <= 2:
        line_start = before.rstrip(CLOSERS)[:-1].endswith("\n" + token) or len(words) == 1 and len(before) < CONTEXT
        if line_start or len(words) > 1 and words[-2].lower() in ORDINAL_BEFORE:
            return False
    return True


def boundaries(text: str) -> tuple[np.ndarray, np.ndarray]:
    """All breaks of a text: their positions, ascending, and their kinds. A break lies after all its white space."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int8)
    space = _SPACE[np.minimum(codes, 0x3001)]
    edge = np.diff(space.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lines = np.concatenate([[0], np.cumsum(codes == 10)])
    breaks = lines[ends] - lines[starts]
    kinds = np.where(breaks >= 2, PARAGRAPH, np.where(breaks == 1, LINE, SPACE)).astype(np.int8)
    closing = _is(codes, _CLOSE)
    # sentence ends before white space: step back over all closing quotes
    last_open = np.maximum.accumulate(np.where(closing, -1, np.arange(n)))
    back = np.where(starts > 0, last_open[np.maximum(starts - 1, 0)], -1)
    for k in np.flatnonzero((breaks == 0) & (back >= 0) & _is(codes[np.maximum(back, 0)], _END)).tolist():
        s, e, mark = int(starts[k]), int(ends[k]), int(back[k])
        if really_ends(text[max(0, mark + 1 - CONTEXT) : s], text[e : e + 24]):
            kinds[k] = SENTENCE
    # full-width sentence ends with no white space after them
    next_open = np.minimum.accumulate(np.where(closing, n, np.arange(n))[::-1])[::-1]
    at = np.flatnonzero(_is(codes, _FULL_END)) + 1
    at = next_open[at[at < n]]
    at = at[at < n]
    at = np.unique(at[~space[at] & ~_is(codes[at], _FULL_END)])
    positions = np.concatenate([ends, at])
    kinds = np.concatenate([kinds, np.full(len(at), SENTENCE, np.int8)])
    order = np.argsort(positions, kind="stable")
    return positions[order], kinds[order]


def chain(positions: np.ndarray, kinds: np.ndarray, length: int, limit: int, overlap: int) -> list[tuple[int, int]]:
    """The pieces of a text of ``length`` characters; one piece if it fits the limit, none if it is empty."""
    if not 0 <= overlap < limit - limit // 2:
        raise ValueError("the overlap must be less than half the limit")
    by_kind = [positions[kinds == kind].tolist() for kind in (PARAGRAPH, LINE, SENTENCE, SPACE)]
    pieces, start = [], 0
    while length - start > limit:
        end = start + limit
        for breaks in by_kind:
            k = bisect_right(breaks, start + limit) - 1
            if k >= 0 and 2 * (breaks[k] - start) > limit:
                end = breaks[k]
                break
        pieces.append((start, end))
        start = end - overlap
    if length:
        pieces.append((start, length))
    return pieces


def stitched(tables: list[tuple[int, np.ndarray, np.ndarray]], limit: int, overlap: int) -> list[tuple[int, int]]:
    """The pieces of an item from the tables of its ranges in order: characters, breaks relative to the first, kinds."""
    offsets = np.concatenate([[0], np.cumsum([count for count, _, _ in tables])])
    positions = np.concatenate([p + o for (_, p, _), o in zip(tables, offsets, strict=False)])
    return chain(positions, np.concatenate([k for _, _, k in tables]), int(offsets[-1]), limit, overlap)


def split_text(text: str, limit: int, overlap: int, range_bytes: int = TEXT_RANGE) -> list[tuple[int, int]]:
    if len(text) <= limit:
        return [(0, len(text))] if text else []
    data = text.encode("utf-8", "replace")
    read = lambda a, b: data[a:b]
    return stitched([range_table(read, a, min(len(data), a + range_bytes), len(data), limit) for a in range(0, len(data), range_bytes)], limit, overlap)


def split_texts(df: DataFrame, key: str, text: str, limit: int, overlap: int) -> DataFrame:
    """``key, piece_no int, start_pos int, end_pos int`` for the texts longer than ``limit``.

    Positions count characters from 0, ``end_pos`` excluded. Null, empty and shorter texts give no
    rows; repeated keys count like all other rows. Only the long texts reach Python.
    """
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, piece_no int, start_pos int, end_pos int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            keys, numbers, starts, ends = [], [], [], []
            for k, t in zip(rows[key].tolist(), rows[text].tolist(), strict=True):
                for i, (a, b) in enumerate(split_text(t, limit, overlap), 1):
                    keys.append(k)
                    numbers.append(i)
                    starts.append(a)
                    ends.append(b)
            yield pd.DataFrame({key: pd.Series(keys, dtype=rows[key].dtype), "piece_no": np.array(numbers, np.int32), "start_pos": np.array(starts, np.int32), "end_pos": np.array(ends, np.int32)})

    return spread(df.where(F.length(text) > limit).select(key, text)).mapInPandas(run, schema)


def needed(positions: np.ndarray, kinds: np.ndarray, limit: int, low: int, high: int) -> np.ndarray:
    """Which breaks some piece could end at: a weaker one between two stronger ones that stand
    closer than half the limit can never be the strongest in reach. ``low`` and ``high`` bound the range."""
    keep = np.ones(len(positions), bool)
    for kind in (SPACE, SENTENCE, LINE):
        strong = positions[kinds > kind]
        mine = np.flatnonzero(kinds == kind)
        if not len(mine) or not len(strong):
            continue
        k = np.searchsorted(strong, positions[mine])
        before = np.where(k > 0, strong[np.maximum(k - 1, 0)], low - limit)
        behind = np.where(k < len(strong), strong[np.minimum(k, len(strong) - 1)], high + limit)
        keep[mine] = behind - before - 1 >= limit // 2
    return keep


def file_reader(path: str) -> Callable[[int, int], bytes]:
    def read(start: int, end: int) -> bytes:
        with open(path, "rb") as file:
            file.seek(start)
            return file.read(end - start)

    return read


def range_table(read: Callable[[int, int], bytes], start: int, end: int, size: int, limit: int, halo: int = HALO) -> tuple[int, np.ndarray, np.ndarray]:
    """Characters that begin in bytes [start, end) of UTF-8 of ``size`` bytes, and the breaks there, relative to the first of them.

    A halo of nothing but white space and closing marks is widened until what they belong to is in sight.
    """
    left, right = max(0, start - halo), min(size, end + halo)
    while True:
        data = read(left, right)
        inner = data[start - left : end - left]
        head, tail = data[: start - left].decode("utf-8", "ignore"), data[end - left :].decode("utf-8", "ignore")
        head_open = left > 0 and not "".join(head.split()).strip(CLOSERS)
        tail_open = right < size and not "".join(tail.split()).strip(CLOSERS)
        if not (head_open or tail_open):
            break
        halo *= 4
        left = max(0, start - halo) if head_open else left
        right = min(size, end + halo) if tail_open else right
    raw = np.frombuffer(data, np.uint8)
    first = (raw & 0xC0) != 0x80
    skip = int(np.argmax(first)) if first.any() else 0
    text = data[skip:].decode("utf-8", "replace")
    before = int(first[skip : start - left].sum()) if start > left else 0
    count = int(((np.frombuffer(inner, np.uint8) & 0xC0) != 0x80).sum())
    positions, kinds = boundaries(text)
    if left > 0:
        shown = positions > CONTEXT  # what stands at the very edge of a halo lacks its context
        positions, kinds = positions[shown], kinds[shown]
    keep = needed(positions, kinds, limit, -limit if left > 0 else 0, len(text) + limit)
    keep &= (positions >= before) & (positions < before + count)
    return count, positions[keep] - before, kinds[keep]


def split_files(spark: SparkSession, paths: list[str], limit: int, overlap: int, range_bytes: int = 64 << 20) -> DataFrame:
    """``path, piece_no long, start_pos long, end_pos long`` of UTF-8 files that all executors can read.

    Each byte range is one small task; what is shuffled is its table of needed breaks. Empty
    files give no rows; a file within the limit is one piece.
    """
    plan = []
    for path in paths:
        size = os.path.getsize(path)
        plan += [(path, i, a, min(size, a + range_bytes), size) for i, a in enumerate(range(0, size, range_bytes))]
    ranges = spark.createDataFrame(plan, "path string, range_no long, low long, high long, size long")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for r in rows.itertuples(index=False):
                count, positions, kinds = range_table(file_reader(r.path), r.low, r.high, r.size, limit)
                yield pd.DataFrame({"path": [r.path], "range_no": [r.range_no], "chars": [count], "positions": [positions.astype(np.int64).tobytes()], "kinds": [kinds.tobytes()]})

    def stitch(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("range_no")
        tables = [(n, np.frombuffer(p, np.int64), np.frombuffer(k, np.int8)) for n, p, k in zip(rows["chars"], rows["positions"], rows["kinds"], strict=True)]
        pieces = stitched(tables, limit, overlap)
        return pd.DataFrame({"path": rows["path"].iloc[0], "piece_no": np.arange(1, len(pieces) + 1), "start_pos": [a for a, _ in pieces], "end_pos": [b for _, b in pieces]})

    tables = ranges.repartition(max(1, len(plan)), "path", "range_no").mapInPandas(scan, "path string, range_no long, chars long, positions binary, kinds binary")
    return tables.groupBy("path").applyInPandas(stitch, "path string, piece_no long, start_pos long, end_pos long")


def p5_found(spark, folder: str) -> DataFrame:
    def part(table: str, kind: str, key: str, text: str, limit: int, overlap: int) -> DataFrame:
        rows = spark.read.parquet(f"{folder}/{table}.parquet").select(F.col(key).alias("item_id"), F.col(text).alias("text"))
        return split_texts(rows, "item_id", "text", limit, overlap).select(F.lit(kind).alias("item_kind"), "item_id", "piece_no", "start_pos", "end_pos")

    return part("extracted_documents", "excerpt", "extract_id", "text_excerpt", 1500, 150).unionByName(part("chart_candidates", "page", "chart_row_id", "page_text", 900, 90))
