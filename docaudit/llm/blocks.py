"""Problem 4: only the article's own lines of a page; navigation, consent, teasers and footers go.

Method: a recurrent block labeller. The blocks of a page (leaves of its tree, or the lines of
its text) are read as a sequence; each is the mean of the vectors of its hashed words and of its
tag path, and a bidirectional LSTM in numpy classifies every block with the whole page as context.
The weights (``blocks.npz``, about 0.3 MB) come from ``train_blocks.py``; a worker loads them once.

Pages are batched by length and run through the network together; nothing is shuffled.
"""

from __future__ import annotations

import io
import os
import pkgutil
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docaudit.session import spread

BUCKETS = 1 << 13
WIDTH = 16
HIDDEN = 24
WEIGHTS = os.path.join(os.path.dirname(__file__), "blocks.npz")
CJK = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f"
HAS_CJK = re.compile(f"[{CJK}]")
TOKEN = re.compile(rf"[{CJK}]|(?:(?![{CJK}])[^\W_])+|[^\w\s]")
SPACED_TOKEN = re.compile(r"[^\W_]+|[^\w\s]")  # the same where there are no ideographs or kana
DIGITS = re.compile(r"\d+")
SENTENCE = re.compile(r"[.!?](?=[\"”’»)]*(?:\s+[^\W\d_a-zß-ÿ]|$))|[。！？](?=[”’」』]*)")
MARK = re.compile(r"\s*(?:[•·▪*>–-]|\d{1,3}[.)]|\[ ?\])\s+")
SEPARATOR = re.compile(r"\s[|·>»/–-]\s|\s{2,}|\|")
LINE_TABLE = 200_000

#: Ends of teasers, by language (fixed values).
TEASER_ENDS = """
read more|\\d+ min read|watch the replay|podcast, \\d+ minutes
>>更多|阅读全文|閱讀全文|\\d+分钟阅读|\\d+分鐘閱讀|\\d+分钟閱讀
weiterlesen|min\\. lesezeit
lire la suite|min de lecture
leer más|leer mas|min de lectura|seguir leyendo
続きを読む|\\d+分で読めます）
"""
TEASER_END = re.compile("(?:" + "|".join(TEASER_ENDS.strip().split("\n")) + r")\s*$", re.I)


def shape_path(line: str, ends: int | None = None, cjk: bool | None = None) -> str:
    """A stand-in for the tag path of a block that comes without one: what its shape suggests.

    ``ends`` are its sentence ends and ``cjk`` whether it has ideographs or kana, where they are known.
    """
    ends = len(SENTENCE.findall(line)) if ends is None else ends
    if MARK.match(line):
        return "ul/li"
    if not ends and len(line) < 200 and SEPARATOR.search(line):
        return "nav"
    wide = 2 if (HAS_CJK.search(line) if cjk is None else cjk) else 1
    if not ends:
        return "h" if len(line) * wide < 80 else "div"
    return "p" if ends > 1 or len(line) * wide > 240 else "p1"


@lru_cache(maxsize=100_000)
def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % BUCKETS


def block_features(line: str, path: str | None = None) -> list[int]:
    """Hash buckets of a block: words, word pairs at its ends, the block itself if short, its shape and its path."""
    s = DIGITS.sub("0", (line if line.isascii() else unicodedata.normalize("NFKC", line)).lower()).strip()
    cjk = not line.isascii() and HAS_CJK.search(line) is not None
    raw = (TOKEN if not s.isascii() and HAS_CJK.search(s) else SPACED_TOKEN).findall(s)
    wide = not s.isascii() and sum(map("\u3040".__le__, raw)) * 2 > len(raw)
    tokens = [a + b for a, b in zip(raw, raw[1:], strict=False)] if wide else raw
    out = set(tokens)
    if raw:
        out.add("^" + raw[0])
        out.add("^" + "_".join(raw[:3]))
        out.add("_".join(raw[-2:]) + "$")
        out.add("_".join(raw[-3:]) + "$")
    if len(s) <= 64:
        out.add("=" + s)
    ends = len(SENTENCE.findall(line))
    n = len(s) * (2 if wide else 1)
    out.update((f"ends:{min(ends, 3)}", f"size:{min(12, int(np.log2(n + 1) * 1.5))}", f"last:{s[-1:] if not s[-1:].isalnum() else 'a'}", f"path:{path or shape_path(line, ends, cjk)}", f"words:{min(len(raw), 8)}"))
    return list(map(_bucket, out))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def lstm(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hidden states of one direction: x is (time, batch, width), gates are input, forget, output, candidate."""
    steps, batch, _ = x.shape
    h_size = u.shape[0]
    h, c = np.zeros((batch, h_size), x.dtype), np.zeros((batch, h_size), x.dtype)
    out = np.zeros((steps, batch, h_size), x.dtype)
    projected = x @ w + b
    for t in range(steps):
        z = projected[t] + h @ u
        gates = sigmoid(z[:, : 3 * h_size])
        i, f, o = gates[:, :h_size], gates[:, h_size : 2 * h_size], gates[:, 2 * h_size :]
        c = f * c + i * np.tanh(z[:, 3 * h_size :])
        h = o * np.tanh(c)
        out[t] = h
    return out


class BlockLabeller:
    def __init__(self, path: str = WEIGHTS):
        # the package may have come as an archive
        source = path if os.path.exists(path) else io.BytesIO(pkgutil.get_data(__package__, os.path.basename(path)))
        with np.load(source) as stored:
            self.weights = {k: stored[k].astype(np.float32) for k in stored.files}
        self.known: dict[str, tuple[np.ndarray, bool]] = {}

    def vector(self, line: str, path: str | None) -> tuple[np.ndarray, bool]:
        """The mean embedding of a block, and whether it ends like a teaser; of short blocks both are kept."""
        key = line if path is None else f"{path}\x1f{line}"
        found = self.known.get(key)
        if found is None:
            buckets = block_features(line, path)
            found = np.add.reduce(self.weights["embedding"][buckets], 0) / len(buckets), TEASER_END.search(line[-40:]) is not None
            if len(self.known) > LINE_TABLE:
                self.known.clear()
            if len(line) <= 200:
                self.known[key] = found
        return found

    def label(self, pages: list[list[str]], paths: list[list[str]] | None = None, batch: int = 256) -> list[np.ndarray]:
        """For each page the probability of each block to be page furniture."""
        w = self.weights
        order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        for first in range(0, len(order), batch):
            chosen = [k for k in order[first : first + batch] if pages[k]]
            if not chosen:
                continue
            steps = max(len(pages[k]) for k in chosen)
            ahead = np.zeros((steps, len(chosen), WIDTH), np.float32)
            back = np.zeros_like(ahead)
            teasers = []
            for j, k in enumerate(chosen):
                found = [self.vector(line, paths[k][i] if paths else None) for i, line in enumerate(pages[k])]
                vectors = np.array([v for v, _ in found])
                teasers.append([i for i, (_, ends) in enumerate(found) if ends])
                ahead[: len(vectors), j] = vectors
                back[: len(vectors), j] = vectors[::-1]
            left = lstm(ahead, w["w_left"], w["u_left"], w["b_left"])
            right = lstm(back, w["w_right"], w["u_right"], w["b_right"])
            for j, k in enumerate(chosen):
                n = len(pages[k])
                both = np.concatenate([left[:n, j], right[:n, j][::-1], ahead[:n, j]], axis=1)
                out[k] = sigmoid(both @ w["v"] + w["c"])
                out[k][teasers[j]] = 1.0  # an exact check: what invites to read on is a teaser, whatever stands around it
        return out


_LABELLERS: dict[str, BlockLabeller] = {}


def _labeller(path: str) -> BlockLabeller:
    if path not in _LABELLERS:
        _LABELLERS[path] = BlockLabeller(path)
    return _LABELLERS[path]


def label_lines(df: DataFrame, key: str, text: str, threshold: float = 0.5, weights: str = WEIGHTS) -> DataFrame:
    """``key, line_no int, furniture double, is_content boolean`` of each line of ``text`` that is not blank.

    Lines are numbered from 1, blank ones included. Null, empty and blank texts give no rows;
    repeated rows count like all others and extra columns are dropped. Long pages are read whole.
    """
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, line_no int, furniture double, is_content boolean"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labeller = _labeller(weights)
        for batch in batches:
            for first in range(0, len(batch), 1024):
                rows = batch.iloc[first : first + 1024]
                numbered = [[(i, s) for i, s in enumerate(t.split("\n"), 1) if s.strip()] if t else [] for t in rows[text]]
                scores = labeller.label([[s for _, s in page] for page in numbered])
                keys = [k for k, page in zip(rows[key], numbered, strict=True) for _ in page]
                values = np.concatenate(scores) if scores else np.zeros(0)
                yield pd.DataFrame({key: pd.Series(keys, dtype=rows[key].dtype), "line_no": np.array([i for page in numbered for i, _ in page], np.int32), "furniture": values.astype(np.float64), "is_content": values < threshold})

    return spread(df.select(key, text)).mapInPandas(run, schema)


def main_text(df: DataFrame, key: str, text: str, out: str = "main_text", threshold: float = 0.5, weights: str = WEIGHTS) -> DataFrame:
    """``df`` with ``out``: the article's own lines of ``text``, joined by line breaks; null where text is null."""
    @F.pandas_udf(T.StringType())
    def clean(texts: pd.Series) -> pd.Series:
        labeller = _labeller(weights)
        pages = [[s for s in t.split("\n") if s.strip()] if t else [] for t in texts]
        kept = ["\n".join(s for s, p in zip(page, scores, strict=True) if p < threshold) for page, scores in zip(pages, labeller.label(pages), strict=True)]
        return pd.Series([k if t is not None else None for k, t in zip(kept, texts, strict=True)], dtype=object)

    return df.withColumn(out, clean(text))


def p4_lines(spark, folder: str) -> DataFrame:
    return label_lines(spark.read.parquet(f"{folder}/article_quality.parquet"), "article_id", "text_preview")


def p4_found(spark, folder: str) -> DataFrame:
    return p4_lines(spark, folder).where("not is_content").select("article_id", "line_no")
