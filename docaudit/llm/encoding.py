"""Problem 6: the whole corpus as ids of a public byte-level BPE vocabulary.

Method: forced-boundary splitting. A merge can only ever join two bytes that stand
side by side in some vocabulary token. A pair of neighbouring bytes found in no
token is therefore a certain cut: the text splits there into fragments, each is
encoded on its own, and the id lists are joined. Fragments repeat a lot (words,
single ideographs), so each worker keeps a bounded table of those already encoded.

The vocabulary's pre-splitting pattern looks beyond a cut in two cases only, and
no cut is made there: after white space (its last alternative asks what follows)
and before an apostrophe (a contraction may start there).
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docaudit.session import spread

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: The published splitting pattern of this vocabulary (fixed value).
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bytes of text taken at once, and bounds of a worker's table of fragments.
SLICE_BYTES = 2_000_000
TABLE_SIZE = 400_000
TABLE_FRAGMENT = 48


class FragmentEncoder:
    """Encodes UTF-8 buffers by certain cuts; one per worker process."""

    def __init__(self, vocabulary: str = DEFAULT_VOCABULARY):
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("byte_bpe", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
        inside = np.zeros(65536, bool)
        joined = np.frombuffer(b"".join(ranks), np.uint8).astype(np.int32)
        sizes = np.fromiter(map(len, ranks), np.int64, len(ranks))
        same = np.ones(len(joined) - 1, bool)
        same[np.cumsum(sizes)[:-1] - 1] = False
        inside[(joined[:-1] * 256 + joined[1:])[same]] = True
        first, second = np.arange(65536) // 256, np.arange(65536) % 256
        space = np.isin(first, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])
        self.cut_pair = ~inside & ((second & 0xC0) != 0x80) & (second != 0x27) & ~space
        self.reset()

    def reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.offsets = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.used = self.ids_used = 0

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Positions p such that data[:p] and data[p:] certainly encode independently."""
        if len(data) < 2:
            return np.zeros(0, np.int64)
        at = np.flatnonzero(self.cut_pair[data[:-1].astype(np.uint16) * np.uint16(256) + data[1:]])
        last, before, third = data[at], data[np.maximum(at - 1, 0)], data[np.maximum(at - 2, 0)]
        # Unicode white space outside ASCII: U+0085 U+00A0 U+1680 U+2000-200A U+2028 U+2029 U+202F U+205F U+3000
        wide = ((before == 0xC2) & ((last == 0x85) | (last == 0xA0))) | ((third == 0xE3) & (before == 0x80) & (last == 0x80))
        wide |= (third == 0xE2) & (before == 0x80) & (((last >= 0x80) & (last <= 0x8A)) | (last == 0xA8) | (last == 0xA9) | (last == 0xAF))
        wide |= (third == 0xE2) & (before == 0x81) & (last == 0x9F) | (third == 0xE1) & (before == 0x9A) & (last == 0x80)
        return at[~wide] + 1

    def _add(self, fragment: bytes) -> int:
        ids = self.plain.encode_ordinary(fragment.decode("utf-8"))
        k, n = self.used, len(ids)
        if k == len(self.offsets):
            self.offsets, self.lengths = np.resize(self.offsets, 2 * k), np.resize(self.lengths, 2 * k)
        while self.ids_used + n > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.ids_used : self.ids_used + n] = ids
        self.offsets[k], self.lengths[k] = self.ids_used, n
        self.used, self.ids_used = k + 1, self.ids_used + n
        return k

    def encode(self, data: bytes, bounds: np.ndarray, ids: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
        """The ids of consecutive texts ``data[bounds[i]:bounds[i+1]]``, joined, and how many each has."""
        if self.used > TABLE_SIZE or self.ids_used > 8 * TABLE_SIZE:
            self.reset()
        view = np.frombuffer(data, np.uint8)
        inner = self.cuts(view[bounds[0] : bounds[-1]]) + bounds[0]
        starts = np.union1d(inner, bounds)
        ends = starts[1:].tolist()
        starts = starts[:-1]
        pieces = [data[a:b] for a, b in zip(starts.tolist(), ends, strict=True)]
        known = self.known
        found = list(map(known.get, pieces))
        if None in found:
            fresh: dict[bytes, int] = {}
            for i, k in enumerate(found):
                if k is None:
                    piece = pieces[i]
                    k = fresh.get(piece)
                    if k is None:
                        k = fresh[piece] = self._add(piece)
                    found[i] = k
            known.update((p, k) for p, k in fresh.items() if len(p) <= TABLE_FRAGMENT)
        at = np.array(found, np.int64)
        sizes = self.lengths[at]
        total = np.concatenate([[0], np.cumsum(sizes)])
        per_text = np.diff(total[np.searchsorted(starts, bounds)])
        if not ids:
            return None, per_text
        where = np.repeat(self.offsets[at] - total[:-1], sizes) + np.arange(total[-1])
        return self.ids[where], per_text


_ENCODERS: dict[str, FragmentEncoder] = {}


def _encoder(vocabulary: str) -> FragmentEncoder:
    if vocabulary not in _ENCODERS:
        if not os.path.exists(vocabulary):
            raise FileNotFoundError(f"no vocabulary at {vocabulary}")
        _ENCODERS[vocabulary] = FragmentEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Runs of rows of about SLICE_BYTES: first row, end row, their bytes, bounds in them. Null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    rows = len(texts)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, rows + 1, texts.offset * 8) if rows else np.zeros(1, np.int64)
    first = 0
    while first < rows:
        end = max(first + 1, int(np.searchsorted(bounds, bounds[first] + SLICE_BYTES, "right")) - 1)
        end = min(end, rows)
        low, high = int(bounds[first]), int(bounds[end])
        part = data[low:high].to_pybytes() if data is not None and high > low else b""
        yield first, end, part, bounds[first : end + 1] - low
        first = end


def encode_texts(df: DataFrame, text: str = "text", out: str = "ids", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``df`` without column ``text`` and with ``out array<int>``, the ids of each text.

    Null and empty texts have an empty list. Strings that look like special tokens are
    ordinary text. Rows keep their partition: nothing is shuffled. Other columns pass
    through, whatever their names; ``out`` takes the place of a column of that name.
    """
    keep = [c for c in df.columns if c not in (text, out)]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])
    listed = pa.list_(pa.field("element", pa.int32(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for batch in batches:
            for first, end, data, bounds in _slices(batch.column(text)):
                ids, sizes = encoder.encode(data, bounds)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids), type=listed)
                rest = [batch.column(c).slice(first, end - first) for c in keep]
                yield pa.RecordBatch.from_arrays([*rest, values], names=[*keep, out])

    return spread(df.select(*keep, text)).mapInArrow(run, schema)


def count_tokens(df: DataFrame, text: str = "text", out: str = "n_tokens", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``df`` without column ``text`` and with ``out bigint``: how many ids each text has (0 for null and empty)."""
    keep = [c for c in df.columns if c not in (text, out)]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for batch in batches:
            for first, end, data, bounds in _slices(batch.column(text)):
                _, sizes = encoder.encode(data, bounds, ids=False)
                rest = [batch.column(c).slice(first, end - first) for c in keep]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(sizes.astype(np.int64))], names=[*keep, out])

    return spread(df.select(*keep, text)).mapInArrow(run, schema)


def p6_ids(spark, folder: str) -> DataFrame:
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return encode_texts(documents.select(F.col("doc_id"), F.col("text")))
