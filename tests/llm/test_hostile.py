"""Texts made to be slow: each operator must get through them, whole, in time."""

import random
import time

import numpy as np
import pytest

from docaudit.llm import blocks, encoding, language, names, quality, splitting

rng = random.Random(3)
BLOB = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/") for _ in range(300_000))
TEXTS = [
    BLOB, "1 " * 100_000, "a=" * 100_000, ";".join("12.5" for _ in range(60_000)), "(" * 150_000, "<" * 150_000, "\n" * 150_000, " " * 200_000 + "x", "a\n" * 60_000, "|" * 100_000, "e.g. " * 50_000, "。" * 100_000, "”" * 50_000, "'" * 100_000, "👍" * 60_000,
    "- item\n" * 30_000, "\t".join(map(str, range(60_000))), "x" * 100_000 + "\n" + "y" * 100_000, "\x00" * 50_000, "a." * 80_000, "中" * 100_000, "=".join(["k1"] * 50_000) + ";",
]


@pytest.fixture(scope="module")
def model():
    return language.fit(["the yield on gold rose and banks fell", "die Rendite ist gestiegen und Banken fallen", "我们不建议追高"] * 20, ["en", "de", "zh"] * 20)


@pytest.mark.parametrize("k", range(len(TEXTS)))
def test_in_time(k, model):
    text = TEXTS[k]
    began = time.time()
    quality.kind_of(text)
    quality.text_statistics(text, frozenset(["the"]), None)
    language.text_segments([text], model)
    pieces = splitting.split_text(text, 1500, 150)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text) and all(b - a <= 1500 for a, b in pieces)
    names.read_name(text[:20_000])
    data = text.encode()
    encoder = encoding._encoder(encoding.DEFAULT_VOCABULARY)
    ids, sizes = encoder.encode(data, np.array([0, len(data)]))
    assert sizes.sum() == len(ids) and encoder.plain.decode(ids.tolist()) == text
    assert time.time() - began < 25


def test_pages_in_time():
    began = time.time()
    for text in TEXTS:
        lines = [s for s in text.split("\n") if s.strip()]
        scores = blocks.BlockLabeller().label([lines])[0]
        assert len(scores) == len(lines) and np.isfinite(scores).all()
    assert time.time() - began < 120
