"""Pieces: rules of the chain, sentence ends, byte ranges of files against whole texts."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docaudit.llm import splitting as P


def plain(text, limit, overlap):
    """The rules read literally, one position at a time."""
    positions, kinds = P.boundaries(text)
    at = dict(zip(positions.tolist(), kinds.tolist(), strict=True))
    out, start = [], 0
    while len(text) - start > limit:
        end, best = start + limit, -1
        for p in range(start + limit, start, -1):
            if 2 * (p - start) > limit and at.get(p, -1) > best:
                end, best = p, at[p]
        out.append((start, end))
        start = end - overlap
    if text:
        out.append((start, len(text)))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "Bc", " ", ". ", "\n", "\n\n", "\r\n", "。", "！”", "? ", "　", "7", "e.g. ", "👍"]), max_size=150).map("".join), st.integers(4, 40))
def test_chain_like_plain_rules(text, limit):
    assert P.split_text(text, limit, limit // 10) == (plain(text, limit, limit // 10) if len(text) > limit else ([(0, len(text))] if text else []))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "Bc", " ", ". ", "\n", "\n\n", "。", "！”", "”" * 7, "? ", "　", " " * 40, "7", "e.g. ", "👍"]), max_size=200).map("".join), st.integers(4, 40), st.integers(5, 90))
def test_a_text_by_small_ranges_like_the_whole(text, limit, size):
    if len(text) > limit:
        assert P.split_text(text, limit, limit // 10, size) == plain(text, limit, limit // 10)


@pytest.mark.parametrize(
    "text,ends",
    [
        ("Growth beat the U.S. Several U.S. Treasury auctions drew weak demand.", ["U.S. "]), ("Rose by 3% (cf. Fig. 7). Third came.", ["7). "]), ('It said: "We wait." Then it left.', ['wait." ']), ("Im 3. Quartal flossen 10 Mio. EUR ab. Danach kam z. B. Gold.", ["ab. "]),
        ("La bolsa de EE. UU. subió, p. ej. hoy. Luego bajó.", ["hoy. "]), ("Faut-il acheter ? Selon l'art. 3 de la note, oui.", ["? "]), ("It gained 5%... and fell. Est. turnover rose.", ["fell. "]), ("In banks, etc. Since Sept. 2025 it rose.", ["etc. "]), ("Margins at X Corp. and others. No. 4 rose.", ["others. "]),
        ("He said “so be it.”)”)”)” Then he left.", [".”)”)”)” "]), ("完。”’）”’）”接着", ["。”’）”’）”"]), ("结束。”接着说。他走了……还没完。对吗？是", ["。”", "说。", "完。", "？"]), ("SUBIÓ, P. EJ. SI CAE. LUEGO BAJÓ, P. EX. SI", ["CAE. "]), ("ONE. TWO I.E. THREE CORP. AND FOUR. FIVE", ["ONE. ", "FOUR. "]),
    ],
)
def test_sentences_end_where_they_do(text, ends):
    positions, kinds = P.boundaries(text)
    found = [int(p) for p, k in zip(positions, kinds, strict=True) if k == P.SENTENCE]
    assert len(found) == len(ends) and all(text[:p].endswith(e) for p, e in zip(found, ends, strict=True))


def test_kinds_of_breaks():
    text = "a b\nc\r\n\r\nd\n \ne"
    assert list(zip(*(x.tolist() for x in P.boundaries(text)), strict=True)) == [(2, P.SPACE), (4, P.LINE), (9, P.PARAGRAPH), (13, P.PARAGRAPH)]


def test_operator(spark):
    rows = [(1, None), (2, ""), (3, "short"), (4, "x" * 100), (5, "x" * 101), (5, "x" * 101), (6, "中" * 250 + "👍" * 50), (7, "word " * 40_000)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "id long, text string, piece_no int")
    got = P.split_texts(df, "id", "text", 100, 10).toPandas()
    assert set(got.id) == {5, 6, 7} and (got.id == 5).sum() == 4
    for key, t in ((6, rows[6][1]), (7, rows[7][1])):
        parts = got[got.id == key].sort_values("piece_no")
        assert list(zip(parts.start_pos, parts.end_pos, strict=True)) == P.split_text(t, 100, 10)
        assert parts.end_pos.iloc[-1] == len(t) and (parts.end_pos - parts.start_pos).max() <= 100
        assert (parts.start_pos.to_numpy()[1:] == parts.end_pos.to_numpy()[:-1] - 10).all()
    assert P.split_texts(df.limit(0), "id", "text", 100, 10).count() == 0


@pytest.mark.parametrize("size", [97, 1000, 4096, 1 << 20])
def test_files_by_ranges_like_whole_texts(spark, tmp_path, size):
    rng = random.Random(size)
    parts = ["Growth rose by 3.5% in the U.S. Then it fell. ", "中文句子。“引用。”接着", "\n\n", "\n", "long" * 40, " " * 30, "é👍 ", "etc. And so on? "]
    texts = {"a": "".join(rng.choice(parts) for _ in range(600)), "b": "", "c": "tiny", "d": "x" * 5000, "e": " " * 9000 + "end. Next one."}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    got = P.split_files(spark, [str(tmp_path / n) for n in texts], 400, 40, size).toPandas()
    for name, text in texts.items():
        mine = got[got.path == str(tmp_path / name)].sort_values("piece_no")
        assert list(zip(mine.start_pos, mine.end_pos, strict=True)) == P.split_text(text, 400, 40), name


def test_pruned_breaks_suffice():
    rng = random.Random(2)
    for _ in range(60):
        text = "".join(rng.choice(["ab", " ", ". A", "\n", "\n\n", "xyz"]) for _ in range(400))
        positions, kinds = P.boundaries(text)
        keep = P.needed(positions, kinds, 60, 0, len(text) + 60)
        assert P.chain(positions[keep], kinds[keep], len(text), 60, 6) == P.chain(positions, kinds, len(text), 60, 6)


def test_queries(spark, data):
    got = P.p5_found(spark, data).toPandas()
    assert list(got.columns) == ["item_kind", "item_id", "piece_no", "start_pos", "end_pos"] and re.fullmatch("excerpt|page", got.item_kind.iloc[0])
