"""Functions on hand-made rows: the facts that must hold, odd values, and a plain Python twin where there is one."""

import re

import pytest
from pyspark.sql import functions as F

from docaudit import dictionaries as D
from docaudit.functions import geometry as G
from docaudit.functions import html as H
from docaudit.functions import numbers as N
from docaudit.functions import structures as S
from docaudit.functions import text as X


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(column.alias("r")).first().r


def texts(spark, column, values):
    return [r.r for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string").orderBy("i").select(column.alias("r")).collect()]


ODD = [None, "", "   ", "a", "Ünïcödé ＡＢＣ　x", "中2024年", "x" * 100_000, "\r\n\n", "é"]


def test_text_on_odd_values(spark):
    assert texts(spark, X.collapse_spaces("t"), ODD)[:4] == ["", "", "", "a"]
    assert texts(spark, X.normalize_text("t"), ODD)[4] == "ünïcödé abc x"
    for c in (X.shorten("t", 5), X.compact("t", 10), X.slug("t"), X.split_sentences("t"), X.headings("t"), X.chunk_paragraphs("t"), X.mojibake_ratio("t"), X.infer_title("t"), X.source_note("t"), X.trim_at_markers("t", ["x"], 3), X.estimate_tokens("t"), X.unit_hints("t")):
        assert len(texts(spark, c, ODD)) == len(ODD)
    assert texts(spark, X.slug("t"), ["", "Äpfel & Birnen!", "A" * 300])[0] == "item"


def test_sentences_are_split_behind_ends(spark):
    got = texts(spark, X.split_sentences("t"), ["This is the first of the sentences. And this is the second of them!\nshort\nA third one without any end mark at all"])[0]
    assert got == ["This is the first of the sentences.", "And this is the second of them!", "A third one without any end mark at all"]


def test_chart_tokens(spark):
    assert sorted(texts(spark, X.chart_tokens(X.normalize_text("t")), ["The GDP-growth chart of 2024: 中国 up 5%, ab_cde"])[0]) == ["2024", "cde", "gdp", "growth", "中国"]
    assert texts(spark, X.chart_tokens("t"), ["", "the chart"]) == [[], []]


def test_source_statements_are_all_there(spark):
    long = "Source: " + "x" * 400
    text = f"{long}\nText based on IMF data.\n资料来源：Wind\nno resource here\nSOURCES - \n  Bloomberg"
    assert texts(spark, X.source_statements("t"), [text, None, ""]) == [[long, "based on IMF data.", "资料来源：Wind", "SOURCES - \n  Bloomberg"], [], []]
    assert [len(s) for s in texts(spark, X.source_statements("t", 220), [text])[0]][0] == 228


def test_boilerplate_is_cut_at_cards_and_markers(spark):
    body, card = "word " * 400, "RESEARCH A look at the year ahead. "
    cards = [body + card + card, body + card, card + card + body, body + card + "Important Information here " + card, body + "important information here", None, "a \n b"]
    got = texts(spark, X.trim_boilerplate("t"), cards)
    assert got == [body.strip(), (body + card).strip(), (card + card + body).strip(), body.strip(), body + "important information here", "", "a b"]
    assert texts(spark, X.trim_boilerplate("t"), [body + card + "Important Information here"])[0] == (body + card).strip()


def test_nothing_is_cut_unless_asked(spark):
    text = "\n".join([f"The {i}th sentence of a long text." for i in range(1500)] + ["a long list " * 200])
    got = texts(spark, X.split_sentences("t"), [text])[0]
    assert len(got) == 1501 and got[-1] == ("a long list " * 200).strip()
    cut = texts(spark, X.split_sentences("t", longest=10, most=1400), [text])[0]
    assert len(cut) == 1400 and {len(s) for s in cut} == {10}
    numbers = " ; ".join(map(str, range(1, 801)))
    assert texts(spark, N.extract_numbers("t"), [numbers])[0] == [str(i) for i in range(1, 801)]
    assert len(texts(spark, N.extract_numbers("t", 500), [numbers])[0]) == 500
    dates = " ; ".join(f"20{i % 100:02}-05" for i in range(300))
    assert len(texts(spark, N.extract_dates("t"), [dates])[0]) == 300
    assert len(texts(spark, N.extract_dates("t", 200), [dates])[0]) == 200
    parts = "\n\n".join(f"{i:03}" + "x" * 700 for i in range(200))
    assert [c[:3] for c in texts(spark, X.chunk_paragraphs("t"), [parts])[0]] == [f"{i:03}" for i in range(200)]
    assert len(texts(spark, X.chunk_paragraphs("t", 900, 80), [parts])[0]) == 80


def test_headings_are_not_cut(spark):
    text = "\n".join(f"{i}. Outlook\nand then it went on like this." for i in range(300))
    assert texts(spark, X.headings("t"), [text])[0] == [f"{i}. Outlook" for i in range(300)]
    assert texts(spark, X.headings("t", 40), [text])[0] == [f"{i}. Outlook" for i in range(40)]


def test_chunks_keep_order_and_text(spark):
    text = "\n\n".join(["a" * 400, "b" * 400, "c" * 400, "d" * 1500, "e"])
    got = texts(spark, X.chunk_paragraphs("t", 900), [text])[0]
    assert [len(c) for c in got] == [801, 400, 1500, 1] and "".join(got).replace("\n", "") == text.replace("\n", "")


def test_token_overlap(spark):
    a, b = X.token_set(F.lit("gold rallies as the market fears risk")), X.token_set(F.lit("risk fears push gold up"))
    assert one(spark, F.round(X.overlap_ratio(a, b), 4), t=("string", "")) == 0.6  # gold rallies as fears risk
    assert one(spark, X.contains_fuzzy(F.lit("key risks"), F.lit("the key risks are")), t=("string", "")) is True
    assert one(spark, X.contains_fuzzy(F.lit(""), F.lit("x")), t=("string", "")) is False


def test_numbers_like_a_plain_pattern(spark):
    plain = re.compile(D.NUMBER_PATTERN, re.I)
    samples = ["rose 3.5% to $1,250 in 2024", "in 2024.", "3.5%.", "中2024年", "12 bps, 1,000 million and -4.2x", "", "５％", "1.2.3", "€ 5 – 7 bn"]
    for got, s in zip(texts(spark, N.extract_numbers("t"), samples), samples, strict=True):
        want = []
        for m in plain.finditer(s):
            v = re.sub(r"\s+", "", m.group())
            if v not in want:
                want.append(v)
        assert got == want, s


def test_number_preservation(spark):
    kept = N.preserved_share(F.col("a"), F.col("b"))
    assert one(spark, kept, a=("array<string>", ["40%", "1,250"]), b=("array<string>", ["40 %", "1250"])) == 1.0
    assert one(spark, kept, a=("array<string>", []), b=("array<string>", ["1"])) == 0.8
    assert one(spark, kept, a=("array<string>", None), b=("array<string>", None)) == 0.8
    assert one(spark, N.preserved_in_blob(F.col("a"), F.col("b")), a=("array<string>", ["25"]), b=("array<string>", ["1250"])) == 1.0


def test_quantities(spark):
    got = texts(spark, N.parse_quantities("t"), ["rose 3-5% and 2 亿元, 7 bps; 7 bps", None])
    assert [(q.raw, q.unit_class, q.value) for q in got[0]] == [("3", "plain", 3.0), ("5%", "percent", 5.0), ("2 亿元", "cny", 2e8), ("7 bps", "bps", 7.0)]
    assert got[1] == []


@pytest.mark.parametrize("a,b,ka,kb,want", [(100.0, 100.1, "usd", "usd", 1.0), (100.0, 104.0, "usd", "plain", 0.728), (0.0, 0.0, "x", "y", 0.78), (1.0, 9.0, "generic_amount", "cny", 0.1584)])
def test_match_score(spark, a, b, ka, kb, want):
    assert one(spark, F.round(N.match_score(F.col("a"), F.col("ka"), F.col("b"), F.col("kb")), 4), a=("double", a), b=("double", b), ka=("string", ka), kb=("string", kb)) == want


def test_dates(spark):
    assert texts(spark, N.report_date("t"), ["on 2024-03-05", "March 5, 2024", "Q3 2025", "none", None]) == ["2024-03-05", "March 5, 2024", "Q3 2025", None, None]
    assert texts(spark, N.extract_dates("t"), ["2024年3月5日 and jan 4, 2023"])[0] == ["2024年3月5日", "jan 4, 2023"]


def test_arithmetic(spark):
    assert one(spark, F.round(N.saturation(F.col("n"), 4), 3), n=("int", 4)) == 0.8
    assert one(spark, N.saturation(F.col("n"), 0), n=("int", 0)) == 0.0
    assert one(spark, N.blend(F.col("a"), F.col("b"), 0.7), a=("double", 0.5), b=("double", None)) == 0.5
    assert one(spark, N.safe_number(F.col("a"), 7.0), a=("string", "x1")) == 7.0
    assert one(spark, N.half_up(F.col("a"), 2), a=("double", 2.675)) == 2.68


def test_structures(spark):
    assert texts(spark, S.json_object(F.col("t")), ['```json\n{"a": 1}\n```', 'so {"b": 2} it is', "none", None, "[1]"]) == ['{"a": 1}', '{"b": 2}', None, None, None]
    assert texts(spark, S.redact(F.col("t")), ["https://u:p@h/x?api_key=1&b=2"]) == ["https://***@h/x?api_key=***&b=2"]
    assert texts(spark, S.registered_host(F.col("t")), ["https://www.a.b.example/x", "no url", None]) == ["b.example", None, None]
    assert texts(spark, S.is_pdf_url(F.col("t")), ["https://h/a.pdf?x", "https://h/a?f=b.pdf", "https://h/a", None]) == [True, True, False, False]
    link = S.traceable_link(F.col("t"), F.lit("Bloomberg data"), ["bloomberg"], "privacy|cookie")
    assert texts(spark, link, ["#a", "https://h/", "https://h/report", "https://h/privacy", "file:x", "mailto:a@b", None]) == [False, True, True, False, True, False, False]
    assert one(spark, S.merged_maps(F.col("a"), F.col("b")), a=("map<string,int>", {"x": 1, "y": 2}), b=("map<string,int>", {"y": 3})) == {"x": 1, "y": 3}
    assert one(spark, S.merged_maps(F.col("a"), F.col("b")), a=("map<string,int>", None), b=("map<string,int>", {"y": 3})) == {"y": 3}
    assert S.deep_merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 9}}) == {"a": {"b": 9, "c": 2}}
    assert S.dotted({"a": {"b": 1}}, "a.b") == 1 and S.dotted({}, "a.b", 5) == 5
    assert one(spark, S.first_present(F.col("a"), F.col("b")), a=("int", 0), b=("int", 4)) == 4
    assert texts(spark, S.one_of(F.col("t"), ["major", "minor"], "major"), ["MINOR ", "x", None]) == ["minor", "major", "major"]


def test_boxes(spark):
    box = "array<double>"
    assert one(spark, G.overlap(F.col("a"), F.col("b")), a=(box, [0.0, 0.0, 10.0, 10.0]), b=(box, [5.0, 5.0, 9.0, 9.0])) == 1.0
    assert one(spark, G.contained(F.col("a"), F.col("b")), a=(box, [0.0, 0.0, 10.0, 10.0]), b=(box, [5.0, 0.0, 15.0, 10.0])) == 0.5
    for bad in (None, [], [1.0, 2.0], [1.0, None, 2.0, 3.0], [5.0, 5.0, 1.0, 1.0]):
        assert one(spark, G.area(F.col("a")), a=(box, bad)) == 0.0
        assert one(spark, G.overlap(F.col("a"), F.col("b")), a=(box, bad), b=(box, [0.0, 0.0, 9.0, 9.0])) == 0.0


PAGE = """<html lang="de"><head><title> A  title </title><style>body{background:url(/b.png)}</style><meta name="date" content="2024-05-01"></head>
<body><nav><a href="/x">Menu</a></nav><h1>Head</h1><p>First <b>bold</b> text.</p><ul><li>one<li>two</ul><script>no()</script><img src="i.png" srcset="a.png 1x, b.png 2x"><table><tr><td>1</td></tr></table></body></html>"""


def test_html(spark):
    rows = spark.createDataFrame([(1, PAGE), (2, ""), (3, None), (4, "<p>open <b>tags <div>and & no end")], "i int, h string").select("i", H.parse_html("h").alias("p")).orderBy("i").collect()
    p = rows[0].p
    assert (p.title, p.lang, p.published, p.headings) == ("A title", "de", "2024-05-01", ["Head"])
    assert p.text.split("\n") == ["Menu", "Head", "First bold text.", "one", "two", "1"]
    assert {(r.tag, r.value) for r in p.resources} >= {("img", "i.png"), ("img", "b.png"), ("style", "/b.png")}
    assert [b.path for b in p.blocks][:3] == ["nav", "h1", "p"] and p.links[0].href == "/x" and p.list_items == 2
    assert rows[1].p.text == "" and rows[2].p.text is None and "tags" in rows[3].p.text
    ratio = spark.createDataFrame([(PAGE,)], "h string").select(H.link_text_ratio(H.parse_html("h")).alias("r")).first().r
    assert 0 < ratio < 0.5
    assert [r.r for r in spark.createDataFrame([("data:x",), ("//h/x",), ("#a",), ("x.png",)], "v string").select(H.resource_status(F.col("v")).alias("r")).collect()] == ["inline", "remote", "anchor", "local"]


def test_bytes_are_decoded_by_fallback(spark):
    rows = [(bytearray("﻿ä".encode()),), (bytearray("中文".encode("gb18030")),), (bytearray(b"\xff\xfe\xfd\x81"),), (bytearray(),), (None,)]
    got = [r.d for r in spark.createDataFrame(rows, "b binary").select(H.decode_bytes("b").alias("d")).collect()]
    assert [(g.text, g.encoding) for g in got[:2]] == [("ä", "utf-8"), ("中文", "gb18030")] and got[2].fallback_used and got[3].text == "" and got[4].text is None


def test_mojibake_repair(spark):
    assert texts(spark, X.repair_mojibake("t"), ["Ã¤", "plain", None, "中"]) == ["ä", "plain", None, "中"]


def test_nested_mojibake_repair(spark):
    df = spark.createDataFrame([("Ã¤", 3, ["Ã¶", None], {"Ã¼": "Ã¼"}, ("Ã¤", [("Ã¶", 2)])), (None, None, None, None, None)], "a string, n int, b array<string>, m map<string,string>, s struct<x:string,y:array<struct<z:string,k:int>>>")
    got = X.repair_nested(df)
    assert got.schema == df.schema
    first, second = got.collect()
    assert (first.a, first.n, first.b, first.m, first.s.x, first.s.y[0].z, first.s.y[0].k) == ("ä", 3, ["ö", None], {"Ã¼": "ü"}, "ä", "ö", 2) and all(v is None for v in second)


def test_hostile_texts_end_in_time(spark):
    import time

    from docaudit.operators.units import record_quantities

    long = ["(" * 100_000, "a=" * 50_000, "1 " * 60_000, "\n\n".join(["p"] * 30_000), "1,2" * 40_000, "．" * 50_000]
    began = time.time()
    for c in (F.size(X.chunk_paragraphs("t")), F.size(N.extract_numbers("t")), F.size(X.headings("t")), F.size(N.parse_quantities("t")), F.size(X.split_sentences("t")), X.slug("t"), X.unit_hints("t")):
        assert len(texts(spark, c, long)) == len(long)
    for t in long:
        record_quantities([t, "5"], None, t, t, t, t)
    assert time.time() - began < 60
