"""Kinds and statistics of texts."""

import pytest

from docaudit.llm import quality as Q

PROSE = "Growth in Canada has been stronger than in the U.S. We see little reason to chase banks, insurers, or miners after such a run.\nWhat would change our mind about gold? Very little, we think."
WRAPPED = "What would change our mind about investment grade credit? What\nwould change our mind about large cap growth shares? Margins at\nMilux Corp. and its peers widened by 134 basis points, though\nnew tariff rounds has yet to bite. Risks are two-sided: slower\nwage growth may surprise against consensus, and liquidity in\nprivate credit remains thin."

CASES = [
    (PROSE, "prose"), (WRAPPED, "prose"), (PROSE.upper(), "prose"), ("Key risks", "prose"), ("资金净流入红利资产达到345.5亿元，为本系列统计以来的较高水平。风险是双向的。", "prose"), ("\n".join("> " + s for s in PROSE.split("\n")), "prose"),
    ("• banks\n• gold: 5%\n• Key risks\n• miners", "list"), ("(1) banks\n(2) gold\n(3) miners", "list"), ("Summary:\nbanks\ngold: 5%\nminers\ninsurers", "list"), ("miners, the Gulf, software, frontier markets, builders, cheap gas", "list"), ("半导体; 商品; 上場不動産; 小売; 銀行; 金", "list"), ("[ ] 黄金\n[ ] 家电: 9.8%\n[ ] 物流", "list"), ("gold | banks | Japan | miners | software | the Gulf", "list"),
    ("Name;Yield;Risk\nbanks;706;n.a.\nminers;+12.5;3%\ngold;n.a.;9", "table"), ("| A | B |\n|---|---|\n| x | 5 |\n| y | 7.5% |", "table"), ("Yield\tRate\nbanks\t5\t6\nminers\t7\t8", "table"), ("Target          Return\nbanks           550.27%\ngold            n.a.", "table"),
    ("Rates\n  up again\n  and more\nBanks\n  flat\n  or less\nGold\n  down\n  by far", "list"), ("Name|Kind|Place\na|b|c\nd|e|f\ng|h|i", "table"),
    ("dSrwA8Sq3HGUFz5/TGUgCFKG8zkcv4W00ph0guzbSWhr+8ddRcYK67uDSWctw\nHF0EMZuukyXWk7mu9aac8czhHWebas18M85389Uut3mreQtV0YxXf4yCab1", "junk"), ("qkvqwkx=0x95c87f2e;\nqvqvvkwqz=0x95c94462;", "junk"), ("%-^_+\\&_>#_%=%=\\ &#=/| &/>/-&/=&.<*//%~|.&_>", "junk"), ("selelta" * 30, "junk"), ("私募信贷赚  " * 30, "junk"), ('<div class="c45"><span id="x1"></span>{{bbdeca}}</div>\n<div class="c40"></div>', "junk"), ("å¹³å=°æB¶ç´§éH>ç§/æ<6æK1ä¹9å><ï¼:OrpaxçH2å¹¿å?8", "junk"), ("cwci `w 1'Or .,i:w:l a:.;O nIlc;IlIm |avliiol0 'nm|`m :0:11O,,\n1ma: rro:' Ir n|011 va ; .i", "junk"),
    (None, None), ("", None), (" \n\t\r\n", None),
]


SENTENCES = ["Our base case assumes that an ageing capital stock fades in two steps.", "Are builders cheap, or is higher shipping costs simply not in the price yet?", "Risks are two-sided: falling term premia may surprise with a long lag.", "Growth in the Nordics has been stronger than elsewhere in the region."]
CASES += [
    *(("\n".join(f"{m}{s}" for s in SENTENCES), "list") for m in ("• ", "> ", "[ ] ", "- ")),  # items may be whole sentences
    ("Our view\n" + "\n".join(f"{i}. {s}" for i, s in enumerate(SENTENCES, 1)), "list"), ("\n\n".join(f"({i}) {s}" for i, s in enumerate(SENTENCES, 1)), "list"),
    ("\n".join(f"- {s[:40]}\n  {s[40:]}" for s in SENTENCES), "list"),
    ("\n".join(SENTENCES) + "\n1. gold\n2. banks", "prose"),  # a short list in a text of sentences
    ("Outlook for builders\ncommercial property\nstrong household balance sheets: 53 percent\nsoftware\ngold: 15.6%\ninflation-linked bonds", "list"),
    ("Outlook for builders\n\nsoftware\n\ngold: 15.6%\n\ninflation-linked bonds", "list"),
    ("\n".join(f"{a}\n{b}, the longer of the two lines of an entry here" for a, b in [("gold", "Canada"), ("tin", "Norway"), ("coal", "Poland"), ("iron", "Brazil"), ("zinc", "Mexico")]), "list"),
    ("Deshalb wurden Versicherer reduziert, z. B. über Optionen auf\nden Index. Laut Abb. 4 lag der Anteil der Halbleiter bei 3,3 %,\nu. a. wegen der Pfandbriefe.\nLaut Abb. 4 lag der Anteil der Einzelhändler bei 24 Prozent, u.\na. wegen der Pfandbriefe. Was spricht bis zum Herbst noch für\nInfrastrukturfonds?", "prose"),
    ("7.5\t8.25\r\n1.5\t3\r", "table"),
]


@pytest.mark.parametrize("text,kind", CASES)
def test_kinds(text, kind):
    assert Q.kind_of(text) == kind


def test_most_characters_win():
    table = "Name;Yield;Risk\nbanks;706;n.a.\nminers;+12.5;3%\ngold;n.a.;9"
    assert Q.kind_of(PROSE + "\n\n" + table) == "prose" and Q.kind_of("Short one.\n\n" + table * 1 + "\n" + "\n".join("banks;706;5" for _ in range(20))) == "table"


def test_statistics():
    n, mean, symbols, ended, common, lengths, indents = Q.text_statistics("The cat sat.\nno end\n\n中文", frozenset(["the"]), None)
    assert (n, ended) == (7, 1 / 3) and mean == 16 / 7 and common == 1 / 7 and 0 < symbols < 0.1
    assert Q.text_statistics(None, frozenset(), None) == (0, None, None, None, None, None, None)
    assert (lengths, indents) == (0.0, 0.0) and Q.autocorrelation([0, 2, 2] * 6) > 0.9 and Q.autocorrelation([3] * 9) == 1.0 and Q.autocorrelation([5, 1, 9, 2, 7, 3, 8, 1, 2, 9]) < 0.7
    assert Q.text_statistics("?!", frozenset(), None)[0] == 0


def test_operator(spark, data):
    rows = [(i, t) for i, (t, _) in enumerate(CASES)] + [(0, PROSE), (900, "x" * 300_000), (901, "word " * 60_000)]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, kind string")
    got = Q.text_quality(df, ["the", "of", "的"]).collect()
    assert len(got) == len(rows) and {r.doc_id: r.kind for r in got if r.doc_id < 900} == {i: k for i, (_, k) in enumerate(CASES)}
    assert Q.text_quality(df.limit(0), []).count() == 0 and Q.text_kinds(df.limit(0)).count() == 0
    found = Q.p8_found(spark, data)
    assert found.columns == ["doc_id", "kind"] and {r.kind for r in found.select("kind").distinct().collect()} == {"list", "table", "junk"}
    assert Q.p8_statistics(spark, data).where("word_count is null").count() == 0
