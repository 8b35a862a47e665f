"""Languages: the code's distance, held-out accuracy, segments, labels and odd items."""

import random

import pytest
from pyspark.sql import functions as F

from docaudit.llm import language as L

SAMPLES = {
    "en": ["Growth in Canada has been stronger than expected.", "We see little reason to chase these shares after such a run.", "What would change our mind about bonds and the price of gold?"],
    "de": ["Die Rendite von Anleihen ist im zweiten Halbjahr gestiegen.", "Wir bleiben bei Aktien vorsichtig, weil der Export schwach ist.", "Sollte die Inflation anhalten, könnten die Gewinne fallen."],
    "fr": ["Nous restons prudents avant l'été, car les taux pourraient monter.", "La fin des cookies pèse sur les revenus de la publicité.", "Faut-il encore acheter les obligations des entreprises ?"],
    "es": ["Seguimos cautelosos porque los beneficios podrían caer este año.", "La bolsa subió mientras los bancos quedaron atrás.", "Por eso el equipo redujo la salud y aumentó los bonos."],
    "zh": ["我们不建议在大幅上涨之后追高，但回调时可以分批增加。", "因此组合降低了银行的比重，并把东南亚调整为谨慎。", "大部分收益来自建材，其余部分由汇率变化解释。"],
    "ja": ["在庫調整が続けば、保険の利益は減る可能性がある。", "今後数週間、国債については弱気の見方を維持する。", "そのため運用チームは化学の比率を下げ、中立とした。"],
}


@pytest.fixture(scope="module")
def model():
    texts, labels = zip(*[(s, k) for k, v in SAMPLES.items() for s in v * 4], strict=True)
    return L.fit(list(texts), list(labels))


@pytest.fixture(scope="module")
def trained(spark, data):
    return L.fit(*L.labelled_sample(L.p1_items(spark, data), "label", "text"))


def test_codewords_are_far_apart():
    code = L.codewords()
    assert min((code[a] != code[b]).sum() for a in range(6) for b in range(a)) >= 7


def test_each_language_is_told(model):
    for k, lines in SAMPLES.items():
        for line in lines:
            (first, found, confidence, ambiguous, words), = L.text_segments([line], model)[0]
            assert (first, found, ambiguous) == (1, k, False) and confidence > 0.9 and words > 5


def test_wrong_labels_are_overruled():
    rng = random.Random(1)
    texts = [(" ".join(rng.sample(v, 2)), k) for k, v in SAMPLES.items() for _ in range(30)]
    labels = [k if rng.random() > 0.25 else rng.choice(list(SAMPLES)) for _, k in texts]
    noisy = L.fit([t for t, _ in texts], labels)
    assert all(L.text_segments([t], noisy)[0][0][1] == k for t, k in texts)


def test_segments(trained):
    text = "\n\n".join(["\n".join(SAMPLES["en"]), "\n".join(SAMPLES["zh"]), SAMPLES["de"][0] + " " + SAMPLES["de"][1]])
    assert [(a, lang) for a, lang, *_ in L.text_segments([text], trained)[0]] == [(1, "en"), (5, "zh"), (9, "de")]
    assert [s[1] for s in L.text_segments([text.upper()], trained)[0]] == ["en", "zh", "de"]


def test_items_without_language(trained):
    odd = [None, "", " \n\t ", "12 34\n5.6", "a;1;2\nb;3;4\nc;5;6", "%$#@ ^&*( !~|\n<>{}=+ %%$$ @@##", "dGhpcyBpcyBub3QgdGV4dCBhdCBhbGwgYnV0IGJhc2U2NA0KYQ/+x9Z8Qq\n" * 5]
    assert L.text_segments(odd, trained) == [[]] * len(odd)


def test_held_out_accuracy(spark, data, trained):
    bigger = data.replace("sf0.001", "sf0.01")
    rows = L.p1_items(spark, bigger).where("item_kind = 'document'").select("text", L.normal_label(F.col("label")).alias("l")).where("l is not null and length(text) > 100").collect()
    right = known = 0
    for r, segments in zip(rows, L.text_segments([r.text for r in rows], trained), strict=True):
        if len({s[1] for s in segments}) == 1:
            known += 1
            right += segments[0][1] == r.l
    assert right / known > 0.85  # about a tenth of the labels are wrong


def test_labels(spark):
    given = ["en-US", "EN", "English", "eng", "en_GB", "zh_Hans", "中文", "German", "deu", "fra", "ja-JP", "spa", "n/a", "unknown", "", None, "und", "-"]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, l string")
    got = [r.c for r in df.orderBy("i").select(L.normal_label(F.col("l")).alias("c")).collect()]
    assert got == ["en"] * 5 + ["zh", "zh", "de", "de", "fr", "ja", "es"] + [None] * 6


def test_operator(spark, trained):
    rng = random.Random(2)
    words = " ".join(SAMPLES["en"]).split()
    long = "\n".join(" ".join(rng.sample(words, 12)) for _ in range(4000))
    items = [("d", "1", "en", SAMPLES["en"][0]), ("d", "1", "en", SAMPLES["en"][0]), ("d", "2", "de", SAMPLES["en"][0]), ("d", "3", None, SAMPLES["fr"][0]), ("d", "4", "en", None), ("d", "5", "en", ""), ("d", "6", "en-GB", long), ("d", "7", "en", "\n".join(SAMPLES["en"] + SAMPLES["ja"]))]
    df = spark.createDataFrame([(*i, "x") for i in items], "item_kind string, item_id string, label string, text string, language string")
    got = L.language_segments(df, trained).collect()
    cases = {(r.item_id, r.first_line, r.language) for r in got if r.is_case}
    assert cases == {("2", 1, "en"), ("3", 1, "fr"), ("7", 1, "en"), ("7", 4, "ja")}
    assert sum(r.item_id == "1" for r in got) == 2 and {r.item_id for r in got} == {"1", "2", "3", "6", "7"}
    assert L.language_segments(df.limit(0), trained).count() == 0
    whole = {r.item_id: r for r in L.item_languages(L.language_segments(df, trained)).collect()}
    assert set(whole) == {"1", "2", "3", "6", "7"} and whole["3"].language == "fr" and whole["3"].confidence > 0.9
    assert whole["7"].languages == 2 and 0.4 < whole["7"].confidence < 0.9


STRANGERS = {
    "it": "La crescita in Canada è stata più forte che negli altri paesi. Non vediamo molte ragioni per comprare le banche dopo una corsa di questo genere, ma aggiungeremmo in caso di debolezza.",
    "nl": "De groei in Canada is sterker geweest dan in de andere landen. Wij zien weinig reden om banken te kopen na zo'n stijging, maar we zouden bijkopen bij zwakte.",
    "pt": "O crescimento no Canadá foi mais forte do que nos outros países. Não vemos muitas razões para comprar bancos depois de uma subida destas, mas compraríamos em caso de fraqueza.",
    "ko": "캐나다의 성장은 다른 나라보다 강했다. 우리는 이러한 상승 이후 은행을 살 이유를 거의 찾지 못한다.",
    "ru": "Рост в Канаде был сильнее, чем в других странах. Мы не видим причин покупать банки.",
}


def test_other_languages_are_told_as_other(trained):
    for name, text in STRANGERS.items():
        (first, found, _, ambiguous, _), = L.text_segments([text], trained)[0]
        assert (first, found, ambiguous) == (1, L.OTHER, True), name
    mixed = "\n".join([STRANGERS["pt"], "\n".join(SAMPLES["es"]), STRANGERS["ko"]])
    assert [(a, lang) for a, lang, *_ in L.text_segments([mixed], trained)[0]] == [(1, "other"), (2, "es"), (5, "other")]
    assert [s[1] for s in L.text_segments([SAMPLES["zh"][0] + "\n주요 위험\n" + SAMPLES["zh"][1]], trained)[0]] == ["zh"]  # a stray heading


def test_a_lone_carriage_return_ends_no_line(trained):
    assert L.text_segments(["a;1;2\nb;3;4\rx\nc;5;6\nd;7;8"], trained) == [[]]
    assert [(a, lang) for a, lang, *_ in L.text_segments(["\n".join(SAMPLES["en"]).replace(" ", "\r", 2)], trained)[0]] == [(1, "en")]


def test_a_sentence_beside_a_table_has_its_language(trained):
    table = "\n".join(f"row {i};{i}.5;{i * 7}%" for i in range(12))
    assert [(a, lang) for a, lang, *_ in L.text_segments([table + "\n" + SAMPLES["de"][1]], trained)[0]] == [(13, "de")]
    assert L.text_segments(["Name and value\n" + table], trained) == [[]]


def test_the_confidence_is_what_it_says(trained):
    """Of short pieces that the sample has not seen, those with a confidence around p are right in about that share."""
    sure, right = [], []
    for k, lines in SAMPLES.items():
        for line in lines:
            units = L.UNIT.findall(line.lower())
            for size in (1, 2, 3):
                for i in range(len(units) - size + 1):
                    chance = trained.probability(trained.decode(trained.sums([units[i : i + size]])))[0]
                    sure.append(chance.max())
                    right.append(L.LANGUAGES[chance.argmax()] == k)
    for low, high in ((0.0, 0.6), (0.6, 0.9), (0.9, 1.01)):
        part = [(s, r) for s, r in zip(sure, right, strict=True) if low <= s < high]
        assert len(part) > 10 and abs(sum(s for s, _ in part) - sum(r for _, r in part)) < 0.2 * len(part), (low, len(part))
