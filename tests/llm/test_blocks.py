"""Block labeller: the network against a plain loop, lines of pages, odd pages, and agreement with the teacher."""

import numpy as np
import pytest

from docaudit.llm import blocks as B
from docaudit.llm import train_blocks as T


def test_lstm_like_a_plain_loop():
    rng = np.random.default_rng(1)
    x, w, u, b = rng.standard_normal((5, 3, 4)), rng.standard_normal((4, 8)), rng.standard_normal((2, 8)), rng.standard_normal(8)
    got = B.lstm(x, w, u, b)
    for n in range(3):
        h, c = np.zeros(2), np.zeros(2)
        for t in range(5):
            z = x[t, n] @ w + h @ u + b
            i, f, o, g = B.sigmoid(z[:2]), B.sigmoid(z[2:4]), B.sigmoid(z[4:6]), np.tanh(z[6:])
            c = f * c + i * g
            h = o * np.tanh(c)
            assert np.allclose(got[t, n], h)


PAGE = """Home | About us | Contact | Search
We use cookies to make this site work and to measure how it is used.
Accept all

Outlook for banks
Margins at Milux Corp. and its peers widened by 3.9%, though slower wage growth has yet to bite. Growth in Korea has been stronger than in the U.S.
Third-party cookies disappear by the end of the cycle, and that weighs on advertising revenue at Baben.
You may also like
Key risks Read more
Why Japan matters now 5 min read
We see little reason to chase gold after such a run. Are insurers cheap, or is slower wage growth simply not in the price yet?
Source: Morkais Data, own estimates.
Share this article
Subscribe now
© 2026 Romar Rorafen. All rights reserved.
Past performance is not a guide to future returns. Capital is at risk."""


def test_page():
    lines = [s for s in PAGE.split("\n") if s.strip()]
    dropped = {s for s, p in zip(lines, B.BlockLabeller().label([lines])[0], strict=True) if p > 0.5}
    assert dropped == {*lines[:3], *lines[6:9], *lines[11:]}


def test_batches_do_not_matter():
    lines = [s for s in PAGE.split("\n") if s.strip()]
    pages = [lines[:k] for k in (0, 1, 5, 15, 3, 9)]
    model = B.BlockLabeller()
    together = model.label(pages)
    for page, scores in zip(pages, together, strict=True):
        assert np.allclose(scores, model.label([page])[0], atol=1e-5)


def test_operator(spark):
    rows = [(1, PAGE), (1, PAGE), (2, None), (3, ""), (4, " \n\n "), (5, "word " * 50_000), (6, "\n".join(["x"] * 3000))]
    df = spark.createDataFrame([(*r, 0) for r in rows], "article_id long, text string, line_no int")
    got = B.label_lines(df, "article_id", "text").toPandas()
    assert set(got.article_id) == {1, 5, 6} and (got.article_id == 1).sum() == 2 * 15 and got[got.article_id == 1].line_no.min() == 1 and 4 not in set(got[got.article_id == 1].line_no)
    assert B.label_lines(df.limit(0), "article_id", "text").count() == 0
    texts = {r.article_id: r.main_text for r in B.main_text(df, "article_id", "text").collect()}
    assert texts[2] is None and texts[3] == "" and "cookies disappear" in texts[1] and "Accept all" not in texts[1]


def test_tag_paths_are_read():
    model = B.BlockLabeller()
    assert not np.allclose(model.label([["Summary"]], [["nav"]])[0], model.label([["Summary"]], [["p"]])[0])


def test_teacher_and_labeller_agree(spark, data):
    texts = [r[0] for r in spark.read.parquet(f"{data}/article_quality.parquet").select("text_preview").collect() if r[0]]
    pages = [[s for s in t.split("\n") if s.strip()] for t in texts]
    result = T.evaluate(B.WEIGHTS, [(p, T.teach(p)[0]) for p in pages])
    assert result["accuracy"] > 0.985


def test_training_learns():
    pages = [(["Accept all", "Growth was strong. It rose.", "Print"], [1, 0, 1]), (["Menu", "Bonds fell. Gold rose."], [1, 0])] * 40
    weights = T.train(pages, epochs=8, batch=8, rate=0.02)
    assert set(weights) == {"embedding", "v", "c", "w_left", "u_left", "b_left", "w_right", "u_right", "b_right"}
    assert all(np.isfinite(x).all() for x in weights.values())


@pytest.mark.parametrize("line,path", [("• item of a list", "ul/li"), ("Home | About", "nav"), ("Key risks", "h"), ("It rose. It fell.", "p"), ("It rose.", "p1")])
def test_shapes(line, path):
    assert B.shape_path(line) == path
