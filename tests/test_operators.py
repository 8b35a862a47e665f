"""Operators on hand-made tables: nulls, ties, repeats, empty tables, clashing names, hot groups."""

import random

import pytest
from pyspark.sql import functions as F

from docaudit.operators import aggregates as A
from docaudit.operators import classify as C
from docaudit.operators import evidence as E
from docaudit.operators import filters as FI
from docaudit.operators import joins as J
from docaudit.operators import rules as R
from docaudit.operators import scoring as S
from docaudit.operators import windows as W


def rows(df, *by):
    return [tuple(r) for r in (df.orderBy(*by) if by else df).collect()]


def test_rules(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 50.0)], "i int, x double")
    c = F.col("x")
    out = df.select("i", R.first_rule([(c > 10, "big"), (c > 1, "mid")], "none").alias("a"), R.last_rule([(c > 10, "big"), (c > 1, "mid")], "none").alias("b"), R.reasons([(c > 1, "p"), (c.isNull(), "q")]).alias("c"), R.points([(c > 1, 2), (c > 10, 3)]).alias("d"), R.holding([c > 1, c > 10]).alias("e"))
    assert rows(out, "i") == [(1, "mid", "mid", ["p"], 2.0, 1), (2, "none", "none", ["q"], 0.0, 0), (3, "big", "mid", ["p"], 5.0, 2)]


def test_lookup_keeps_rows_and_prefers_the_first(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "k string, v int")
    right = spark.createDataFrame([("a", 10, 9), ("a", 20, 8), (None, 30, 7), ("c", 40, 6)], "k string, o int, v int")
    out = J.lookup(left, right, ["k"], [F.col("o")])
    assert out.columns == ["k", "v", "o"]
    assert sorted(rows(out), key=repr) == sorted([("a", 1, 10), ("a", 4, 10), ("b", 2, None), (None, 3, None)], key=repr)
    named = J.lookup(left, right, ["k"], [F.col("o")], prefix="r_")
    assert named.columns == ["k", "v", "r_o", "r_v"]


def test_existence(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, seen int")
    right = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert sorted(rows(J.flag_present(left, right, ["k"], "seen")), key=repr) == sorted([("a", True), ("b", False), (None, False)], key=repr)
    yes, no = J.split_by(left, right, ["k"])
    assert (yes.count(), no.count()) == (1, 2)
    assert J.add_missing(left, spark.createDataFrame([("a", "x"), ("z", "y")], "k string, w string"), ["k"]).count() == 4
    empty = left.limit(0)
    assert J.split_by(left, empty, ["k"])[1].count() == 3 and J.add_missing(empty, left, ["k"]).count() == 3


def test_strict_lookup_raises(spark):
    ids = spark.createDataFrame([("a", 0), ("x", 1)], "k string, n int")
    data = spark.createDataFrame([("a", 5)], "k string, v int")
    with pytest.raises(Exception, match="no row for x"):
        J.strict_lookup(ids, data, "k", "n").collect()
    assert rows(J.strict_lookup(ids.limit(1), data, "k", "n")) == [("a", 0, 5)]


def test_best_match_ties_and_missing(spark):
    left = spark.createDataFrame([("g", 1, 10.0), ("h", 2, 5.0)], "g string, i int, a double")
    right = spark.createDataFrame([("g", 7, 9.0), ("g", 5, 11.0), ("g", 6, 30.0)], "g string, j int, b double")
    out = J.best_match(left, right, ["g"], ["i"], -F.abs(F.col("a") - F.col("b")), [F.col("j")], threshold=-2.0)
    assert rows(out.select("i", "j", "matched"), "i") == [(1, 5, True), (2, None, False)]


def test_positional(spark):
    left = spark.createDataFrame([("a", 0, "x"), ("a", 1, "y")], "k string, i int, v string")
    right = spark.createDataFrame([("a", n) for n in range(4)] + [("b", 0)], "k string, j int")
    assert sorted((r.j, r.v) for r in J.positional(left, right, "k", "i", "j").collect()) == [(0, "x"), (1, "y"), (2, "y"), (3, "y")]


def test_boxes_of_a_page(spark):
    box = [("r", 1, 1, [0.0, 0.0, 10.0, 10.0], 5.0), ("r", 1, 2, [1.0, 1.0, 9.0, 9.0], 9.0), ("r", 1, 3, [50.0, 50.0, 60.0, 60.0], 1.0), ("r", 1, 4, None, 1.0), ("r", 2, 5, [0.0, 0.0, 10.0, 10.0], 1.0)]
    df = spark.createDataFrame(box, "r string, page int, id int, bbox array<double>, score double")
    assert sorted(r.id for r in J.suppress_overlaps(df, ["r", "page"], "id", "score").collect()) == [2, 3, 4, 5]
    got = {r.id: r.cluster_id for r in J.cluster_boxes(df, ["r", "page"], "id", gap=5.0).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 5: 5} and J.suppress_overlaps(df.withColumn("page", F.lit(None).cast("int")), ["r", "page"], "id", "score").count() == 5
    near = J.near_boxes(df, df.select("r", "page", F.col("bbox").alias("block_box"), F.col("id").cast("string").alias("text")), ["r", "page"], "id")
    assert {r.id: r.n_near for r in near.collect()}[4] == 0


def test_summaries(spark):
    df = spark.createDataFrame([("en", 1.0, True), (None, 3.0, None), (" ", None, False), ("en", 2.0, False)], "lang string, s double, ok boolean")
    got = {r.value: r for r in A.layered_summary(df, ["lang"], "s", "ok").collect()}
    assert (got["en"].avg_score, got["en"].passed, got["en"].pass_rate) == (1.5, 1, 0.5) and got["unknown"].n == 2 and got["unknown"].avg_score == 3.0
    assert A.layered_summary(df.limit(0), ["lang"], "s", "ok").count() == 0
    assert {(r.value, r.n, r.share) for r in A.distributions(df, ["lang"]).collect()} == {("en", 2, 50.0), ("unknown", 2, 50.0)}
    stats = A.statistics(df, "s").first()
    assert (stats.n, stats.min, stats.mean, stats.median, stats.max) == (3, 1.0, 2.0, 2.0, 3.0)
    assert A.statistics(df.limit(0), "s").first().mean is None
    arrays = spark.createDataFrame([(["a", "a", None],), (None,), ([],)], "w array<string>")
    assert rows(A.array_histogram(arrays, ["w"])) == [("w", "a", 2)]


def test_means(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 1.0), (None, 1.0), (4.0, 0.0)], "x double, w double")
    r = df.select(A.nan_mean(F.col("x"), 9.0).alias("a")).first()
    assert r.a == 2.5 and df.limit(0).select(A.nan_mean(F.col("x"), 9.0).alias("a")).first().a == 9.0
    assert spark.createDataFrame([(1.0, 1.0), (4.0, 3.0)], "x double, w double").select(A.weighted_mean(F.col("x"), F.col("w")).alias("a")).first().a == 3.25
    worst = A.worst_blend(spark.createDataFrame([("k", s) for s in (0.0, 1.0, 1.0, 1.0)], "k string, s double"), ["k"], "s", 1).first()
    assert (worst.mean_score, worst.worst_mean, worst.blended) == (0.75, 0.0, 0.525)


def test_checklist_last_wins(spark):
    df = spark.createDataFrame([("r", "a", "g", 1.0, 1), ("r", "a", "g", 0.0, 2), ("r", "b", "g", None, 1), ("r", "c", "g", 1.0, 1)], "r string, item string, grp string, v double, n int")
    assert rows(A.checklist_scores(df, ["r"], "item", "grp", "v", "n")) == [("r", "g", 0.5, 2)]


def test_requirements(spark):
    df = spark.createDataFrame([("en", "x"), ("en", "x"), ("zh", "x")], "lang string, inst string")
    got = {r.error for r in A.requirement_errors(df, {"zh": (F.col("lang") == "zh", 2)}, {"en": (F.col("lang") == "en", 1)}, ("inst", 2), ("lang", 2)).collect()}
    assert got == {"zh_below_2", "en_above_1", "inst_above_2"}


def test_ids_and_quotas(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("x" * 95, 4), ("x" * 95, 5)], "id string, n int")
    got = [r.u for r in W.uniquify(df, "id", [F.col("n")], "u").orderBy("n").collect()]
    assert got[:3] == ["a", "a_2", "b"] and got[4].endswith("_2") and len(got[4]) == 90
    caps = spark.createDataFrame([("i", "u1", 1), ("i", "u1", 2), ("i", "u2", 3), ("i", "u3", 4)], "inst string, url string, n int")
    assert sorted(r.n for r in W.cap_per_group(caps, "inst", "url", [F.col("n")], 2).collect()) == [1, 3]


def greedy(items, quotas, target):
    used, seen, out = {}, set(), []
    for it in sorted(items, key=lambda r: (-r[3], r[0])):
        if it[4] in seen or any(used.get((q, it[q]), 0) >= n for q, n in quotas.items()):
            continue
        out.append(it[0])
        if it[4] is not None:
            seen.add(it[4])
        for q in quotas:
            used[(q, it[q])] = used.get((q, it[q]), 0) + 1
        if len(out) == target:
            break
    return out


@pytest.mark.parametrize("seed", range(4))
def test_quota_selection_like_a_plain_loop(spark, seed):
    rng = random.Random(seed)
    items = [(i, rng.choice("ABCDE"), rng.choice("xyz"), float(rng.randint(0, 20)), rng.choice([None, *map(str, range(60))])) for i in range(200)]
    df = spark.createDataFrame(items, "id int, inst string, sub string, score double, sha string")
    got = W.quota_selection(df, [("score", True), ("id", False)], {"inst": 4, "sub": 5}, 12, "sha")
    assert sorted(r.id for r in got.collect()) == sorted(greedy(items, {1: 4, 2: 5}, 12))


@pytest.mark.parametrize("n,most", [(5, 10), (10, 10), (11, 10), (40, 10), (100, 7)])
def test_stratified_like_slices(spark, n, most):
    df = spark.createDataFrame([("t", float(i), i) for i in range(n)], "t string, s double, id int")
    got = sorted(r.id for r in W.stratified(df, ["t"], "s", "id", most).collect())
    group = list(range(n))
    if n > most:
        low, high = group[: most // 3], group[-most // 3 :]
        rest = most - len(low) - len(high)
        middle = [group[i] for i in range(len(low), n - len(high), max(1, n // max(1, rest)))][:rest]
        group = low + middle + high
    assert got == group


def test_sequences(spark):
    df = spark.createDataFrame([("d", k, s) for k, s in [(1, 5), (2, 9), (2, 7), (4, 20), (3, 12)]] + [("e", 2, 1)], "d string, num int, start int")
    assert rows(W.running_numbers(df, ["d"], "num", "start"), "num") == [("d", 1, 5), ("d", 2, 7), ("d", 3, 12), ("d", 4, 20)]
    chunks = spark.createDataFrame([("d", i, c) for i, c in enumerate("abcd")], "d string, i int, t string")
    assert [r.context for r in W.neighbours(chunks, ["d"], "i", "t", 1, joiner="-").orderBy("i").collect()] == ["a-b", "a-b-c", "b-c-d", "c-d"]
    centers = spark.createDataFrame([([3.0, 1.0, None, 30.0],), ([],), (None,), ([5.0],)], "c array<double>")
    assert [r.n for r in centers.select(W.distinct_centers(F.coalesce("c", F.array().cast("array<double>")), 10.0).alias("n")).collect()] == [2, 0, 0, 1]


def test_budget_and_repeats(spark):
    df = spark.createDataFrame([("u", i, c) for i, c in enumerate([1, 0, 1, 1, 0])], "u string, i int, c int")
    assert [r.skipped for r in W.over_budget(df, ["u"], [F.col("i")], F.col("c"), 2).orderBy("i").collect()] == [False, False, False, True, False]
    keys = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "i int, k string")
    assert [r.f for r in W.flag_repeats(keys, "k", "f").orderBy("i").collect()] == [True, True, False, False, False]


def test_diverse_and_dedupe(spark):
    df = spark.createDataFrame([(1, "r", 1, 9.0), (2, "r", 1, 8.0), (3, "r", 2, 1.0), (4, "r", 1, 7.0)], "i int, r string, page int, s double")
    got = W.diverse_top(df, ["r"], "page", [F.desc("s")], 3).orderBy("place").collect()
    assert [r.i for r in got] == [1, 3, 2]
    assert W.last_per_key(df, ["page"], "i").orderBy("page").select("i").collect()[0].i == 4
    assert sorted(r.i for r in W.first_per_key(df, ["page"], [F.col("i")]).collect()) == [1, 3]


def test_scores(spark):
    mods = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", None), ("b", "y", float("nan"))], "k string, module string, score double")
    got = {r.k: r for r in S.total_scores(mods, "k", {"x": 60.0, "y": 40.0}, ("y",)).collect()}
    assert got["a"].overall == 60.0 and got["b"].overall == 0.0
    judged = spark.createDataFrame([("a", "x", 0.0)], "k string, module string, judged double")
    assert {(r.k, r.module): r.score for r in S.with_judgements(mods, judged, "k", {"x": 0.25}).collect()}[("a", "x")] == 0.25
    df = spark.createDataFrame([(95.0, False), (95.0, True), (80.0, None), (10.0, False)], "o double, red boolean")
    assert [r.g for r in df.select(S.grade(F.col("o"), F.col("red")).alias("g")).collect()] == ["Gold", "Reject", "Silver", "Reject"]
    gates = df.select(S.gate_failures(F.col("o"), F.create_map(F.lit("m"), F.lit(0.2)), {"overall": 90.0, "m": 0.5, "off": None}, F.col("red")).alias("g"))
    assert [r.g for r in gates.collect()][1] == ["m_below_threshold", "redline_issue_present"]
    issues = spark.createDataFrame([("k", "low", 1), ("k", "odd", 2), ("k", "blocker", 3), ("k", "low", 0)], "k string, sev string, n int")
    assert [r.n for r in S.ranked_issues(issues, ["k"], "sev", "n", 3).orderBy("issue_no").collect()] == [3, 0, 1]


def test_classification(spark):
    df = spark.createDataFrame([("GDP grew 3.5% in 2024",), ("see ABC1234-5 for 40%",), ("In 2023 and 2024",), ("",), (None,), ("1 and 2 of 3",)], "s string")
    assert [r.a for r in df.select(C.analytical_numeric(F.col("s")).alias("a")).collect()] == [True, False, False, False, False, False]
    assert [r.a for r in df.select(C.has_numeric_context(F.coalesce("s", F.lit(""))).alias("a")).collect()][0] is True
    lang = spark.createDataFrame([("中" * 25,), ("a" * 100,), (None,), ("中" * 25 + "a" * 400,)], "t string")
    assert [r.l for r in lang.select(C.zh_or_en(F.col("t")).alias("l")).collect()] == ["zh", "en", "en", "en"]


def test_subtype_by_the_whole_text(spark):
    df = spark.createDataFrame([("x", "outlook " + "y" * 3000 + " risk and downside"), (None, None)], "a string, b string")
    words = {"outlook": ["outlook"], "risk": ["risk", "downside"]}
    got = df.select(C.subtype(F.col("a"), F.col("b"), words, "other").alias("whole"), C.subtype(F.col("a"), F.col("b"), words, "other", 3000).alias("start")).collect()
    assert [tuple(r) for r in got] == [("risk", "outlook"), ("other", "other")]


def test_evidence(spark):
    docs = spark.createDataFrame([("r", "Gold rose 5% on haven demand.\n\nEquities fell as growth slowed.\n\nBonds were flat."), ("q", None)], "r string, t string")
    facts = spark.createDataFrame([("r", 1, "equities fell"), ("r", 2, "zzz"), ("q", 3, "gold"), ("r", 4, None), ("r", 5, "gold rose 5%")], "r string, f int, c string")
    got = E.evidence_packs(facts, E.chunked(docs, "r", "t", 40), "r", "f", "c", 2).orderBy("f", "rank").collect()
    assert [(r.f, r.rank, r.chunk_index) for r in got] == [(1, 1, 1), (2, 1, 0), (4, 1, 0), (5, 1, 0)]
    assert {r.f: r.score for r in got}[2] == 0.0
    support = {r.f: r.supported for r in E.claim_support(facts, docs, "r", "f", "c", "t").collect()}
    assert support[1] and support[5] and not support[2]


def test_evidence_numbers_in_another_scale(spark):
    docs = spark.createDataFrame([("r", "It was quiet.\n\nThey took in 1,200 million that year.\n\nThen 0.3% and 7 units.")], "r string, t string")
    facts = spark.createDataFrame([("r", 1, "1.2 billion"), ("r", 2, "1.2 billion, 9%"), ("r", 3, "25 bps"), ("r", 4, "1200000000 or 5 times")], "r string, f int, c string")
    got = E.evidence_packs(facts, E.chunked(docs, "r", "t", 30), "r", "f", "c", 1).orderBy("f").collect()
    # the number part weighs 0.35; a percentage and basis points are classes of their own, also in the reference
    assert [(r.f, r.chunk_index, r.score) for r in got] == [(1, 1, 0.35), (2, 1, 0.175), (3, 0, 0.0), (4, 1, 0.175)]


def test_source_evidence(spark):
    said = "\n".join(["Source: Bloomberg"] + [f"Source: item {i}" for i in range(60)] + ["Source:  Bloomberg", "According to us"])
    long = "Source: " + "y" * 400
    texts = spark.createDataFrame([("r", said, [("Home", "https://h/"), ("", "https://imf.org/x"), ("Home", "https://h/"), (None, None)]), ("q", None, None)], "k string, text string, links array<struct<text:string,href:string>>")
    packs = spark.createDataFrame([("r", 7, "a pdf", "p/a.pdf"), ("r", 3, "a pdf", "p/a.pdf"), ("q", 1, None, None)], "k string, at long, text string, href string")
    charts = spark.createDataFrame([("r", 1, "c1", "Wind", long + "1"), ("r", 2, "c2", "Wind", long + "2"), ("q", 3, None, "", "nothing")], "k string, at long, chart_id string, source_note string, nearby_text string")
    got = E.source_evidence("k", texts, texts, packs, charts).collect()
    assert {r.k for r in got} == {"r"}
    kinds = lambda k: sorted((r.at, r.location, r.text, r.href, tuple(r.authority_terms)) for r in got if r.kind == k)
    statements = kinds("text_source_statement")
    assert len(statements) == 62 and statements[0] == (1, "text_match_001", "Source: Bloomberg", "", ("bloomberg",)) and statements[-1][:3] == (63, "text_match_063", "According to us")
    assert kinds("link") == [(1, "link_001", "Home", "https://h/", ()), (2, "link_002", "https://imf.org/x", "https://imf.org/x", ("imf", "imf.org"))]
    assert kinds("source_pack") == [(3, "source_pack_003", "a pdf", "p/a.pdf", ())]
    assert kinds("chart_source_note") == [(1, "c1", "Wind", "", ("wind",))]
    assert [r[2] for r in kinds("chart_nearby_source")] == [long + "1", long + "2"]
    parity = E.source_evidence("k", texts, texts, packs, charts, longest=220, compared=180, shown=360).where("kind = 'chart_nearby_source'").collect()
    assert [(r.location, len(r.text)) for r in parity] == [("c1", 228)]


def test_filters(spark):
    from docaudit.operators import filters as FI

    df = spark.createDataFrame([(1, "Outlook 2024", "a.HTML", None), (2, "Outlook podcast", "b.pdf", "html"), (3, None, None, None), (4, " - Home | ", "c", "pdf")], "i int, t string, p string, f string")
    c = F.col
    got = df.select("i", FI.positive_title(c("t"), "Outlook", "podcast").alias("a"), FI.declared_or_suffix(c("f"), c("p"), ["html"], ".html").alias("b"), FI.generic_title(c("t"), ["home"]).alias("c"), FI.any_term(c("t"), ["pod"]).alias("d"), FI.unlike_true(c("t").isNull() & F.lit(None).cast("boolean")).alias("e"))
    assert rows(got, "i") == [(1, True, True, False, False, True), (2, False, True, False, True, True), (3, False, False, False, False, True), (4, False, False, True, False, True)]
    assert [r.i for r in FI.in_order(df, "i", [4, 9, 1]).collect()] == [4, 1]
    yes, no = FI.routed(df, c("f") == "html")
    assert (yes.count(), no.count(), FI.routed(df, c("f") == "html", True)[0].count()) == (1, 3, 4)
    texts = spark.createDataFrame([("accept cookies " * 50,), ("accept cookies " * 150,), ("menu " * 30,), ("menu " * 90,), ("x",), ("y" * 90,), (None,)], "t string")
    assert [r.o for r in texts.select(FI.overlay_text(F.col("t"), ["cookie"], ["menu"]).alias("o")).collect()] == [True, False, True, False, True, False, True]
    assert [r.u for r in spark.createDataFrame([("x" * 2000, "x" * 3000), ("x" * 2000, "x" * 99_000), (None, None)], "a string, b string").select(FI.usable_excerpt(F.col("a"), F.col("b")).alias("u")).collect()] == [True, False, False]


def test_projections(spark):
    from docaudit.operators import projections as P

    nested = spark.createDataFrame([((1, ("x", 2)), 5)], "a struct<i:int,b:struct<s:string,n:int>>, `a.i` int")
    assert P.flatten(nested).columns == ["a.i", "a.b.s", "a.b.n", "a.i_2"] and rows(P.flatten(nested)) == [(1, "x", 2, 5)]
    df = spark.createDataFrame([(None, "p", 1), ("q", "r", 2)], "path string, file_path string, n int")
    assert rows(P.renamed(df, {"path": ["html_path", "file_path"]}).select("path", "n"), "n") == [("p", 1), ("q", 2)]
    assert P.renamed(df, {"new": ["none"]}).where("new is null").count() == 2
    items = spark.createDataFrame([('["claim one", {"fact": "two", "fact_id": "f9"}, {"claim": "three"}, 7, null, []]',), ("broken",), (None,)], "j string")
    got = [r.x for r in items.select(P.coerced_items(F.col("j"), {"fact_id": ["id"], "claim": ["fact", "content"]}, "claim", "fact_id", "fact_%03d").alias("x")).collect()]
    assert [(x.fact_id, x.claim) for x in got[0]] == [("fact_001", "claim one"), ("f9", "two"), ("fact_003", "three"), ("fact_004", "7")] and got[1] == [] and got[2] == []
    checked = P.validated(spark.createDataFrame([("a", ["x"] * 20), (" ", None)], "k string, l array<string>"), ["k"], {"l": 12}).collect()
    assert [(r.valid, r.errors) for r in checked] == [(True, []), (False, ["missing_k"])] and len(checked[0].l) == 12
    one = spark.createDataFrame([("a", {"x": "1.23456", "y": "no"}, [("m", 1)]), ("z", None, [])], "k string, m map<string,string>, s array<struct<m:string,n:int>>")
    out = one.select(P.looked_up(F.col("k"), {"a": "b"}).alias("a"), P.numeric_entries(F.col("m")).alias("b"), P.label_of_first(F.col("s"), "m", "n").alias("c")).collect()
    assert [(r.a, r.b, r.c) for r in out] == [("b", {"x": 1.235}, "m:1"), ("z", None, "")]


def test_pages_are_assessed(spark):
    from docaudit.functions import html as H

    article = "<title>Outlook</title><h1>Outlook</h1>" + "".join(f"<p>{'Growth and risk in markets. ' * 12}</p>" for _ in range(6))
    listing = "<title>Home</title>" + "".join(f'<li><a href="/{i}">Item number {i}</a></li>' for i in range(40))
    df = spark.createDataFrame([(1, article), (2, listing), (3, ""), (4, None)], "i int, h string").select("i", H.parse_html("h").alias("p"))
    m = H.page_metrics(F.col("p"))
    found = C.article_assessment(m, F.when(F.contains(F.col("p.text"), F.lit("risk")), 3).otherwise(0), F.col("p.title"))
    got = {r.i: r for r in df.select("i", *(v.alias(k) for k, v in found.items())).collect()}
    assert got[1].article_like and got[1].reject_reasons == [] and got[1].score > 60
    assert {"link_heavy", "list_page", "generic_title"} <= set(got[2].reject_reasons) and not got[3].article_like and "too_short" in got[4].reject_reasons
    css = spark.createDataFrame([("a{background:url(i.png)} b{x:url(data:y)}", "https://h/d/x.html"), (None, None)], "c string, b string")
    assert [r.x for r in css.select(H.absolute_css("c", "b").alias("x")).collect()] == ['a{background:url("https://h/d/i.png")} b{x:url(data:y)}', None]
    kinds = spark.createDataFrame([(10, 0, None), (500, 1, 0.1), (10, 1, 0.9), (500, 0, None)], "n int, v int, s double")
    assert [r.k for r in kinds.select(C.page_kind(F.col("n"), F.col("v"), F.col("s")).alias("k")).collect()] == ["blank", "mixed", "full_visual", "text"]


def test_near_boxes_like_brute_force(spark):
    rng = random.Random(7)
    box = lambda: (lambda x, y: [x, y, x + rng.uniform(1, 200), y + rng.uniform(1, 400)])(rng.uniform(0, 500), rng.uniform(-50, 900))
    items = [("r", rng.randint(1, 2), i, box()) for i in range(80)]
    df = spark.createDataFrame(items, "r string, page int, id int, bbox array<double>")
    got = {r.id: r.n_near for r in J.near_boxes(df, df.select("r", "page", F.col("bbox").alias("block_box"), F.col("id").cast("string").alias("text")), ["r", "page"], "id").collect()}
    for _, p, i, b in items:
        want = sum(p == q and min(b[2], k[2]) - max(b[0], k[0]) > -80 and k[3] >= b[1] - 130 and k[1] <= b[3] + 170 for _, q, _, k in items)
        assert got[i] == want


def test_center_counts(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", 1.0), ("a", None), ("a", 30.0), ("b", None)], "k string, v double")
    assert rows(W.center_counts(df, ["k"], F.col("v"), 10.0), "k") == [("a", 2), ("b", 0)]


def test_ranks_by_sort_are_those_of_a_window(spark):
    rng = random.Random(9)
    items = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.randint(0, 5), i) for i in range(3000)]
    df = spark.createDataFrame(items, "k string, s int, i int").repartition(7)
    order = [F.desc("s"), F.col("i")]
    a = {r.i: r.rank for r in W.ranked(df, ["k"], order).collect()}
    b = {r.i: r.rank for r in W.ranked(df, ["k"], order, by_sort=True).collect()}
    assert a == b and len(a) == 3000 and W.ranked(df.limit(0), ["k"], order, by_sort=True).count() == 0
    ids = W.uniquify(df.select(F.coalesce("k", F.lit("n")).alias("k"), "i"), "k", [F.col("i")], "u", by_sort=True)
    assert ids.select("u").distinct().count() == 3000


def test_running_sums_by_sort(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(rng.choice(["hot", "hot", "a", None]), i, rng.choice([0, 1, 2, None])) for i in range(2000)], "k string, i int, c int").repartition(6)
    a = {r.i: (r.spent_before, r.skipped) for r in W.over_budget(df, ["k"], [F.col("i")], F.col("c"), 50).collect()}
    b = {r.i: (r.spent_before, r.skipped) for r in W.over_budget(df, ["k"], [F.col("i")], F.col("c"), 50, by_sort=True).collect()}
    assert a == b and len(a) == 2000


def test_strict_lists_and_declared_languages(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "i long, x string")
    assert [r.x for r in FI.in_order(df, "i", [3, 1], strict=True).collect()] == ["c", "a"] and [r.x for r in FI.in_order(df, "i", [3, 9]).collect()] == ["c"]
    with pytest.raises(KeyError):
        FI.in_order(df, "i", [3, 9], strict=True)
    pages = spark.createDataFrame([("zh-CN", "x"), ("en", "中" * 200), (None, "中" * 200), (None, "中" * 60), (None, None)], "lang string, t string")
    assert [r.v for r in pages.select(C.declared_zh_or_en(F.col("lang"), F.col("t")).alias("v")).collect()] == ["zh", "en", "zh", "en", "en"]
    assert [r.v for r in pages.select(C.source_zh_or_en(F.col("lang"), F.col("t")).alias("v")).collect()] == ["en", "zh", "zh", "zh", "en"]


def test_quota_selection_over_several_fetches(spark):
    rows = [(i, f"g{i % 3}" if i % 7 else None, f"h{i // 5}", i % 11 if i % 4 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g string, h string, sha int")
    used, seen, want = {}, set(), []
    for i, g, h, sha in sorted(rows, key=lambda r: -r[0]):
        if len(want) < 9 and sha not in seen and used.get(("g", g), 0) < 3 and used.get(("h", h), 0) < 1:
            want.append(i)
            used["g", g], used["h", h] = used.get(("g", g), 0) + 1, used.get(("h", h), 0) + 1
            seen |= {sha} - {None}
    got = [r.id for r in W.quota_selection(df, [("id", True)], {"g": 3, "h": 1}, 9, "sha", block=4).collect()]
    assert got == want and W.quota_selection(df.limit(0), [("id", True)], {"g": 3}, 9).count() == 0
