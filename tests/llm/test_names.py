"""Names: readings, the segment join against brute force, links and pairs."""

import itertools
import random

import pytest

from docaudit.llm import names as N


@pytest.mark.parametrize(
    "stored,key,business",
    [
        ("Cormel Norgildra Securities", "cormel norgildra", "securities"), ("  cormel  NORGILDRA Secs.\xa0", "cormel norgildra", "securities"), ("Securities of Cormel Norgildra", "cormel norgildra", "securities"), ("Securities, Norgildra Cormel", "cormel norgildra", "securities"),
        ("CNS (Cormel Norgildra Securities)", "cormel norgildra", "securities"), ("CormelNorgildra Securities Pte. Ltd.", "cormel norgildra", "securities"), ("Cörmél-Norgildra Securities Research", "cormel norgildra", "securities"), ("Namar Perpalu Int'l Rsch", "namar perpalu", "international research"),
        ("Namar Perpalu International Research Research", "namar perpalu", "international research"), ("Nellen Kelnaqui Wlth Advisors Insights Team", "kelnaqui nellen", "wealth advisers"), ("Brical Ensacal A.M.", "brical ensacal", "asset management"), ("Delol Bedraen Private Bank GmbH", "bedraen delol", "private bank"),
        ("澜琅沅珩證券有限公司", "澜琅沅珩", "securities"), ("雁钧 鹤芮证券研究所", "雁钧鹤芮", "securities"), ("楠苓钧柏资产管理股份有限公司", "楠苓钧柏", "asset management"), ("Jormar Nornorper Capital Management - third party mirrors", "jormar nornorper", "capital management"),
    ],
)
def test_readings(stored, key, business):
    assert N.read_name(stored)[0] == ("name", key, business)


def test_missing_names_have_no_reading():
    assert all(N.read_name(x) == [] for x in ["", " ", "n/a", "N/A", "unknown", "-"])
    assert N.read_name("C. Norgildra Securities")[0][0] == "initial"


def distance(a, b, exchange):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        if exchange and i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def near(a, b):
    budget = min(2, max(len(a), len(b)) // N.LETTERS_PER_EDIT)
    return budget > 0 and (distance(a, b, False) <= budget or distance(a, b, True) == 1)


def test_segment_join_like_brute_force(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcde") for _ in range(rng.randint(3, 15))) for _ in range(70)]
    words = set(base)
    for w in base:
        for _ in range(2):
            i, k = rng.randrange(len(w) - 1), rng.randrange(len(w) - 1)
            once = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcde") + w[i:], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + rng.choice("xyz") + w[i + 1 :]])
            words |= {once, once[:k] + once[k + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :]}
    rows = [(w, w, rng.choice(["s", "t"])) for w in sorted(words)]
    got = [(r.id, r.other) for r in N.close_names(spark.createDataFrame(rows, "id string, name string, business string")).collect()]
    want = {(a, b) for (a, _, x), (b, _, y) in itertools.permutations(rows, 2) if x == y and near(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def test_an_edit_that_changes_the_order_of_the_words(spark):
    names = ["alder birch cedar", "birch cedar elder", "maple", "alder birch", "birch elder", "a b c d e f g h i j", "b c d e f g h i j k"]
    got = {(r.id, r.other) for r in N.close_names(spark.createDataFrame([(n, n, "s") for n in names], "id string, name string, business string")).collect()}
    assert {("alder birch cedar", "birch cedar elder"), ("alder birch", "birch elder")} <= got and all((b, a) in got for a, b in got)


def test_only_neighbours_are_exchanged(spark):
    rows = [(n, n, "s") for n in ["abcdefgh", "hbcdefga", "abcdfegh"]]
    got = {(r.id, r.other) for r in N.close_names(spark.createDataFrame(rows, "id string, name string, business string")).collect()}
    assert got == {("abcdefgh", "abcdfegh"), ("abcdfegh", "abcdefgh")}


def test_rings_of_any_length_and_long_chains_end(spark):
    ring = [(f"r{i}", f"r{(i + 1) % 7}") for i in range(7)] + [("tail", "r3"), ("behind", "tail")]
    line = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(300)]
    got = {r.id: r.root for r in N._roots(spark.createDataFrame(ring + line + [("x", "y"), ("y", "x")], "id string, parent string")).collect()}
    assert {got[i] for i, _ in ring} == {"r0"} and {got[i] for i, _ in line} == {"c300"} and got["x"] == got["y"] == "x"


def links(spark, stored):
    df = spark.createDataFrame([(s, 1) for s in stored], "name string, institution int")
    out: dict[str, set[str]] = {}
    for r in N.link_names(df).collect():
        out.setdefault(r.institution, set()).add(r.name)
    return {frozenset(v) for v in out.values()}


def test_links(spark):
    a = ["Cormel Norgildra Securities", "CORMEL NORGILDRA SECURITIES", "Cormel Norgildra Secs", "Cromel Norgildra Securities", "Cormel Norgilda Securities", "C. Norgildra Securities", "Norgildra Cormel Securities"]
    b = ["Cormel Norgildra Insurance Investments", "Cormel Norgildra Ins. Investments", "Cormel Norgildra Insurance Inv."]
    c = ["雁钧鹤芮证券", "雁钧鹤芮证券股份有限公司", "雁钧鹤芮证券研究 / Yanjun Herui Securities Research - third party mirrors", "Yanjun Herui Securities", N.misread("雁钧鹤芮证券"), "Yanjun Hrui Securities"]
    d = ["Baven Renvasa Capital Management", "Baven Renvasa"]
    e = ["Nael Vennorfa Asset Management", "Nael Vennora Asset Management", "Nael Vennorffa A.M.", "Nael Venvorfa Asset Management", "N. Vennorfa Asset Management"]
    stored = [*a, *b, *c, *d, *e, e[1], e[2], e[2], *a, None, "", "n/a", "x" * 5000]
    assert links(spark, stored) == {frozenset(a), frozenset(b), frozenset(c), frozenset(d), frozenset(e), frozenset(["x" * 5000])}


def test_short_names_and_well_attested_misspellings(spark):
    a = ["Keller Capital", "Keler Capital"]
    b = [f"Winterbourne Capital{x}" for x in ("", " Ltd", " Limited", " Inc", " LLC")] + [f"Winterborne Capital{x}" for x in ("", " Ltd", " Limited", " Inc")]
    c, d = ["UBS Bank"], ["UBP Bank"]  # one letter of three tells them apart
    e = ["Harrowgate Pemberlynne Capital", "Harowgate Pemberlyne Capital", "Harrowgate Pemberlynn Capital"]  # two misspellings at once
    f = ["楠苓钧柏瑜菁珩证券", "Nanlingjunboyujingheng Securities", "楠苓钧柏瑜菁珩证券有限公司"]
    f[1] = "".join(N.ideograph_syllables(spark)[c] for c in "楠苓钧柏瑜菁珩").title() + " Securities"
    assert links(spark, [*a, *b, *c, *d, *e, *f]) == {frozenset(x) for x in (a, b, c, d, e, f)}


def test_no_link_within_the_threshold_is_left_out(spark):
    groups = [
        ["Winterbourne Pemberlynne", "Winterborne Pemberlynne"],  # no business
        ["Baven Renvasa Capital Management", "Baven Renvsa"],  # no business and misspelt
        ["C. Norgildra Securities", "Norgildra C. Securities", "C. Norgilda Securities"], ["D. Norgildra Securities"],  # no whole name
        ["Harrow Quenderling Capital", "H. Quenderlin Capital"],  # an initial, and misspelt
        ["Nellen Kelna Vorsiquel Trust", "N. Kelna Vorsiquel Trust"], *([f"{w} Kelna Trust", f"{w} Kelna Trust Ltd"] for w in ("Nestor Hubrandal", "Noreen Fitzmorlay", "Ninian Cawderstone")),  # only one has all words
        ["雁钧鹤芮证券 / Dawngate Securities / Morning Door Securities", "Morning Door Securities"],  # a third reading
        ["沅珩瑜菁基金 / Brightwater Fund", "柏楠苓澜基金 / Brightwater Fund", "沅珩瑜菁基金", "柏楠苓澜基金"],  # two links of one kind
        ["琅茗舒航银行 / Oakenshaw Bank", "琅茗舒航银行", "Oakenshaws Bank", "Oakenshaws Bank Ltd", "Oakenshaws Bank Inc"],  # links of two kinds
        ["嘉澄瀚宇信托 / Silverlake Trust", "Silverlakes Trust"],  # a misspelling of what is stated only
        ["Ferdal Mosquarin / 晟朗睿衡", "晟朗睿衡", "Ferdal Mosquarin", "Ferdal Mosquarin Futures"],  # an alias of what has no business
    ]
    assert links(spark, [name for group in groups for name in group]) == {frozenset(group) for group in groups}


def test_two_edits_that_change_the_order_of_two_words(spark):
    names = ["alder birch cedar", "aedar birch zlder", "alder birch cedar dogwood", "blder dirch cedar dogwood", "aedar birch zldes"]
    got = {(r.id, r.other) for r in N.close_names(spark.createDataFrame([(n, n, "s") for n in names], "id string, name string, business string")).collect()}
    assert got == {x for a, b in [(0, 1), (2, 3), (1, 4)] for x in [(names[a], names[b]), (names[b], names[a])]}


def test_names_stated_to_be_two_stay_two(spark):
    a, b = ["楠苓钧柏银行 / Nanling Junbo Bank", "楠苓钧柏银行"], ["南陵君伯银行 / Nanling Junbai Bank", "南陵君伯银行"]
    assert links(spark, [*a, *b]) == {frozenset(a), frozenset(b)}


def test_components(spark):
    rng = random.Random(3)
    pairs = [(f"{rng.random():.6f}", f"{rng.random():.6f}") for _ in range(30)] + [(f"z{i:02d}", f"z{(7 * i + 3) % 40:02d}") for i in range(40)] + [("hub", f"leaf{i}") for i in range(9)] + [("x", "x")]
    want = {x: {x} for pair in pairs for x in pair}
    for x, y in pairs:
        both = want[x] | want[y]
        for w in both:
            want[w] = both
    root = {r.id: r.root for r in N._components(spark.createDataFrame(pairs, "id string, other string")).collect()}
    assert all({y for y in want if root.get(y, y) == root.get(x, x)} == want[x] for x in want)


def test_pairs(spark):
    df = spark.createDataFrame([(f"n{i:03d}", "hot") for i in range(200)] + [("a", "one"), ("b", "two"), ("c", "two")], "name string, institution string")
    got = [(r.name_a, r.name_b) for r in N.name_pairs(df, block=16).collect()]
    assert len(got) == len(set(got)) == 200 * 199 // 2 + 1 and all(x < y for x, y in got)


def test_empty(spark):
    df = spark.createDataFrame([], "name string")
    assert N.link_names(df).count() == 0


def test_queries(spark, data):
    pairs = N.p2_found(spark, data).toPandas()
    assert list(pairs.columns) == ["name_a", "name_b"] and len(pairs) > 100 and (pairs.name_a < pairs.name_b).all() and not pairs.duplicated().any()
