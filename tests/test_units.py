"""Quantities in common units: spellings, signs, separators, where units stand, and odd records."""

import itertools
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docaudit.operators import units as U

COMMON = {"rate": "percent", "valuation": "times", "tenor": "month", "power": "MW", "mass": "tonne", "dollar_amount": "USD", "euro_amount": "EUR", "yuan_amount": "CNY"}
SCHEMA = "chart_row_id long, numbers array<string>, dates array<string>, unit_hint string, title string, caption string, nearby_text string"


def record(numbers, hint=None, title=None, caption=None, nearby=None, dates=None):
    return [(k, v) for _, k, v, _ in U.record_quantities(numbers, dates or [], hint, title, caption, nearby)]


@pytest.mark.parametrize(
    "entry,kind,value",
    [
        ("US$+59,655mn", "dollar_amount", "59655000000"), ("$~4,12 Mrd.", "dollar_amount", "4120000000"), ("€ (0.5) Mrd.", "euro_amount", "-500000000"), ("0.60百万元", "yuan_amount", "600000"), ("-1.60 百万元", "yuan_amount", "-1600000"),
        ("人民币7171", "yuan_amount", "7171"), ("1.88亿美元", "dollar_amount", "188000000"), ("1,5‰", "rate", "0.15"), ("(8) bp", "rate", "-0.08"), ("−1.43 %", "rate", "-1.43"), ("0.69个百分点", "rate", "0.69"),
        ("0.52x", "valuation", "0.52"), ("33个季度", "tenor", "99"), ("12.1 years", "tenor", "145.2"), ("3 Jahre", "tenor", "36"), ("2,53 kt", "mass", "2530"), ("6 377,9 t", "mass", "6377.9"), ("1,655万千瓦", "power", "16550"), ("500 kW", "power", "0.5"),
        ("７７０１０ EUR", "euro_amount", "77010"), ("32 457.3mn CNY", "yuan_amount", "32457300000"), ("175.108,17mn EUR", "euro_amount", "175108170000"), ("$16'610.12mn", "dollar_amount", "16610120000"), ("1.2 million tonnes", "mass", "1200000"), ("3元", "yuan_amount", "3"),
    ],
)
def test_entries(entry, kind, value):
    assert record([entry]) == [(kind, Decimal(value))]


def test_places_and_parts():
    assert record(["161"], hint="EUR", nearby="Net issuance\nAmounts in million") == [("euro_amount", Decimal(161_000_000))]
    assert record(["30k"], hint="€") == [("euro_amount", Decimal(30_000))]
    assert record(["5"], hint="millions", title="Net issuance – Asia (yuan)") == [("yuan_amount", Decimal(5_000_000))]
    assert record(["7"], hint="n/a", title="Net leverage [multiple (x)]") == [("valuation", Decimal(7))]
    assert record(["7"], caption="All figures: %") == [("rate", Decimal(7))]
    assert record(["7"], nearby="Copper demand\nNote: unit = '000 tonnes") == [("mass", Decimal(7000))]
    assert record(["0.05"], hint="fraction, 1.0 = 100%") == [("rate", Decimal("5.00"))]
    assert record(["7 bp"], hint="单位：%") == [("rate", Decimal("0.07"))]
    assert record(["CNY 500"], hint="euros thousands") == [("yuan_amount", Decimal(500))]
    assert record(["5bn"], hint="in bps") == [] and record(["7"], nearby="rose by 5% last year and fell") == []
    assert record(["2024", "3%"], dates=["2024"]) == [("rate", Decimal(3))]


def test_ambiguous_numbers_follow_their_record():
    assert record(["3,871", "6,301.64"], hint="$") == [("dollar_amount", Decimal(3871)), ("dollar_amount", Decimal("6301.64"))]
    assert record(["1.234", "1,250.5", "1,300.5"], hint="$")[0][1] == Decimal(1234)
    assert record(["1.234", "1.2", "1.3"], hint="x")[0][1] == Decimal("1.234")


def test_the_joint_choice_is_the_cheapest_of_all_combinations():
    rng = random.Random(3)
    for _ in range(400):
        options = []
        for _ in range(rng.randint(1, 7)):
            v = Decimal(str(round(10 ** rng.uniform(-1, 7), 3)))
            options.append([v, v * 1000] if rng.random() < 0.3 else [v, v / 1000] if rng.random() < 0.4 else [v])

        def cost(picks, options=options):
            x = [math.log10(o[k]) for o, k in zip(options, picks, strict=True)]
            return sum((y - sum(x) / len(x)) ** 2 for y in x) + U.UNUSUAL * sum(k > 0 for k in picks)

        got = [o.index(v) for o, (v, _) in zip(options, U._choose(options), strict=True)]
        assert abs(cost(got) - min(map(cost, itertools.product(*(range(len(o)) for o in options))))) < 1e-6
    assert U._choose([[Decimal(1234), Decimal("1.234")]]) == [(Decimal(1234), False)] and U._choose([]) == []


def test_units_in_long_lines():
    line = "Copper demand of the regions that the report covers, over the whole of the period and after all revisions of the source " * 20
    assert record(["7"], nearby=line + "(percent)") == [("rate", Decimal(7))]
    assert record(["7"], caption="(bp) " + line) == [("rate", Decimal("0.07"))]
    assert record(["7"], caption=line + "in thousand    tonnes") == [("mass", Decimal(7000))]


def test_operator_on_odd_rows(spark):
    data = [(1, None, None, None, None, None, None), (2, [], [], "%", None, None, None), (3, [None, "", "n/a", "1-2", "5"], None, "%", "", "", ""), (3, ["5"], ["5"], "%", None, None, None), (4, ["5"], None, "x" * 100_000, "y" * 100_000, None, "z\n" * 50_000)]
    df = spark.createDataFrame(data, SCHEMA).withColumn("milli", F.lit("clash"))
    assert [(r.chart_row_id, r.value_no, r.common_unit, r.milli) for r in U.declared_quantities(df, COMMON).collect()] == [(3, 5, "percent", 5000)]
    assert U.declared_quantities(df.limit(0), COMMON).count() == 0


def test_identity(spark):
    data = [("a", m, d, v) for d, v in ((2.0, 3.0), (4.0, 5.0)) for m in (d * v * 1000,)] + [("b", 1.0, 1.0, None), ("c", 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(data, "g string, mass double, density double, volume double")
    sizes = {"mass": {"kg": 1.0, "g": 0.001}, "density": {"kg/l": 1.0, "kg/m3": 0.001}, "volume": {"l": 1.0}}
    got = {r.g: r for r in U.identity_units(df, ["g"], "mass", ["density", "volume"], sizes).collect()}
    assert (got["a"].unit_mass, got["a"].unit_density, got["a"].is_unique) == ("g", "kg/l", True)
    assert got["b"].unit_mass is None and got["c"].n_rows == 0
    same = U.identity_units(df.where("g = 'a'"), ["g"], "mass", ["density", "volume"], {"mass": {"g": 0.001, "mg": 0.001}, "density": {"kg/l": 1.0}, "volume": {"l": 1.0}})
    assert same.first().is_unique is False
