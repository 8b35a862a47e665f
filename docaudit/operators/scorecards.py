"""Scorecards of reports: each module is one struct column, so that all modules of a report are one projection.

A card has ``score``, the weighted sum of its ``parts``, and ``issues``, a struct of code, severity and place for each
finding that holds. ``readable`` makes what the modules share, once per report: normal text, tokens, sentences. Nothing
here shuffles; terms, weights and targets are parameters from ``dictionaries``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docaudit import dictionaries as D
from docaudit.functions import numbers as N
from docaudit.functions import text as X
from docaudit.functions.structures import traceable_link
from docaudit.operators import classify, redlines
from docaudit.operators.rules import first_rule, true

Finding = tuple[Column, str, str, str]


def card(parts: dict[str, tuple[float, Column]], findings: list[Finding] = (), cap: Column | None = None) -> Column:
    """``score, parts, issues`` from parts with their weights and findings with code, severity and place."""
    total = reduce(lambda a, b: a + b, (w * value for w, value in parts.values()))
    score = total if cap is None else F.least(total, cap(total))
    issues = F.array_compact(F.array(*(F.when(c, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit(place).alias("place"))) for c, code, severity, place in findings)))
    none = F.array().cast("array<struct<code:string,severity:string,place:string>>")
    return F.struct(N.half_up(score, 3).alias("score"), F.struct(*(N.half_up(v, 3).alias(k) for k, (_, v) in parts.items())).alias("parts"), (issues if findings else none).alias("issues"))


def evenly(parts: dict[str, Column]) -> dict[str, tuple[float, Column]]:
    return {k: (1 / len(parts), v) for k, v in parts.items()}


def yes(condition: Column, otherwise: float = 0.0) -> Column:
    return F.when(condition, 1.0).otherwise(F.lit(otherwise))


def mean(values: Column, default: float) -> Column:
    """The mean of an array, ``default`` for an empty one and for null."""
    n = F.size(F.coalesce(values, F.array().cast("array<double>")))
    return F.when(n > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / n).otherwise(F.lit(default))


def signal(normal: Column, terms: list[str], enough: int) -> Column:
    """How many of the terms occur, as a share of how many are enough."""
    return N.clamp(X.distinct_hits(normal, terms) / enough)


def readable(reports: DataFrame, text: str, compatibility: bool = True) -> DataFrame:
    """``reports`` with ``normal``, ``tokens``, ``sentences`` and ``views``: what modules read, made once.

    ``views`` are the normal forms of the distinct sentences without legal notices; sentences that differ in punctuation
    only are one. Null text counts as empty.
    """
    norm = lambda c: X.normalize_text(c, compatibility)
    out = reports.withColumn("normal", norm(F.col(text))).withColumn("sentences", X.split_sentences(F.col(text)))
    out = out.withColumn("tokens", X.token_set(F.col("normal")))
    # distinct by a hash of letters and digits: sorted, so that equal ones stand together
    out = out.withColumn("__n", F.transform("sentences", lambda s: X.collapse_spaces(F.lower(s))))
    out = out.withColumn("__h", F.array_sort(F.transform("__n", lambda s: F.struct(F.xxhash64(X.fingerprint(s)).alias("h"), (X.fingerprint(s) != "").alias("some"), s.alias("s")))))
    new = F.filter("__h", lambda e, i: e["some"] & ((i == 0) | (F.get(F.col("__h"), i - 1)["h"] != e["h"])))
    views = F.filter(F.transform(new, lambda e: e["s"]), lambda s: ~_any(s, D.BOILERPLATE_TERMS))
    return out.withColumn("views", views).drop("__n", "__h")


def _any(text: Column, terms: list[str]) -> Column:
    """Whether any of the terms occurs: one pattern, so that what makes the text is evaluated once, not for each term."""
    return text.rlike("|".join(rf"\Q{t}\E" for t in terms))


def _matching(sentences: Column, terms: list[str]) -> Column:
    return F.size(F.filter(sentences, lambda s: _any(s, terms)))


def delivery(quality: Column, length: Column, paged: Column, pages: Column, rendered: Column, headings: Column, visuals: Column) -> Column:
    """Whether a report came through whole: parse quality, length, and pages and renderings or headings and visuals."""
    parsed = F.when(quality.isin("excellent", "good"), 1.0).when(quality == "fair", 0.65).otherwise(0.25)
    parts = {
        "parse": parsed,
        "length": yes(F.coalesce(length, F.lit(0)) >= 4000, 0.45),
        "pages": F.when(paged, yes(true(pages > 0), 0.3)).otherwise(yes(true(headings > 0), 0.6)),
        "visuals": F.when(paged, yes(true(rendered > 0), 0.65)).otherwise(yes(true(visuals > 0), 0.75)),
    }
    return card(evenly(parts), [(true(quality == "fair"), "layout_issue", "medium", "parse"), (~F.coalesce(quality, F.lit("")).isin("excellent", "good", "fair"), "layout_issue", "high", "parse")])


def section_coverage(required: Column, normal: Column, tokens: Column, heading_text: Column) -> Column:
    """Required sections found among headings or in the text, or at least their points, and the general groups.

    ``required`` is an array of ``name, points``. A section that is not found counts 0.65 of the share of its points.
    """
    heading_tokens = X.token_set(heading_text)

    def present(name: Column, text: Column, text_tokens: Column, threshold: float) -> Column:
        return (name != "") & (F.contains(text, name) | (X.overlap_ratio(X.token_set(name), text_tokens) >= threshold))

    def score(section: Column) -> Column:
        name = X.collapse_spaces(F.lower(section["name"]))
        found = present(name, heading_text, heading_tokens, 0.36) | present(name, normal, tokens, 0.5)
        points = F.transform(F.coalesce(section["points"], F.array().cast("array<string>")), lambda p: yes(present(X.collapse_spaces(F.lower(p)), normal, tokens, 0.5)))
        return F.when(found, 1.0).otherwise(0.65 * mean(points, 0.0))

    scores = F.transform(F.coalesce(required, F.array().cast("array<struct<name:string,points:array<string>>>")), score)
    missing = F.exists(scores, lambda s: s < 0.45)
    combined = F.concat_ws("\n", heading_text, normal)
    return card({"required": (0.72, mean(scores, 0.0)), "general": (0.28, X.group_coverage(combined))}, [(missing, "missing_section", "medium", "sections")])


def traceable(links: Column, authorities: list[str] = D.AUTHORITY_TERMS) -> Column:
    """The links (``text, href``) that lead to a source: no anchors, scripts, legal or social pages; a bare host only if it has authority."""
    leads = lambda link: traceable_link(link["href"], link["text"], authorities, D.LINK_EXCLUDED)
    return F.filter(F.coalesce(links, F.array().cast("array<struct<text:string,href:string>>")), leads)


def source_quality(normal: Column, institution: Column, links: Column, pack: Column, required: Column, hints: Column, evidence: Column, authority: Column) -> Column:
    """How well a report names its sources, from counts: traceable links, entries of the source pack and how many of them
    are required, source words, pieces of evidence, marks of authority."""
    name = X.collapse_spaces(F.lower(X.text_or_empty(institution)))
    sufficiency = N.clamp((links + pack + evidence / 3 + hints / 10) / F.greatest(F.lit(3), required))
    trace = F.when(pack > 0, 1.0).otherwise(N.clamp((links + hints + evidence) / 8))
    weight = N.clamp(authority / F.greatest(F.lit(2), F.least(F.lit(8), pack + links + evidence)))
    publisher = F.when(name == "", 0.0).otherwise(yes(F.contains(normal, name), 0.75))
    parts = {"sufficiency": (0.28, sufficiency), "traceability": (0.26, trace), "authority": (0.20, weight), "publisher": (0.12, publisher), "views_told_apart": (0.14, yes(_any(normal, D.VIEW_TERMS), 0.55))}
    return card(parts, [(trace < 0.45, "missing_source", "high", "sources"), ((evidence == 0) & (hints + links > 0), "missing_source", "medium", "evidence"), ((weight < 0.25) & (required + evidence > 0), "missing_source", "medium", "authority")])


def numeric_entity(expected: Column, observed: Column, entities: list[Column], normal: Column, tokens: Column) -> Column:
    """Whether expected numbers are kept and the names that identify the report occur."""
    kept = N.preserved_share(expected, observed)
    named = F.filter(F.array(*(X.collapse_spaces(F.lower(X.text_or_empty(e))) for e in entities)), lambda e: e != "")
    found = mean(F.transform(named, lambda e: yes(F.contains(normal, e) | (X.overlap_ratio(X.token_set(e), tokens) >= 0.38))), 0.75)
    return card({"numbers": (0.68, kept), "entities": (0.32, found)}, [((F.size(expected) > 0) & (kept < 0.72), "numerical_error", "high", "key_facts"), (found < 0.5, "entity_mismatch", "medium", "entities")])


def strategy_rule(themes: Column, normal: Column) -> Column:
    """Expected themes, words of a thesis, words of a mechanism."""
    hits = mean(F.transform(F.coalesce(themes, F.array().cast("array<string>")), lambda t: yes(F.contains(normal, X.collapse_spaces(F.lower(t))))), 0.65)
    parts = {"themes": (0.40, hits), "thesis": (0.35, signal(normal, D.THESIS_TERMS, 5)), "mechanism": (0.25, signal(normal, D.MECHANISM_TERMS, 5))}
    total = reduce(lambda a, b: a + b, (w * v for w, v in parts.values()))
    return card(parts, [(total < 0.45, "weak_strategy_thesis", "medium", "strategy reasoning")])


def scenario_risk(prohibited: Column, normal: Column, tokens: Column) -> Column:
    """Words of scenarios and of risks, and that prohibited mistakes are not made."""
    made = lambda m: F.contains(normal, m) | (X.overlap_ratio(X.token_set(m), tokens) >= 0.75)
    low = F.transform(F.coalesce(prohibited, F.array().cast("array<string>")), lambda m: X.collapse_spaces(F.lower(X.text_or_empty(m))))
    avoided = mean(F.transform(low, lambda m: yes(~((m != "") & made(m)), 0.75)), 0.8)
    scenario, risk = signal(normal, D.SCENARIO_TERMS, 3), signal(normal, D.RISK_TERMS, 5)
    return card({"scenario": (0.42, scenario), "risk": (0.42, risk), "prohibited": (0.16, avoided)}, [(scenario < 0.45, "missing_scenario", "medium", "scenario"), (risk < 0.45, "compliance_issue", "medium", "risk")])


def chart_presence(visuals: Column, expected: Column, normal: Column, tokens: Column) -> Column:
    """Charts of a report without an inventory: that there are visuals, that title, source and unit words occur, that expected themes do."""
    wanted = F.filter(F.transform(F.coalesce(expected, F.array().cast("array<string>")), lambda c: X.collapse_spaces(F.lower(X.text_or_empty(c)))), lambda c: c != "")
    exists = F.when(visuals > 0, 1.0).when(F.size(wanted) == 0, 0.55).otherwise(0.25)
    labelled = X.group_coverage(normal, D.CHART_SIGNAL_GROUPS)
    matched = mean(F.transform(wanted, lambda c: yes(F.contains(normal, c) | (X.overlap_ratio(X.token_set(c), tokens) >= 0.45))), 0.75)
    return card({"existence": (0.42, exists), "labels": (0.34, labelled), "expected": (0.24, matched)}, [((F.size(wanted) > 0) & (matched < 0.35), "chart_mismatch", "medium", "charts"), ((visuals > 0) & (labelled < 0.45), "label_unit_error", "medium", "charts")])


def redline_blockers(text: Column) -> Column:
    """The redline places of a text that are blockers: hard terms without a negation around them."""
    return F.filter(redlines.spans(text, D.REDLINE_PATTERNS), lambda s: classify.redline_decision(s["matched"], s["context"], D.REDLINE_HARD_TERMS, D.REDLINE_NEGATIONS) == "blocker")


def compliance(text: Column, normal: Column, disclaimers: Column) -> Column:
    """No promise of certain returns, a disclaimer, words of caution."""
    blocked = F.size(redline_blockers(text)) > 0
    parts = {"redline": (0.5, yes(~blocked)), "disclaimer": (0.3, yes(true(disclaimers > 0), 0.67)), "caution": (0.2, yes(_any(normal, D.CAUTION_TERMS), 0.55))}
    return card(parts, [(blocked, "compliance_issue", "blocker", "redline")])


def confirmed_compliance(rule: Column, confirmed: Column, cap: float = 0.95) -> Column:
    """The rule's score where a judge's answers leave a redline standing or there are none; where all were dismissed at least ``cap``.

    ``confirmed`` is an array of the judge's answers, true for a real redline, null without a judge.
    """
    return F.when(F.size(confirmed) > 0, F.when(F.exists(confirmed, lambda c: true(c)), rule).otherwise(F.greatest(rule, F.lit(cap)))).otherwise(rule)


def structure(headings: Column, sections: Column, combined: Column, disclaimers: Column, likeness: Column) -> Column:
    """Groups of sections, number of headings and of sections; capped by how much the page looks like a report (null: no cap)."""
    hits = {g: _any(combined, terms) | (true(disclaimers > 0) if g == "disclaimer" else F.lit(False)) for g, terms in D.CANDIDATE_SECTIONS.items()}
    covered = reduce(lambda a, b: a + b, (h.cast("int") for h in hits.values())) / len(hits)
    parts = {"coverage": (0.46, covered), "headings": (0.34, N.clamp(headings / 8)), "sections": (0.20, N.clamp(sections / 8))}
    weak = [(~hits[g], "missing_section_signal", "medium", g) for g in ("executive_summary", "strategy", "scenario_risk")]
    return card(parts, [*weak, (true(likeness < 0.35), "low_report_likeness", "high", "html_body")], lambda total: F.coalesce(0.72 * N.clamp(likeness) + 0.28 * total, total))


def numeric_discipline(sentences: Column) -> Column:
    """Telling numbers in a text: how many sentences have them, with context, units and sources, and how many sentences claim something."""
    telling = F.filter(sentences, lambda s: classify.analytical_numeric(s))
    n = F.size(telling)
    numbers = F.array_distinct(F.flatten(F.transform(telling, lambda s: N.extract_numbers(s))))
    units = F.size(F.filter(numbers, lambda x: x.rlike(D.EXPLICIT_UNIT)))
    context = F.when(n > 0, F.size(F.filter(telling, lambda s: classify.has_numeric_context(s))) / n).otherwise(0.55)
    unit = N.clamp(units / F.greatest(F.lit(1), F.least(F.lit(12), F.size(numbers))))
    sourced = N.clamp(F.size(F.filter(telling, lambda s: s.rlike(D.NUMBER_SOURCE))) / F.greatest(F.lit(1), F.least(F.lit(8), n)))
    claims = N.clamp(_matching(F.transform(sentences, lambda s: X.collapse_spaces(F.lower(s))), D.CLAIM_TERMS) / 10)
    parts = {"density": (0.22, N.clamp(n / 12)), "context": (0.28, context), "units": (0.22, unit), "sources": (0.16, sourced), "claims": (0.12, claims)}
    return card(parts, [((n > 0) & (context < 0.45), "numeric_context_weak", "medium", "numbers"), ((F.size(numbers) > 0) & (unit < 0.35), "unit_signal_weak", "medium", "numbers"), (claims < 0.25, "claim_signal_weak", "low", "claims")])


def archetype(title: Column, headings: Column, normal: Column, length: Column, pages: Column) -> Column:
    """What kind of report it is, by words of its title and first headings, its length and its pages."""
    meta = X.collapse_spaces(F.lower(F.concat_ws(" ", title, F.slice(F.coalesce(headings, F.array().cast("array<string>")), 1, 6))))
    told = {k: _any(meta, terms) for k, terms in D.ARCHETYPE_TERMS.items()}
    paged = F.coalesce(pages, F.lit(0))
    summarised = F.contains(F.substring(normal, 1, 2500), F.lit("executive summary")) & (paged >= 12)
    rules = [(told["chartbook"], "chartbook"), (told["weekly_review"], "weekly_review"), (told["brief_commentary"] | (length < 6500) | paged.between(1, 8), "brief_commentary")]
    return first_rule([*rules, (told["deep_dive"] | (length >= 18000) | (paged >= 20) | summarised, "deep_dive")], "standard_strategy")


def reasoning(views: Column, kind: Column) -> Column:
    """Sentences with a thesis, a mechanism, an implication, a risk: each towards what the archetype needs, and weighed by it."""
    def by_kind(table: dict[str, dict[str, float]], name: str) -> Column:
        return first_rule_value([(kind == k, row[name]) for k, row in table.items() if k != "any"], table["any"][name])

    scores = {name: N.saturation(_matching(views, terms), by_kind(D.SIGNAL_TARGETS, name)) for name, terms in D.REASONING_SIGNALS.items()}
    parts = {name: (by_kind(D.SIGNAL_WEIGHTS, name), s) for name, s in scores.items()}
    weak = [("thesis", "weak_strategy_thesis"), ("mechanism", "missing_mechanism"), ("implication", "missing_investment_implication")]
    return card(parts, [(scores[name] < 0.35, code, "medium", "strategy") for name, code in weak])


def first_rule_value(rules: list[tuple[Column, float]], default: float) -> Column:
    out = F.lit(default)
    for condition, value in reversed(rules):
        out = F.when(condition, F.lit(value)).otherwise(out)
    return out


def decorative(words: Column, method: Column, source: Column, unit: Column, numbers: Column) -> Column:
    """Whether a visual says nothing: a picture without source, unit or numbers, or without any word of charts or of the subject."""
    given = lambda c: F.coalesce(c, F.lit("")) != ""
    n = F.size(F.coalesce(numbers, F.array().cast("array<string>")))
    return (true(method == "image_region") & ~given(source) & ~given(unit) & (n < 3)) | (~_any(words, D.CHART_WORDS) & ~_any(words, D.CHART_TOPICS) & (n < 4))


def chart_card(title: Column, caption: Column, nearby: Column, page_text: Column, source: Column, unit: Column, numbers: Column, dates: Column, kind: Column, method: Column, clarity: Column, report_normal: Column, report_numbers: Column, expected: Column) -> Column:
    """A chart by rules alone: labels, data, agreement with its page and report, clarity (given), subject."""
    none = F.array().cast("array<string>")
    text = lambda c: F.coalesce(c, F.lit(""))
    shown = F.coalesce(F.nullif(title, F.lit("")), text(caption))
    words = X.collapse_spaces(F.lower(F.concat_ws(" ", title, caption, nearby, source, kind)))
    n = F.size(F.coalesce(numbers, none))
    empty = decorative(words, method, source, unit, numbers)
    spec = (yes(shown != "") + F.when(text(unit) != "", 1.0).when(n > 0, 0.35).otherwise(0.0) + yes(text(source) != "") + yes(F.size(F.coalesce(dates, none)) > 0, 0.55)) / 4
    data = N.clamp(F.when(empty, 0.30).otherwise(0.45) + F.when(n >= 3, 0.22).when(n > 0, 0.12).otherwise(0.0) + F.when(text(unit) != "", 0.10).otherwise(0.0) + F.when(expected, 0.10).otherwise(0.0) + F.when(text(source) != "", 0.05).otherwise(0.0))
    page = X.collapse_spaces(F.lower(F.coalesce(F.nullif(page_text, F.lit("")), text(nearby))))
    head = F.substring(X.collapse_spaces(F.lower(text(title))), 1, 40)
    part = lambda condition, value: F.when(condition, value).otherwise(0.0)
    aligned = N.clamp(0.35 + part(_any(page, D.CHART_EXPLANATIONS), 0.30) + part((head != "") & F.contains(page, head), 0.15) + part((head != "") & true(F.contains(report_normal, head)), 0.10) + part(true(F.arrays_overlap(F.coalesce(numbers, none), F.coalesce(report_numbers, none))), 0.10))
    subject = N.clamp(0.55 + part(_any(words, D.CHART_FINANCE_TERMS), 0.25) + part(expected, 0.20))
    aligned, subject = F.when(empty, F.least(aligned, F.lit(0.45))).otherwise(aligned), F.when(empty, F.least(subject, F.lit(0.35))).otherwise(subject)
    values = {"spec_completeness": spec, "data_faithfulness": data, "chart_text_alignment": aligned, "visual_clarity": clarity, "financial_appropriateness": subject}
    findings = [(spec < 0.55, "label_unit_error", "medium", "chart"), (empty, "decorative_chart", "medium", "chart"), (data < 0.5, "chart_data_error", "high", "chart"), (aligned < 0.5, "chart_text_misalignment", "high", "chart"), (clarity < 0.5, "visual_readability_issue", "medium", "chart")]
    return card({k: (D.CHART_PART_WEIGHTS[k], v) for k, v in values.items()}, findings)
