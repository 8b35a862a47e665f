"""Default dictionaries, patterns, weights and thresholds.

Every operator takes its dictionary as a parameter; these are the values that must be as they
are for results to agree with the published ones (fixed values).
"""

from __future__ import annotations

#: Words that carry no meaning of their own in token overlap.
STOPWORDS = "the and for with from that this into are not report section strategy outlook research market".split()

#: Words left out of the tokens that charts are matched by, and the pattern of those tokens.
CHART_STOPWORDS = "the and for with from amid focus chart table figure figures events source sources investment market markets".split()
CHART_TOKEN = r"[\x{4e00}-\x{9fff}]{2,}|[a-z0-9]{3,}"

#: Numbers with an optional currency and unit, not within a word or another number.
NUMBER_PATTERN = (
    r"(?<![\w.])(?:[$€£¥]\s*)?[-+]?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?"
    r"(?:\s*(?:[-–—]\s*)?(?:%|pct|bps|bp|x|times|倍|个百分点|个基点|万亿|亿元|亿美元|"
    r"trillion|billion|million|thousand|bn|mn|trn|years?|months?|quarters?|"
    r"€|£|\$|¥|元|亿|万))?(?![\w.])"
)
DATE_PATTERN = (
    r"\b(?:20\d{2}|19\d{2})(?:[-/.年](?:0?[1-9]|1[0-2]))?(?:[-/.月](?:0?[1-9]|[12]\d|3[01]))?日?\b"
    r"|\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)[a-z]*\.?\s+\d{1,2},?\s+20\d{2}\b"
)
#: Spellings of units: the class of each and the size of one (fixed values).
QUANTITY_UNITS = {
    "%": ("percent", 1.0), "pct": ("percent", 1.0),
    "ppt": ("percent_point", 1.0), "ppts": ("percent_point", 1.0), "percentage point": ("percent_point", 1.0), "percentage points": ("percent_point", 1.0),
    "bps": ("bps", 1.0), "bp": ("bps", 1.0), "个基点": ("bps", 1.0), "基点": ("bps", 1.0), "个百分点": ("percent_point", 1.0),
    "x": ("multiple", 1.0), "times": ("multiple", 1.0), "倍": ("multiple", 1.0),
    "元": ("cny", 1.0), "人民币": ("cny", 1.0), "万元": ("cny", 1e4), "万亿元": ("cny", 1e12),
    "亿": ("generic_amount", 1e8), "万": ("generic_amount", 1e4), "万亿": ("generic_amount", 1e12), "亿元": ("cny", 1e8),
    "美元": ("usd", 1.0), "万美元": ("usd", 1e4), "亿美元": ("usd", 1e8),
    "mn": ("generic_amount", 1e6), "million": ("generic_amount", 1e6), "bn": ("generic_amount", 1e9), "billion": ("generic_amount", 1e9),
    "tn": ("generic_amount", 1e12), "trn": ("generic_amount", 1e12), "trillion": ("generic_amount", 1e12),
}
#: How well two quantities agree: by relative difference up to so much, by classes that may mean the same, and the weights of both (fixed values).
VALUE_STEPS = ((0.002, 1.0), (0.01, 0.92), (0.05, 0.75))
PLAIN_AGREEMENT, AMOUNT_AGREEMENT = 0.65, 0.72
VALUE_WEIGHT, UNIT_WEIGHT = 0.78, 0.22
#: What gives a number a context, and what tells that a number says nothing (fixed values).
NUMERIC_CONTEXT = {
    "unit": r"(?i)[%$¥元亿万]|bps|bn|mn|trn|pct|percentage|percent",
    "date": r"(?i)\b20\d{2}\b|年|季度|quarter|q[1-4]",
    "direction": r"(?i)increase|decrease|growth|decline|up|down|提升|下降|增长|回落|上升",
    "name": r"[\x{4e00}-\x{9fff}]{2,}|[A-Z][A-Za-z&.\-]{2,}",
}
NUMERIC_UNIT = r"(?i)[%$€£¥元亿万]|bps?|pct|trillion|billion|million|thousand|bn|mn|trn|years?|months?|quarters?|倍|个百分点|个基点"
DOCUMENT_CODE = r"\b[A-Z]{2,}\d{3,}(?:-\d+)*(?:/\d+)?\b"
IMPRINT_TERMS = ["volume ", "edited by", "isbn", "copyright", "all rights reserved", "page ", "页码"]
YEARS, TINY, MANY_NUMBERS, FEW_OTHERS = (1900, 2100), 3, 8, 2
#: Terms that speak of risk, scenarios, sources and reasoning, and the groups a report should touch (fixed values).
RISK_TERMS = ["risk", "uncertainty", "volatility", "policy", "execution", "market", "data limitation", "风险", "不确定", "波动", "政策", "执行", "市场", "数据"]
SCENARIO_TERMS = ["base case", "upside", "downside", "scenario", "sensitivity", "bear", "bull", "基准", "上行", "下行", "情景", "敏感性"]
SOURCE_TERMS = ["source", "according to", "数据来源", "资料来源", "来源"]
#: Statements of a source in a text, up to ``{rest}``; and names that give a source authority.
SOURCE_STATEMENT = (
    r"(?:\b(?:source|sources|data source)\b\s*[:：\-]\s*{rest}|\b(?:based on|according to)\b\s+{rest}"
    r"|(?:资料来源|数据来源|信息来源|来源)\s*[:：\-]\s*{rest})"
)
AUTHORITY_TERMS = (
    ["wind", "bloomberg", "reuters", "factset", "markit", "ceic", "haver", "fred", "imf", "world bank", "bis", "federal reserve", "sec", "exchange"]
    + "统计局 央行 人民银行 交易所 证监会 财政部 海关总署 同花顺 万得 中证 上交所 深交所 北交所".split()
    + ["sec.gov", "federalreserve.gov", "imf.org", "worldbank.org", "bis.org", "gov", "公告", "监管", "goldman", "j.p. morgan", "jpmorgan", "morgan stanley"]
    + "blackrock ubs citi deutsche fidelity vanguard 中信 华泰 国泰君安 广发 招商证券 申万宏源".split()
)
#: Where the tail of a web page begins: plain markers, and the cards of related articles.
BOUNDARY_MARKERS = [" Discover More ", " Disclosures: ", " Risk Considerations ", " Important Information ", " View Disclosures"]
RELATED_CARD = r"\s(?:WEALTH MANAGEMENT|GLOBAL CAPITAL MARKETS|INVESTMENT MANAGEMENT|RESEARCH)\s+[A-Z][A-Za-z0-9’'&,\-–— ]{8,100}"
SECTION_GROUPS = {
    "summary": ["summary", "executive", "key takeaways", "摘要", "要点", "核心观点"],
    "evidence": ["evidence", "source", "data", "chart", "facts", "证据", "数据", "来源"],
    "strategy": ["strategy", "thesis", "implication", "allocation", "策略", "推理", "配置", "影响"],
    "scenario": SCENARIO_TERMS,
    "risk": RISK_TERMS,
    "closing": ["appendix", "disclaimer", "important information", "references", "免责声明", "附录"],
}
#: Severity order of issues; anything else comes last.
SEVERITY_RANK = {"blocker": 0, "high": 1, "medium": 2, "low": 3}
UNKNOWN_RANK = 9
#: Grades from the highest threshold down; below all of them the last.
GRADES = ((90, "Gold"), (80, "Silver"), (70, "Bronze"))
LOWEST_GRADE = "Reject"
#: Signs of text decoded with the wrong table.
MOJIBAKE_MARKERS = ["Ã", "â€", "Â", "锟斤拷", "�"]

# --- terms of the scorecards: fixed values, as they must be for results to agree ---

THESIS_TERMS = ["we believe", "we expect", "thesis", "catalyst", "implication", "recommend", "position", "认为", "预计", "核心观点", "催化", "影响", "配置", "建议"]
MECHANISM_TERMS = ["because", "driven by", "therefore", "leads to", "implication", "由于", "驱动", "因此", "传导", "影响"]
VIEW_TERMS = ["we believe", "we expect", "assumption", "假设", "认为", "预计", "测算"]
CAUTION_TERMS = ["may", "could", "risk", "uncertain", "assumption", "可能", "风险", "不确定", "假设"]
REDLINE_PATTERNS = [r"\bguaranteed return\b", r"\brisk[- ]?free\b", r"\bmust buy\b", r"\bsure profit\b", "必涨", "稳赚", "无风险", "保证收益", "保本保收益"]
REDLINE_HARD_TERMS = ["guaranteed return", "must buy", "sure profit", "必涨", "稳赚", "保证收益", "保本保收益"]
REDLINE_NEGATIONS = (
    ["not risk-free", "not risk free", "not guaranteed", "no guarantee", "does not guarantee", "cannot guarantee"]
    + "不保证 不能保证 并非无风险 不是无风险 并不无风险 不代表无风险 不构成 风险自担 入市有风险".split()
)
CHART_SIGNAL_GROUPS = {"name": ["figure", "chart", "table", "图", "表"], "source": ["source", "资料来源", "数据来源"], "unit": ["%", "bps", "unit", "单位", "$", "bn"]}
CHART_WORDS = ["figure", "chart", "table", "exhibit", "source", "图", "表", "资料来源", "数据来源"]
CHART_TOPICS = ["rate", "yield", "gdp", "inflation", "debt", "allocation", "portfolio", "risk", "market", "利率", "收益率", "通胀", "债", "配置", "风险"]
CHART_FINANCE_TERMS = ["rate", "yield", "gdp", "inflation", "earnings", "valuation", "allocation", "portfolio", "growth", "risk", "利率", "收益率", "通胀", "估值", "配置", "增长", "风险"]
CHART_EXPLANATIONS = ["shows", "indicates", "suggests", "driven", "trend", "increase", "decline", "显示", "表明", "趋势", "上升", "下降", "反映"]
CANDIDATE_SECTIONS = {
    "executive_summary": ["summary", "executive", "key takeaways", "核心观点", "摘要", "要点"],
    "market_context": ["market", "macro", "industry", "policy", "市场", "宏观", "行业", "政策"],
    "evidence": ["data", "evidence", "source", "chart", "analysis", "forecast", "estimate", "数据", "证据", "来源", "图表", "分析", "预测", "测算"],
    "strategy": ["strategy", "thesis", "allocation", "implication", "positioning", "preference", "investors", "策略", "逻辑", "配置", "影响", "投资者", "建议"],
    "scenario_risk": ["scenario", "risk", "sensitivity", "uncertainty", "情景", "风险", "敏感性", "不确定"],
    "disclaimer": ["disclaimer", "important information", "risk disclosure", "免责声明", "风险提示"],
}
CLAIM_TERMS = ["we expect", "we believe", "forecast", "estimate", "may", "could", "预计", "认为", "测算", "预测", "可能", "有望"]
NUMBER_SOURCE = r"(?i)source|according to|based on|来源|资料|数据"
EXPLICIT_UNIT = r"(?i)[%$€£¥元亿万]|bps|bp|bn|mn|trn|pct|trillion|billion|million|thousand|years?|months?|quarters?"
BOILERPLATE_TERMS = [
    "important information", "for informational purposes", "does not constitute", "not constitute", "not investment advice", "no representation", "no warranty", "past performance", "future results",
    "strictly incidental", "covered by such sanctions", "appropriate investment strategies depend", "免责声明", "不构成投资建议", "不作为投资建议", "过往业绩", "风险揭示书",
]
REASONING_SIGNALS = {
    "thesis": [
        "we believe", "we expect", "we think", "we see", "we view", "we favor", "we prefer", "we remain", "is tilting", "are tilting", "our target", "target for", "our view", "our outlook", "our base case",
        "our conviction", "thesis", "stands out", "well placed", "we are overweight", "we are underweight", "we are neutral", "核心观点", "认为", "预计", "判断",
    ],
    "mechanism": [
        "because", "driven by", "supported by", "underpinned by", "benefit from", "benefiting from", "reflects", "resulting in", "as a result", "due to", "reason for", "in other words", "suggests that", "means that", "requires",
        "relies on", "reliant on", "is linked to", "creates", "makes it", "fueled by", "therefore", "leads to", "leading to", "which would", "would reduce", "would increase", "could reduce", "could increase", "helps", "allowing",
        "enabling", "implies", "catalyst", "transmission", "mechanism", "由于", "驱动", "因此", "传导", "催化", "机制", "影响",
    ],
    "implication": [
        "implication", "allocation", "position", "positioning", "recommend", "watch", "target", "opportunity set", "tilting portfolios", "tilt portfolios", "portfolio toward", "for investors", "overweight", "underweight", "we favor",
        "we prefer", "well placed", "stands out", "investors need", "investors should", "配置", "建议", "关注", "影响", "机会", "超配", "低配",
    ],
    "risk": ["risk", "downside", "uncertainty", "sensitivity", "vulnerable", "headwind", "风险", "下行", "不确定", "敏感"],
}
#: How many sentences of each signal are enough, and what the signals weigh, by archetype; any other is as the last.
SIGNAL_TARGETS = {
    "brief_commentary": {"thesis": 3, "mechanism": 7, "implication": 4, "risk": 4},
    "chartbook": {"thesis": 3, "mechanism": 7, "implication": 5, "risk": 5},
    "weekly_review": {"thesis": 3, "mechanism": 8, "implication": 5, "risk": 5},
    "any": {"thesis": 4, "mechanism": 10, "implication": 4, "risk": 4},
}
SIGNAL_WEIGHTS = {
    "brief_commentary": {"thesis": 0.34, "mechanism": 0.22, "implication": 0.30, "risk": 0.14},
    "chartbook": {"thesis": 0.34, "mechanism": 0.22, "implication": 0.30, "risk": 0.14},
    "weekly_review": {"thesis": 0.30, "mechanism": 0.26, "implication": 0.28, "risk": 0.16},
    "any": {"thesis": 0.27, "mechanism": 0.32, "implication": 0.24, "risk": 0.17},
}
ARCHETYPE_TERMS = {
    "chartbook": ["6 张图", "chartbook", "in charts", "图看", "图表专题"],
    "weekly_review": ["weekly", "周报", "周观点", "双周报", "market review", "market weekly", "定期报告"],
    "brief_commentary": ["点评", "commentary", "快评", "brief", "首席观点"],
    "deep_dive": ["深度", "专题", "白皮书", "deep dive"],
}
LINK_EXCLUDED = (
    r"(?i)/bio(?:\.html)?/|/footer/|global entities|worldwide entities|/investment-management/?$|privacy|cookie|terms|disclaimer|accessibility|contact|careers|"
    r"linkedin|facebook|instagram|youtube|twitter|x\.com"
)
CHART_PART_WEIGHTS = {"spec_completeness": 0.18, "data_faithfulness": 0.28, "chart_text_alignment": 0.24, "visual_clarity": 0.18, "financial_appropriateness": 0.12}
CHART_DIMENSION_WEIGHTS = {"inventory": 0.15, "spec_completeness": 0.15, "data_faithfulness": 0.25, "chart_text_alignment": 0.20, "visual_clarity": 0.15, "financial_appropriateness": 0.10}
REFERENCE_WEIGHTS = {"structure": 12.0, "sources": 18.0, "facts": 18.0, "strategy_reasoning": 16.0, "scenario_risk": 10.0, "charts": 14.0, "writing_layout": 7.0, "compliance": 5.0}
CANDIDATE_WEIGHTS = {"delivery": 10.0, "structure": 14.0, "source_traceability": 14.0, "claim_numeric_discipline": 16.0, "strategy_reasoning": 18.0, "scenario_risk": 10.0, "visual_qa": 13.0, "compliance": 5.0}

# --- assessment of web pages, report pages and visuals: fixed values ---

ARTICLE_LIMITS = {"zh": {"text": 1800, "ideographs": 900, "long_paragraphs": 5}, "en": {"text": 3000, "ideographs": 0, "long_paragraphs": 6}}
GENERIC_TITLES = ["insights", "research", "publications", "markets & insights", "markets and insights", "investment insights", "perspectives", "ideas", "the markets", "global market outlook"]
REJECTED_PAGE_TERMS = ["podcast", "video", "webcast", "/people/", "/person/", "/about-us/", "investment-professionals", "professionals/", "events"]
STRATEGY_TERMS = (
    ["outlook", "strategy", "allocation", "portfolio", "market", "macro", "risk", "scenario", "forecast", "investment", "equity", "fixed income", "credit", "inflation", "growth", "policy", "earnings", "valuation"]
    + "配置 策略 市场 宏观 风险 情景 投资 权益 债券 通胀 增长 政策".split()
)
NAVIGATION_TERMS = ["home", "menu", "subscribe", "sign in", "contact us", "privacy", "cookie", "all rights reserved", "首页", "导航", "登录", "注册", "联系我们"]
INVENTORY_TERMS = ["outlook", "strategy", "market", "macro", "portfolio", "allocation", "equity", "fixed income", "credit", "rates", "investment", "economic"] + "展望 策略 市场 宏观 配置 权益 固收 利率 信用 投资".split()
LISTING_TERMS = ["contact us", "latest insights", "all insights", "events", "podcasts", "investment stewardship", "interactive charts", "research library", "联系我们", "最新观点", "研究报告列表", "报告列表"]
LIKENESS_NUMBERS = r"(?i)\b20\d{2}\b|[%$]|bps|bp|trillion|billion|million|万亿|亿元|基点"
UNIT_SIGNAL = r"(?i)%|bps|bp|percent|percentage|usd|eur|rmb|cny|\$|\bbn\b|\bmn\b|\btrn\b|\btimes\b|单位|亿元|亿美元|万亿|百分点|个基点"
CHART_SIGNAL = r"(?i)figures in focus|figure|fig\.|exhibit|chart|table|图表|圖表|图\s*\d+|圖\s*\d+|表\s*\d+"
SOURCE_SIGNAL = r"(?i)\bsources?:|资料来源|資料來源|数据来源|數據來源|来源"
CONTENTS_SIGNAL = r"(?i)\btable of contents\b|\bcontents\b|目录|目錄|图表目录|圖表目錄|list of figures|list of tables"
LEGAL_SIGNAL = r"(?i)important information|disclosures?|免责声明|风险提示|法律声明|copyright|all rights reserved"
CHART_TITLE = r"(?i)\b(?:figure|fig\.|exhibit|chart|table)\s*[\dA-ZIVX.-]*|(?:图表|圖表|图|圖|表)\s*[\d一二三四五六七八九十百]+"
RUNNING_FOOTER = r"(?i)^\d+$|important information|disclosures"
FACT_COMPLIANCE_TERMS = ["solicitation", "past performance", "informational purposes", "disclaimer"]
FACT_METADATA_TERMS = ["disclaimer", "for informational purposes", "not a solicitation", "past performance", "does not guarantee future", "series", "part of", "midyear outlook", "source report", "publication", "author", "copyright"]
FACT_STRATEGY_TERMS = ["recommend", "overweight", "underweight", "allocation", "配置", "建议", "看好", "低配", "高配"]
CONTENTS_TITLES = ["table of contents", "contents", "图表目录", "目录"]
LEGAL_TITLES = ["disclaimer", "important information", "risk disclosure", "免责声明", "重要声明", "风险提示", "法律声明"]
