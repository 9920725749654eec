"""Fixed values of the domain: concept names, section headers, note groups, task tables, thresholds.

Fixed values: they must be these for results to agree, and are stated as they are."""

from __future__ import annotations

#: Metric -> candidate concepts in order of preference, for annual series. Unit: USD, but shares for SharesOutstanding.
ANNUAL_CONCEPTS = {
    "Revenue": ["Revenues", "RevenueFromContractWithCustomerIncludingAssessedTax", "RevenueFromContractWithCustomerExcludingAssessedTax", "SalesRevenueNet"],
    "GrossProfit": ["GrossProfit"],
    "OperatingIncome": ["OperatingIncomeLoss"],
    "NetIncome": ["NetIncomeLoss"],
    "OperatingCashFlow": ["NetCashProvidedByUsedInOperatingActivities"],
    "CapEx": ["PaymentsToAcquirePropertyPlantAndEquipment", "PaymentsToAcquireProductiveAssets"],
    "LongTermDebt": ["LongTermDebt", "LongTermDebtNoncurrent", "LongTermDebtAndCapitalLeaseObligations", "LongTermDebtAndCapitalLeaseObligationsIncludingCurrentMaturities"],
    "SharesOutstanding": ["CommonStockSharesOutstanding"],
}

#: The same for single quarters; the order of revenue concepts differs.
QUARTERLY_CONCEPTS = {
    "Revenue": ["RevenueFromContractWithCustomerIncludingAssessedTax", "RevenueFromContractWithCustomerExcludingAssessedTax", "Revenues", "SalesRevenueNet"],
    "OperatingIncome": ["OperatingIncomeLoss"],
    "NetIncome": ["NetIncomeLoss"],
}

#: Filing type -> (forms, fiscal periods) of usable facts.
FORMS = {
    "10-K": (["10-K", "10-K/A"], ["FY"]),
    "10-Q": (["10-Q", "10-Q/A", "10-K", "10-K/A"], ["Q1", "Q2", "Q3", "Q4", "FY"]),
}
QUARTER_DAYS, ANNUAL_DAYS = (60, 100), (340, 380)

#: Section -> header in Markdown and in plain text; the last line that matches counts. Case is ignored.
HEADERS = {
    "10-K": {
        "item1": (r"^#{1,3}\s*item\s+1[\.\s]+business(?!\s*[abc])", r"^\s*ITEM\s+1\s*[\.\s]+BUSINESS\s*$"),
        "item1a": (r"^#{1,3}\s*item\s+1a[\.\s]+risk", r"^\s*ITEM\s+1A\s*[\.\s]+RISK"),
        "item1c": (r"^#{1,3}\s*item\s+1c[\.\s]+cyber", r"^\s*ITEM\s+1C\s*[\.\s]+CYBER"),
        "item7": (r"^#{1,3}\s*item\s+7[\.\s]+management", r"^\s*ITEM\s+7\s*[\.\s]+MANAGEMENT"),
        "item7a": (r"^#{1,3}\s*item\s+7a", r"^\s*ITEM\s+7A\s*[\.\s]"),
        "item8": (r"^#{1,3}\s*item\s+8[\.\s]+financial", r"^\s*ITEM\s+8\s*[\.\s]+FINANCIAL"),
        "item9a": (r"^#{1,3}\s*item\s+9a", r"^\s*ITEM\s+9A\s*[\.\s]"),
        "item10": (r"^#{1,3}\s*item\s+10", r"^\s*ITEM\s+10\s*[\.\s]"),
        "item11": (r"^#{1,3}\s*item\s+11", r"^\s*ITEM\s+11\s*[\.\s]"),
        "item13": (r"^#{1,3}\s*item\s+13", r"^\s*ITEM\s+13\s*[\.\s]"),
    },
    "10-Q": {
        "item1": (r"(?:^#{1,3}\s*|^\|?\s*)item\s+1[\.\s]+.*financial", r"^\s*ITEM\s+1\s*[\.\s]+.*FINANCIAL"),
        "item1a": (r"(?:^#{1,3}\s*|^\|?\s*)item\s+1a[\.\s]+.*risk", r"^\s*ITEM\s+1A\s*[\.\s]+.*RISK"),
        "item2": (r"(?:^#{1,3}\s*|^\|?\s*)item\s+2[\.\s]+.*management", r"^\s*ITEM\s+2\s*[\.\s]+.*MANAGEMENT"),
        "item3": (r"(?:^#{1,3}\s*|^\|?\s*)item\s+3[\.\s]+.*quantitative", r"^\s*ITEM\s+3\s*[\.\s]+.*QUANTITATIVE"),
        "item4": (r"(?:^#{1,3}\s*|^\|?\s*)item\s+4[\.\s]+.*controls", r"^\s*ITEM\s+4\s*[\.\s]+.*CONTROLS"),
    },
}
#: Sections that are returned; other headers only end the section before.
TARGETS = {
    "10-K": ["item1", "item1a", "item1c", "item7", "item8", "item9a", "item10", "item11", "item13"],
    "10-Q": ["item1", "item2", "item3", "item4"],
}
#: Titles that a table of contents has.
TITLES = {
    "10-K": {
        "item1": "Business", "item1a": "Risk Factors", "item1c": "Cybersecurity", "item7": "Management's Discussion and Analysis",
        "item8": "Financial Statements and Supplementary Data", "item9a": "Controls and Procedures", "item10": "Directors",
        "item11": "Executive Compensation", "item13": "Certain Relationships",
    },
    "10-Q": {
        "item1": "Financial Statements", "item1a": "Risk Factors", "item2": "Management's Discussion and Analysis",
        "item3": "Quantitative and Qualitative Disclosures About Market Risk", "item4": "Controls and Procedures",
    },
}
#: Filing type -> (sections wanted, all of / any of, shortest text of those there) for a split to be valid.
VALIDITY = {"10-K": (3, "any", ["item1a", "item7", "item8"], ["item1a", "item7"], 200), "10-Q": (2, "all", ["item1", "item2"], ["item1", "item2"], 500)}
#: Shortest expected text of a section.
MIN_CHARS = {"10-K": {"item1a": 3000, "item7": 5000, "item8": 5000}, "10-Q": {"item1": 2000, "item2": 3000}}
NOTES_START = r"notes?\s+to\s+(?:consolidated\s+)?financial\s+statements"
#: Note group -> letters in the group's order.
NOTE_GROUPS = {
    "fn_revenue": ["A", "B"], "fn_segment": ["C", "D"], "fn_receivables": ["L", "Q"], "fn_assets": ["M", "N", "O", "R"],
    "fn_risk": ["U", "V", "P"], "fn_pension": ["G"], "fn_compensation": ["I", "J", "K"], "fn_tax": ["H"],
}
QA_MARKERS = [r"Question[s]?\s*(?:and|&)\s*Answer[s]?\s*(?:Session)?", r"Q\s*&\s*A\s*Session", r"Q&A"]
FUZZY_RATIO = 0.85

#: Task -> keys that its result must have.
REQUIRED_KEYS = {
    "business": ["business_segments", "revenue_drivers", "insufficient_data"],
    "risk": ["risks", "top_3", "insufficient_data"],
    "mdna": ["performance_drivers", "mgmt_tone", "insufficient_data"],
    "governance": ["audit_opinion", "exec_compensation", "insufficient_data"],
    "financial": ["metrics", "quality_flags", "trend_summary", "insufficient_data"],
    "fn_revenue": ["revenue_recognition", "insufficient_data"],
    "fn_segment": ["segments", "insufficient_data"],
    "fn_receivables": ["securitization", "debt_structure", "insufficient_data"],
    "fn_assets": ["goodwill", "inventory", "insufficient_data"],
    "fn_risk": ["contingencies", "insufficient_data"],
    "fn_pension": ["funded_status", "assumptions", "insufficient_data"],
    "fn_compensation": ["sbc", "insufficient_data"],
    "fn_tax": ["effective_rate", "deferred_tax", "insufficient_data"],
    "fn_combined": ["revenue_recognition", "segments", "debt_structure", "goodwill", "contingencies", "sbc", "effective_rate", "insufficient_data"],
    "terms_glossary": ["terms", "insufficient_data"],
    "unusual_operations": ["unusual_items", "summary", "insufficient_data"],
    "segment_trend": ["segment_table", "insufficient_data"],
    "three_statement_cross": ["checks", "overall_signals", "insufficient_data"],
    "competitor_mapping": ["named_competitors", "market_position", "disclosure_quality", "mode", "insufficient_data"],
    "supply_chain": ["supply_chain_risks", "overall_risk_level", "trend", "insufficient_data"],
}
PASS_TOTAL, FULL_SCHEMA, MISSING_COST, EMPTY_COST = 70, 25, 8, 4
#: Dollars per input and output token.
TOKEN_PRICE = (3e-6, 15e-6)
#: Phase-1 tasks: (task, skill, input keys).
TASKS = [
    ("business", "business_analysis", ["item1_current", "item1_prior"]),
    ("competitor_mapping", "competitor_mapping", ["item1_current", "item1_prior"]),
    ("risk", "risk_analysis", ["item1a_current", "item1a_prior"]),
    ("mdna", "mdna_analysis", ["item7_current", "item7_prior"]),
    ("governance", "governance_analysis", ["partiii_current"]),
    ("fn_revenue", "footnotes_revenue", ["fn_revenue"]),
    ("fn_segment", "footnotes_segment", ["fn_segment"]),
    ("fn_receivables", "footnotes_receivables", ["fn_receivables"]),
    ("fn_assets", "footnotes_assets", ["fn_assets"]),
    ("fn_risk", "footnotes_risk", ["fn_risk"]),
    ("fn_pension", "footnotes_pension", ["fn_pension"]),
    ("fn_compensation", "footnotes_compensation", ["fn_compensation"]),
    ("fn_tax", "footnotes_tax", ["fn_tax"]),
    ("terms_glossary", "terms_glossary", ["all_sections_md"]),
]
PENSION_MIN_CHARS = 500
#: Words that are softened or spelt out in rendered text, applied in this order.
TERM_SUBSTITUTES = [
    ("惡化", "下降"), ("暴增", "快速增加"), ("暴跌", "快速下降"), ("崩盤", "下滑"), ("崩跌", "下滑"), ("警訊", "需留意"), ("危機", "需留意"), ("嚴重", "明顯"), ("大幅", ""),
    ("OperatingIncomeLoss", "Operating Income"), ("OperatingIncome", "Operating Income"), ("GrossProfit", "Gross Profit"), ("NetIncomeLoss", "Net Income"), ("NetIncome", "Net Income"),
    ("OperatingCashFlow", "Operating Cash Flow"), ("CapEx", "Capital Expenditure"), ("LongTermDebt", "Long-term Debt"), ("SharesOutstanding", "Shares Outstanding"),
]
#: Display names by table; a value that isn't named is shown as it is, or as DISPLAY_ELSE has it.
DISPLAY = {
    "level": {"high": "高", "medium": "中", "low": "低"},
    "trend": {"improving": "改善", "stable": "持平", "deteriorating": "下降"},
    "category": {"concentration": "集中", "geopolitical": "地緣", "price": "價格", "shortage": "短缺", "logistics": "物流", "regulatory": "法規"},
    "outlook": {"conservative": "保守", "neutral": "中性", "optimistic": "樂觀"},
    "position": {"leader": "領先", "challenger": "挑戰者", "niche": "利基", "follower": "跟隨"},
    "market": {"growing": "成長", "stable": "穩定", "declining": "下滑"},
    "class": {"industry_norm": "行業常態", "company_specific": "公司特殊", "hybrid": "混合型"},
    "tone": {"positive": "正面", "neutral": "中性", "negative": "負面"},
    "investor": {"positive": "正面", "neutral": "中性", "negative": "負面"},
    "term": {"financial": "財務", "industry": "行業", "company_defined": "公司自定", "regulatory": "法規"},
    "against": {"intensifying": "加劇", "stable": "持平", "easing": "緩解"},
    "icon": {"high": "●", "medium": "○", "low": "·"},
    "importance": {"high": "0", "medium": "1", "low": "2"},
}
DISPLAY_ELSE = {"investor": "", "icon": "·", "against": "—"}
#: Report rows in order: metric, label, format.
REPORT_ROWS = [
    ("Revenue", "營收", "money"), ("OperatingIncome", "營業利益", "money"), ("NetIncome", "淨利", "money"), ("OperatingCashFlow", "營業現金流", "money"), ("CapEx", "資本支出", "money"),
    ("LongTermDebt", "長期負債", "money"), ("SharesOutstanding", "流通股數", "shares"),
    ("rev_yoy", "營收 YoY", "signed"), ("ni_yoy", "淨利 YoY", "signed"), ("op_margin", "營業利益率", "percent"), ("net_margin", "淨利率", "percent"), ("fcf_to_revenue", "FCF 轉換率", "percent"), ("capex_to_revenue", "CapEx/營收", "percent"),
]
#: Typed results of the notes' tasks.
NOTE_SCHEMAS = {
    "fn_revenue": "revenue_recognition STRUCT<policy: STRING, timing: STRING, changed: BOOLEAN, change_detail: STRING>, new_standards ARRAY<STRUCT<standard: STRING, effective_date: STRING, impact: STRING>>, other_policy_changes ARRAY<STRING>, insufficient_data BOOLEAN",
    "fn_segment": "segments ARRAY<STRUCT<name: STRING, revenue: STRING, profit: STRING, asset_pct: STRING>>, segment_redefined BOOLEAN, geographic_mix ARRAY<STRING>, major_customers ARRAY<STRING>, restructuring STRUCT<total_charge: STRING, nature: STRING, expected_completion: STRING>, insufficient_data BOOLEAN",
    "fn_receivables": "securitization STRUCT<facility_size: STRING, drawn_amount: STRING, unsold_collateral: STRING>, customer_receivables_sold STRING, debt_structure ARRAY<STRUCT<type: STRING, amount: STRING, maturity: STRING, rate: STRING>>, covenants STRING, credit_facility STRUCT<size: STRING, drawn: STRING>, off_balance_sheet_impact STRING, insufficient_data BOOLEAN",
    "fn_assets": "inventory STRUCT<method: STRING, lifo_reserve: STRING, lifo_reserve_change: STRING>, ppe STRUCT<capex: STRING, depreciation_method: STRING>, goodwill STRUCT<total: STRING, by_unit: ARRAY<STRUCT<unit: STRING, amount: STRING>>, impairment_test: STRUCT<discount_rate: STRING, growth_rate: STRING, cushion: STRING>, cumulative_impairment: STRING>, intangibles_amortization STRING, financial_instruments STRING, insufficient_data BOOLEAN",
    "fn_risk": "contingencies ARRAY<STRUCT<description: STRING, amount: STRING, likelihood: STRING>>, environmental STRUCT<reserve: STRING, sites_count: STRING, current_portion: STRING>, commitments ARRAY<STRUCT<type: STRING, amount: STRING, nature: STRING>>, leases STRUCT<operating_total: STRING, finance_total: STRING>, subsequent_events ARRAY<STRING>, insufficient_data BOOLEAN",
    "fn_pension": "funded_status STRUCT<pbo: STRING, plan_assets: STRING, deficit: STRING>, assumptions STRUCT<discount_rate: STRING, return_on_assets: STRING, salary_growth: STRING>, unrecognized_losses STRING, asset_allocation ARRAY<STRUCT<category: STRING, pct: STRING>>, expected_contributions STRING, net_periodic_cost STRING, insufficient_data BOOLEAN",
    "fn_compensation": "sbc STRUCT<expense: STRING, to_revenue_pct: STRING, unrecognized: STRING, vest_period: STRING>, buyback STRUCT<shares: STRING, amount: STRING>, eps STRUCT<basic: STRING, diluted: STRING, dilution_sources: STRING>, aoci_components ARRAY<STRUCT<item: STRING, amount: STRING, change: STRING>>, insufficient_data BOOLEAN",
    "fn_tax": "effective_rate STRING, statutory_vs_effective STRING, major_adjustments ARRAY<STRING>, deferred_tax STRUCT<assets: STRING, liabilities: STRING, valuation_allowance: STRING, va_change: STRING>, uncertain_tax_positions STRUCT<amount: STRING, change: STRING>, tax_disputes ARRAY<STRING>, tax_credits ARRAY<STRING>, insufficient_data BOOLEAN",
    "governance": "audit_opinion STRING, internal_control_issues ARRAY<STRING>, exec_compensation STRUCT<structure: STRING, performance_linked_pct: STRING, kpi_alignment: STRING>, major_shareholders ARRAY<STRUCT<name: STRING, pct: STRING, change: STRING>>, board_independence_pct STRING, related_party_item13 ARRAY<STRING>, governance_flags ARRAY<STRING>, insufficient_data BOOLEAN",
}
#: Values that a field may have.
ENUMS = {
    "timing": ["point-in-time", "over-time", "mixed"], "likelihood": ["probable", "reasonably_possible", "remote"],
    "audit_opinion": ["unqualified", "qualified", "adverse", "disclaimer"], "kpi_alignment": ["aligned", "misaligned", "unclear"],
}
HOLDER_PERCENT, SCORE_PARTS, COVERAGE_DIMENSIONS = 5.0, (34, 33, 33), 6
#: Of these results only these keys go on to the synthesis.
SLIM_KEYS = {
    "rerate_signal": ["structure_changing", "quality_changing", "narrative_changing"],
    "segment_trend": ["structural_shift", "shift_description", "rerating_candidate_structure"],
    "three_statement_cross": ["dominant_signal", "rerating_candidate_quality", "overall_signals"],
}
#: Section key -> the name under which a task takes it.
INPUT_NAMES = {
    **{f"{k}_current": "current_section" for k in ("item1", "item1a", "item7", "partiii")}, **{f"{k}_prior": "prior_section" for k in ("item1", "item1a", "item7")},
    **{k: "current_section" for k in (*NOTE_GROUPS, "fn_combined")}, "all_sections_md": "all_sections_md",
}
#: Input -> the sections that it is made of, by filing type; several are joined by a line break.
INPUT_SECTIONS = {
    "10-K": {"item1_current": ["item1"], "item1a_current": ["item1a"], "item7_current": ["item7"], "partiii_current": ["item10", "item11", "item13"]},
    "10-Q": {"item1_current": [], "item1a_current": ["item1a"], "item7_current": ["item2"], "partiii_current": []},
}
#: Later phases in order: phase, (task, skill, the results that it reads). The first phase is ``TASKS``.
PHASES = [
    ("phase2", [("financial", "financial_analysis", ["notes"])]),
    ("phase2b", [("segment_trend", "segment_trend", ["business", "mdna"])]),
    ("phase2c", [("three_statement_cross", "three_statement_cross", ["financial"])]),
    ("phase3", [("unusual_operations", "unusual_operations", ["notes", "financial", "business"])]),
    ("phase3b", [("rerate_structure", "rerate_structure", ["segment_trend"]), ("rerate_quality", "rerate_quality", ["three_statement_cross"]), ("rerate_narrative", "rerate_narrative", ["mdna"])]),
    ("synthesis", [("insight", "insight_synthesis", ["business", "risk", "financial", "segment_trend", "three_statement_cross", "unusual_operations"])]),
    ("phase5", [("completeness", "completeness_check", ["financial", "risk", "unusual_operations", "insight"])]),
]
