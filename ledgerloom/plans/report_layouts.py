"""The report's sections as templates (see ``operators.layouts``). Headings and names are fixed values of the report."""

from __future__ import annotations

from dataclasses import replace

from ..operators.layouts import Section

_TEXT, _ANY = "{@!s}", ("$",)


def _under(prefix: str, sections: list[Section]) -> list[Section]:
    """The sections of one task's result, within a result that holds all tasks'."""
    at = lambda p: "$." + prefix + p[1:]
    return [replace(s, path=at(s.path), shown=tuple(map(at, s.shown)), needs=tuple(map(at, s.needs)), unless=at(s.unless) if s.unless else None) for s in sections]


#: Of a transcript's result.
GUIDANCE = [
    Section("$.forward_guidance.hard_guidance", "| {metric!c} | {value=—!c} | {period=—!c} | {direction=—!c} | {verbatim!c} |", "### 硬性指引（Hard Guidance）\n| 指標 | 數值 | 期間 | 方向 | 原文 |\n|------|------|------|------|------|", empty="（本季無硬性指引）"),
    Section("$.forward_guidance.soft_guidance", "- **{area!s}**[direction+confidence|（{direction+confidence}）]：{detail!s}", "### 軟性指引（Soft Guidance）"),
    Section("$.forward_guidance.guidance_changes", "| {metric!c} | {previous=—!c} | {current=—!c} | {change=—!sc} |", "### 指引變化\n| 指標 | 前次 | 本次 | 變化 |\n|------|------|------|------|"),
    Section("$.forward_guidance.implied_signals", "", "### 隱含訊號"),
]
HIGHLIGHTS = [
    Section("$.structured_summary.headline", "### {@!s}", None, "one"),
    Section("$.structured_summary.financial_highlights", "| {metric!c} | {reported=—!c} | {consensus=—!c} | {beat_miss!c} | {yoy_change!c} | {driver!sc} |", "#### 財務亮點\n| 指標 | 實際 | 預期 | 結果 | YoY | 驅動因子 |\n|------|------|------|------|------|----------|"),
    Section("$.structured_summary.segment_performance", "| {segment!c} | {direction!c} | {detail!sc} |", "#### 業務部門表現\n| 部門 | 方向 | 描述 |\n|------|------|------|"),
    Section("$.structured_summary.operational_highlights", "", "#### 營運亮點"),
    Section("$.structured_summary.challenges", "", "#### 挑戰"),
    Section("$.structured_summary.capital_allocation", "- **{key}**：{value!s}", "#### 資本配置", "pairs"),
    Section("$.sentiment", "", "### 管理層語氣分析", "one", shown=("$.sentiment",)),
    Section("$.sentiment", "[overall_tone|**整體語氣**：{overall_tone!s}]", None, "one"),
    Section("$.sentiment", "[confidence_level|**信心程度**：{confidence_level!p}]", None, "one"),
    Section("$.sentiment", "[tone_gap|**語氣落差**：{tone_gap!s}]", None, "one"),
    Section("$.sentiment", "[ceo_cfo_alignment|**CEO/CFO 一致性**：{ceo_cfo_alignment!s}]", None, "one"),
    Section("$.sentiment.evasive_topics", "- [signal|**{topic!s}**：{signal!s}][!signal|{topic!s}]", "**迴避主題**："),
    Section("$.sentiment.language_shifts", "- **{topic!s}**：[previous+current|`{previous}` → `{current}`[interpretation|（{interpretation!s}）]][!previous+current|{interpretation!s}]", "**語言轉變**："),
    Section("$.partnerships_and_strategy", "", "### 夥伴關係與策略", "one", shown=("$.partnerships_and_strategy",)),
    Section("$.partnerships_and_strategy.new_partnerships", "- **{partner!s}**[nature+scale+revenue_impact|（{nature+scale+~revenue_impact}）]：{detail!s}", "**新夥伴關係**："),
    Section("$.partnerships_and_strategy.existing_updates", "- **{partner!s}**[status|（{status}）]：{detail!s}", "**既有夥伴更新**："),
    Section("$.partnerships_and_strategy.strategic_shifts", "- **{area!s}**：{description!s}[implications|（{implications!s}）]", "**策略轉變**："),
    Section("$.partnerships_and_strategy.competitive_dynamics", "", "**競爭動態**："),
    Section("$.partnerships_and_strategy.supply_chain", "", "**供應鏈**："),
]
NO_HIGHLIGHTS = "（本季 Earnings Call 摘要資料不完整）"
#: What stands in a transcript's sections where there is none.
UNAVAILABLE = "## {section}\n\n*本季 transcript 未能取得，可能尚未發布或來源暫不可用。*"
TRANSCRIPT_SECTIONS = ["Forward Guidance", "Market Concerns", "Earnings Call Highlights"]

_SHIFTS = ("$.yoy_changes.improvements", "$.yoy_changes.deteriorations")
#: Of a supply chain's result.
SUPPLY = [
    replace(s, unless="$.insufficient_data")
    for s in (
        Section("$", "**整體風險：{overall_risk_level:level}　趨勢：{trend:trend}**", "## 供應鏈分析", "one"),
        Section("$.raw_materials", "| {material!c} | {usage!c} | {source_concentration:level} | {geographic_risk!c} |", "### 原物料\n| 原物料 | 用途 | 集中風險 | 地緣風險 |\n|--------|------|----------|----------|"),
        Section("$.supply_chain_risks", "- [{category:category}] {title}：{summary!s}", "### 主要風險"),
        Section("$.yoy_changes.improvements", "", "### 跨期變化\n**正向變化**", empty="- —", shown=_SHIFTS),
        Section("$.yoy_changes.deteriorations", "", "**負向變化**", empty="- —", shown=_SHIFTS),
        Section("$.mdna_impact", "[impact_description|{impact_description!s}（管理層展望：{mgmt_outlook:outlook}）]", "### MD&A 實際影響", "one"),
        Section("$.purchase_commitments", "{total_commitment_description}[commitment_to_revenue_pct|（佔 Revenue 約 {commitment_to_revenue_pct}）]", "### 採購承諾", "one", where=("found", "true")),
    )
]
_BASE, _OTHER = ("mode", "q1_vs_10k"), ("mode", "!q1_vs_10k")
_JUDGED = tuple(f"$.rerate_signal.{k}.{x}" for k in ("structure_changing", "quality_changing", "narrative_changing") for x in ("result", "emerging"))
_LIGHT = "### [result|🟢][!result|[emerging|🟡][!emerging|🔴]] "


def filing_sections(filing_type: str = "10-K") -> list[Section]:
    """What a report says of a filing, over a result that holds all tasks' results; tables of numbers come apart from these."""
    lights = [("structure_changing", "營收結構在變"), ("quality_changing", "營收品質在變"), ("narrative_changing", "敘事在變")]
    lights = lights[1:] if filing_type == "10-Q" else lights
    judged = tuple(p for p in _JUDGED if any(k in p for k, _ in lights))
    pressure = Section("$.mdna.competitive_pressure_signals", '- [{severity:level}] **[summary_zh|{summary_zh!s}][!summary_zh|{quote!s}]** — {market}（vs 上季：{vs_prior_quarter:against}）[summary_zh|[quote|\n  > "{quote!s}"]]', "## 競爭壓力（即時訊號）", empty="> 本季 MD&A 無明顯競爭壓力新增揭露。", shown=_ANY)
    return [
        Section("$.financial.capital_allocation_order", "", "### 資本配置優先序", plain="{#}. {@!s}"),
        Section("$.financial.trend_summary", _TEXT, "### 趨勢摘要", "one"),
        Section("$.financial.quality_flags", "", "### 品質警示"),
        Section("$.financial.anomalies", "- **{year} {metric!s}**：{note!s}", "### 異常值"),
        Section("$.business.company_positioning", _TEXT, "## 公司定位", "one"),
        Section("$.competitor_mapping", "[named_competitors|## Competitor Landscape]", None, "one", where=_OTHER),
        Section("$.competitor_mapping", "[named_competitors|## Competitor Landscape（基準：{prior_year} 10-K）]", None, "one", where=_BASE),
        Section("$.competitor_mapping.named_competitors", "| {market!c} | {names!c} |", "| 市場 | 競爭對手 |\n|------|---------|", "markets"),
        Section("$.competitor_mapping", "[named_competitors|**市場定位**：{market_position:position}[market_position_evidence|\n> {market_position_evidence!s}]]", None, "one"),
        Section("$.competitor_mapping", "[named_competitors|**揭露品質**：{disclosure_quality:level}（{disclosure_rationale!s}）]", None, "one"),
        Section("$.competitor_mapping", "[baseline_note|*{baseline_note!s}*]", None, "one", where=_BASE, needs=("$.competitor_mapping.named_competitors",)),
        Section("$.business.growth_narrative", _TEXT, "## 成長敘事", "one"),
        Section("$.business.end_market_mix", "| {market!c} | {trend:market} |", "### 終端市場組合\n| 市場 | 趨勢 |\n|------|------|"),
        *_under("supply_chain", SUPPLY),
        Section("$.insight.bull_case", "- **{point!s}**[evidence|\n  - 論述：{evidence!s}]", "## 多頭論點（Bull Case）", shown=_ANY),
        Section("$.insight.bear_case", "- **{point!s}**[evidence|\n  - 論述：{evidence!s}]", "## 空頭論點（Bear Case）", shown=_ANY),
        *_under("risk", [
            Section("$.risks", "{importance:icon} **{title}**\n  {description!s}", "## 風險清單", by="importance", unless="$.insufficient_data"),
            Section("$.top_3", "{#}. **{title}**：{rationale!s}", "### 前三大風險", unless="$.insufficient_data", needs=("$.risks",)),
            Section("$.delta_summary", "_{@!s}_", None, "one", unless="$.insufficient_data", needs=("$.risks",)),
        ]),
        Section("$", "", "## 評價趨勢判斷", "one", shown=judged),
        *(Section(f"$.rerate_signal.{k}", f"{_LIGHT}{label}[rationale|\n{{rationale}}]", None, "one", needs=judged) for k, label in lights),
        Section("$.insight.key_monitorables", "", "## 關鍵追蹤指標（未來兩季）", shown=_ANY),
        Section("$.insight.information_edge", "- **{signal!s}**[source|\n  - 來源：{source!s}]", "## 10K 洞察（Information Edge）"),
        *([pressure] if filing_type == "10-Q" else []),
        Section("$.comparator", "| 管理層可信度 | {mgmt_credibility=N/A!c} |\n| 品質趨勢 | {quality_trend=N/A!c} |\n| 整體方向 | {overall_direction=N/A!c} |", "## 跨年度分析\n\n| 維度 | 評估 |\n|------|------|", "one", empty="| 管理層可信度 | N/A |\n| 品質趨勢 | N/A |\n| 整體方向 | N/A |", shown=_ANY),
        Section("$.comparator.mgmt_credibility_reason", "> {@!s}", None, "one"),
        Section("$.unusual_operations.summary", _TEXT, "## 不尋常操作", "one", shown=_ANY, needs=("$.unusual_operations.unusual_items",)),
        Section("$.unusual_operations.unusual_items", "### {name}\n- 分類：{classification:class}（{classification_rationale!s}）\n- 描述：{description!s}[source_quote|\n- 原文：*{source_quote}*]\n- 財務影響：{financial_impact!s}\n- 投資者解讀：**{investor_interpretation:investor}** — {investor_note!s}", None, empty="> 未發現不尋常操作，財務處理符合一般揭露規範。"),
        Section("$.comparator.cross_checks", "- **[{direction:tone}]**（{dimensions!l}）{finding!s}[implication|\n  - 影響：{implication!s}]", "## 交叉驗證"),
        Section("$.terms_glossary.terms", "| {term!c} | {category:term} | {explanation!sc} |", "## 附錄：關鍵術語\n| 術語 | 分類 | 說明 |\n|------|------|------|", where=("importance", "high")),
        Section("$.low_confidence", "以下任務因資料不足或品質未達門檻，結果僅供參考：{@!l}", "## 附錄：低信心任務", "one"),
    ]


DIVIDER = "---\n\n> **以下章節來自 {filing_type} 申報文件**（含 prior 期 10-K 對照）· 財務數字採用 GAAP 會計準則"
