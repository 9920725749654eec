"""Queries over whole reports: every section's template with a full and a sparse result, against the lines that they must give."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import layouts, report
from ..plans import report_layouts
from . import query
from .views import table

#: «S» and «L» stand for a document's source and language.
TRANSCRIPT = {
    "structured_summary": {
        "headline": "大幅 «S»", "financial_highlights": [{"metric": "Rev|«S»", "reported": "1"}, {"metric": "EPS", "consensus": "2", "driver": "CapEx"}],
        "segment_performance": [{"segment": "«L»", "direction": "up", "detail": "暴增"}], "operational_highlights": ["«S»"], "challenges": ["危機 «L»"], "capital_allocation": {"buyback": "2B"},
    },
    "sentiment": {
        "overall_tone": "«L»", "confidence_level": 0.75, "evasive_topics": ["a", {"topic": "t", "signal": "«S»"}, {"topic": "u"}],
        "language_shifts": [{"topic": "t", "previous": "p", "current": "c", "interpretation": "i"}, {"topic": "t2", "interpretation": "i2"}, {"topic": "t3", "current": "c"}],
    },
    "partnerships_and_strategy": {
        "new_partnerships": [{"partner": "«S»", "nature": "n", "revenue_impact": "CapEx", "detail": "d"}, {"partner": "q", "detail": "e"}], "existing_updates": [{"partner": "p", "status": "s", "detail": "d"}],
        "strategic_shifts": [{"area": "a", "description": "b", "implications": "c"}], "competitive_dynamics": ["«L»"], "supply_chain": ["x"],
    },
}
TRANSCRIPT_LINES = [
    (0, 1, "###  «S»"), (1, 0, "#### 財務亮點\n| 指標 | 實際 | 預期 | 結果 | YoY | 驅動因子 |\n|------|------|------|------|------|----------|"), (1, 1, "| Rev\\|«S» | 1 | — |  |  |  |"), (1, 2, "| EPS | — | 2 |  |  | Capital Expenditure |"),
    (2, 0, "#### 業務部門表現\n| 部門 | 方向 | 描述 |\n|------|------|------|"), (2, 1, "| «L» | up | 快速增加 |"), (3, 0, "#### 營運亮點"), (3, 1, "- «S»"), (4, 0, "#### 挑戰"), (4, 1, "- 需留意 «L»"), (5, 0, "#### 資本配置"), (5, 1, "- **buyback**：2B"),
    (6, 0, "### 管理層語氣分析"), (7, 1, "**整體語氣**：«L»"), (8, 1, "**信心程度**：75%"), (11, 0, "**迴避主題**："), (11, 1, "- a"), (11, 2, "- **t**：«S»"), (11, 3, "- u"),
    (12, 0, "**語言轉變**："), (12, 1, "- **t**：`p` → `c`（i）"), (12, 2, "- **t2**：i2"), (12, 3, "- **t3**：`` → `c`"), (13, 0, "### 夥伴關係與策略"), (14, 0, "**新夥伴關係**："), (14, 1, "- **«S»**（n / Capital Expenditure）：d"), (14, 2, "- **q**：e"),
    (15, 0, "**既有夥伴更新**："), (15, 1, "- **p**（s）：d"), (16, 0, "**策略轉變**："), (16, 1, "- **a**：b（c）"), (17, 0, "**競爭動態**："), (17, 1, "- «L»"), (18, 0, "**供應鏈**："), (18, 1, "- x"),
]
SUPPLY = {
    "overall_risk_level": "high", "trend": "stable", "raw_materials": [{"material": "«S»", "usage": "u|v", "source_concentration": "medium", "geographic_risk": "«L»"}, {"material": "m", "source_concentration": "odd"}],
    "supply_chain_risks": [{"category": "price", "title": "t", "summary": "暴跌"}], "yoy_changes": {"improvements": ["«S»"], "deteriorations": []}, "mdna_impact": {"impact_description": "«L»", "mgmt_outlook": "neutral"},
    "purchase_commitments": {"found": True, "total_commitment_description": "x", "commitment_to_revenue_pct": "5%"},
}
_RAW = "### 原物料\n| 原物料 | 用途 | 集中風險 | 地緣風險 |\n|--------|------|----------|----------|"
SUPPLY_LINES = [
    (0, 0, "## 供應鏈分析"), (0, 1, "**整體風險：高　趨勢：持平**"), (1, 0, _RAW), (1, 1, "| «S» | u\\|v | 中 | «L» |"), (1, 2, "| m |  | odd |  |"), (2, 0, "### 主要風險"), (2, 1, "- [價格] t：快速下降"),
    (3, 0, "### 跨期變化\n**正向變化**"), (3, 1, "- «S»"), (4, 0, "**負向變化**"), (4, 1, "- —"), (5, 0, "### MD&A 實際影響"), (5, 1, "«L»（管理層展望：中性）"), (6, 0, "### 採購承諾"), (6, 1, "x（佔 Revenue 約 5%）"),
]
SPARSE_SUPPLY = {"overall_risk_level": "low", "trend": "x", "purchase_commitments": {"found": False}}
SPARSE_SUPPLY_LINES = [(0, 0, "## 供應鏈分析"), (0, 1, "**整體風險：低　趨勢：x**")]
FILING = {
    "financial": {"capital_allocation_order": ["a", "b"], "trend_summary": "«S»", "quality_flags": ["警訊"], "anomalies": [{"year": 2020, "metric": "CapEx", "note": "n"}]},
    "business": {"company_positioning": "«L»", "growth_narrative": "g", "end_market_mix": [{"market": "m", "trend": "growing"}]},
    "competitor_mapping": {"mode": "normal", "named_competitors": [{"name": "A", "markets": ["x", "y"]}, {"name": "B", "markets": ["y"]}], "market_position": "leader", "market_position_evidence": "e", "disclosure_quality": "low", "disclosure_rationale": "r"},
    "supply_chain": SUPPLY, "insight": {"bull_case": [{"point": "p", "evidence": "«S»"}], "bear_case": [{"point": "q"}], "key_monitorables": ["k"], "information_edge": ["i", {"signal": "s", "source": "o"}]},
    "risk": {"risks": [{"title": "l", "importance": "low", "description": "1"}, {"title": "h", "importance": "high", "description": "2"}, {"title": "?", "description": "3"}], "top_3": [{"title": "h", "rationale": "«L»"}], "delta_summary": "d"},
    "rerate_signal": {"structure_changing": {"result": True, "rationale": "r"}, "quality_changing": {"result": False}, "narrative_changing": {"result": False, "emerging": True}},
    "comparator": {"mgmt_credibility": "high", "mgmt_credibility_reason": "w", "cross_checks": [{"dimensions": ["a", "b"], "direction": "negative", "finding": "f", "implication": "z"}]},
    "unusual_operations": {"summary": "s", "unusual_items": [{"name": "n", "classification": "hybrid", "classification_rationale": "c", "description": "d", "source_quote": "«S»", "financial_impact": "i", "investor_interpretation": "odd", "investor_note": "v"}]},
    "terms_glossary": {"terms": [{"term": "T", "category": "industry", "importance": "high", "explanation": "x"}, {"term": "U", "importance": "low"}]}, "low_confidence": ["risk", "mdna"],
}
_CROSS = "## 跨年度分析\n\n| 維度 | 評估 |\n|------|------|"
FILING_LINES = [
    (0, 0, "### 資本配置優先序"), (0, 1, "1. a"), (0, 2, "2. b"), (1, 0, "### 趨勢摘要"), (1, 1, "«S»"), (2, 0, "### 品質警示"), (2, 1, "- 需留意"), (3, 0, "### 異常值"), (3, 1, "- **2020 Capital Expenditure**：n"),
    (4, 0, "## 公司定位"), (4, 1, "«L»"), (5, 1, "## Competitor Landscape"), (7, 0, "| 市場 | 競爭對手 |\n|------|---------|"), (7, 1, "| x | A |"), (7, 2, "| y | A、B |"), (8, 1, "**市場定位**：領先\n> e"), (9, 1, "**揭露品質**：低（r）"),
    (11, 0, "## 成長敘事"), (11, 1, "g"), (12, 0, "### 終端市場組合\n| 市場 | 趨勢 |\n|------|------|"), (12, 1, "| m | 成長 |"), *((13 + s, n, t) for s, n, t in SUPPLY_LINES),
    (20, 0, "## 多頭論點（Bull Case）"), (20, 1, "- **p**\n  - 論述：«S»"), (21, 0, "## 空頭論點（Bear Case）"), (21, 1, "- **q**"),
    (22, 0, "## 風險清單"), (22, 1, "● **h**\n  2"), (22, 2, "· **l**\n  1"), (22, 3, "· **?**\n  3"), (23, 0, "### 前三大風險"), (23, 1, "1. **h**：«L»"), (24, 1, "_d_"),
    (25, 0, "## 評價趨勢判斷"), (26, 1, "### 🟢 營收結構在變\nr"), (27, 1, "### 🔴 營收品質在變"), (28, 1, "### 🟡 敘事在變"), (29, 0, "## 關鍵追蹤指標（未來兩季）"), (29, 1, "- k"),
    (30, 0, "## 10K 洞察（Information Edge）"), (30, 1, "- i"), (30, 2, "- **s**\n  - 來源：o"), (31, 0, _CROSS), (31, 1, "| 管理層可信度 | high |\n| 品質趨勢 | N/A |\n| 整體方向 | N/A |"), (32, 1, "> w"),
    (33, 0, "## 不尋常操作"), (33, 1, "s"), (34, 1, "### n\n- 分類：混合型（c）\n- 描述：d\n- 原文：*«S»*\n- 財務影響：i\n- 投資者解讀：**** — v"), (35, 0, "## 交叉驗證"), (35, 1, "- **[負面]**（a, b）f\n  - 影響：z"),
    (36, 0, "## 附錄：關鍵術語\n| 術語 | 分類 | 說明 |\n|------|------|------|"), (36, 1, "| T | 行業 | x |"), (37, 0, "## 附錄：低信心任務"), (37, 1, "以下任務因資料不足或品質未達門檻，結果僅供參考：risk, mdna"),
]
SPARSE = {"risk": {"risks": [{"title": "x"}], "insufficient_data": True}, "rerate_signal": {"quality_changing": {"result": False}}, "supply_chain": {"trend": "stable", "insufficient_data": True}, "financial": {"quality_flags": []}}
SPARSE_LINES = [
    (20, 0, "## 多頭論點（Bull Case）"), (21, 0, "## 空頭論點（Bear Case）"), (29, 0, "## 關鍵追蹤指標（未來兩季）"), (31, 0, _CROSS), (31, 1, "| 管理層可信度 | N/A |\n| 品質趨勢 | N/A |\n| 整體方向 | N/A |"),
    (33, 0, "## 不尋常操作"), (34, 1, "> 未發現不尋常操作，財務處理符合一般揭露規範。"),
]


def _results(spark: SparkSession, sf: str, even: dict, odd: dict) -> DataFrame:
    put = lambda x: F.replace(F.replace(F.lit(json.dumps(x, ensure_ascii=False)), F.lit("«S»"), F.col("source")), F.lit("«L»"), F.col("lang"))
    return table(spark, sf, "documents").select(F.col("doc_id").alias("entity"), F.when(F.col("doc_id") % 2 == 0, put(even)).otherwise(put(odd)).alias("result"))


def _expected(even: list[tuple], odd: list[tuple]) -> str:
    q = lambda t: "'" + t.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    rows = ", ".join(f"({p}, {s}, {n}, {q(t)})" for p, lines in ((0, even), (1, odd)) for s, n, t in lines)
    return f"WITH t(parity, section_no, line_no, text) AS (VALUES {rows}) SELECT doc_id AS entity, CAST(section_no AS INT) AS section_no, CAST(line_no AS BIGINT) AS line_no, replace(replace(t.text, '«S»', source), '«L»', lang) AS text FROM documents JOIN t ON parity = doc_id % 2"


@query(_expected(TRANSCRIPT_LINES, []))
def transcript_highlights(spark: SparkSession, sf: str) -> DataFrame:
    return layouts.rendered(_results(spark, sf, TRANSCRIPT, {}), report_layouts.HIGHLIGHTS)


@query(_expected(SUPPLY_LINES, SPARSE_SUPPLY_LINES))
def supply_sections(spark: SparkSession, sf: str) -> DataFrame:
    return layouts.rendered(_results(spark, sf, SUPPLY, SPARSE_SUPPLY), report_layouts.SUPPLY)


@query(_expected(FILING_LINES, SPARSE_LINES))
def filing_report(spark: SparkSession, sf: str) -> DataFrame:
    """All sections of a report that come from a filing's results, with what is there and what is left out."""
    return layouts.rendered(_results(spark, sf, FILING, SPARSE), report_layouts.filing_sections())


_NONE = report_layouts.UNAVAILABLE
_HEADS = [(100 * k, 0, "## " + x) for k, x in enumerate(report_layouts.TRANSCRIPT_SECTIONS)]


@query(_expected([*_HEADS, (1, 1, "（本季無硬性指引）"), (101, 0, "（本季無市場關注議題記錄）"), *((201 + s, n, t) for s, n, t in TRANSCRIPT_LINES)], [(100 * k, 0, _NONE.format(section=x)) for k, x in enumerate(report_layouts.TRANSCRIPT_SECTIONS)]))
def transcript_sections(spark: SparkSession, sf: str) -> DataFrame:
    """The three transcript sections, and what stands there for documents without a transcript."""
    rows = _results(spark, sf, TRANSCRIPT, {})
    return report.transcript_lines(rows.withColumn("result", F.when(F.col("entity") % 2 == 0, F.col("result"))))
