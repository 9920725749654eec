"""Queries over rendered results, from results built of the documents' columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import layouts, renderers
from ..plans import report_layouts
from . import query
from .views import table

_SEVERITY = "CASE doc_id % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' ELSE 'other' END"
_AGAINST = "CASE doc_id % 3 WHEN 0 THEN 'easing' WHEN 1 THEN 'stable' ELSE 'unknown' END"
_SHOWN = "CASE doc_id % 4 WHEN 0 THEN '高' WHEN 1 THEN '中' WHEN 2 THEN '低' ELSE 'other' END"
_SHOWN_AGAINST = "CASE doc_id % 3 WHEN 0 THEN '緩解' WHEN 1 THEN '持平' ELSE '—' END"
_RESULT = f"""concat('{{"competitive_pressure_signals": [{{"severity": "', {_SEVERITY}, '", "summary_zh": "', CASE WHEN doc_id % 5 = 0 THEN '' ELSE source END, '", "quote": "', lang, '", "market": "m", "vs_prior_quarter": "', {_AGAINST}, '"}}], "supply_chain_risks": [{{"category": "price", "title": "', source, '", "summary": "', lang, '"}}, {{"category": "', lang, '", "title": "t", "summary": "CapEx"}}], "forward_guidance": {{"hard_guidance": [', CASE WHEN doc_id % 2 = 0 THEN concat('{{"metric": "', source, '|a", "value": "1"}}') ELSE '' END, '], "implied_signals": ["', lang, '"]}}, "market_concerns": [', CASE WHEN doc_id % 3 = 0 THEN concat('{{"topic": "', source, '", "frequency": ', CAST(doc_id % 2 AS STRING), ', "management_response": "', lang, '"}}') ELSE '' END, '], "purchase_commitments": {{"found": ', CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END, ', "total_commitment_description": "', source, '", "commitment_to_revenue_pct": "', CASE WHEN doc_id % 4 = 0 THEN '5%' ELSE '' END, '"}}}}')"""


def results(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").alias("entity"), F.expr(_RESULT).alias("result"))


@query(f"""SELECT doc_id AS entity, CAST(0 AS BIGINT) AS line_no, '- [' || {_SHOWN} || '] **' || CASE WHEN doc_id % 5 = 0 THEN lang ELSE source END || '** — m（vs 上季：' || {_SHOWN_AGAINST} || '）' || CASE WHEN doc_id % 5 = 0 THEN '' ELSE chr(10) || '  > "' || lang || '"' END AS text FROM documents""")
def competitive_pressure(spark: SparkSession, sf: str) -> DataFrame:
    return renderers.pressure(results(spark, sf))


@query("SELECT doc_id AS entity, CAST(0 AS BIGINT) AS line_no, '- [價格] ' || source || '：' || lang AS text FROM documents UNION ALL SELECT doc_id, 1, '- [' || lang || '] t：Capital Expenditure' FROM documents")
def supply_risks(spark: SparkSession, sf: str) -> DataFrame:
    return renderers.supply_risks(results(spark, sf))


@query("SELECT doc_id AS entity, source || CASE WHEN doc_id % 4 = 0 THEN '（佔 Revenue 約 5%）' ELSE '' END AS text FROM documents WHERE doc_id % 2 = 0")
def purchase_commitments(spark: SparkSession, sf: str) -> DataFrame:
    return renderers.commitments(results(spark, sf))


@query("SELECT doc_id AS entity, CAST(0 AS BIGINT) AS line_no, CASE WHEN doc_id % 3 = 0 THEN '### ' || source || CASE WHEN doc_id % 2 = 1 THEN '（被問 1 次）' ELSE '' END || chr(10) || chr(10) || '**管理層回應**：' || lang ELSE '（本季無市場關注議題記錄）' END AS text FROM documents")
def market_concerns(spark: SparkSession, sf: str) -> DataFrame:
    return renderers.concerns(results(spark, sf))


_HARD = "### 硬性指引（Hard Guidance）' || chr(10) || '| 指標 | 數值 | 期間 | 方向 | 原文 |' || chr(10) || '|------|------|------|------|------|"


@query(f"""SELECT doc_id AS entity, 0 AS section_no, CAST(0 AS BIGINT) AS line_no, '{_HARD}' AS text FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 0, 1, '| ' || source || '\\|a | 1 | — | — |  |' FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 0, 1, '（本季無硬性指引）' FROM documents WHERE doc_id % 2 = 1 UNION ALL SELECT doc_id, 3, 0, '### 隱含訊號' FROM documents UNION ALL SELECT doc_id, 3, 1, '- ' || lang FROM documents""")
def forward_guidance(spark: SparkSession, sf: str) -> DataFrame:
    return layouts.rendered(results(spark, sf), report_layouts.GUIDANCE)


@query("SELECT 'supply_chain' || '' AS task_id, k AS key, count(*) FILTER (k = 'supply_chain_risks') AS n_present, count(*) AS n FROM documents CROSS JOIN (SELECT unnest(['supply_chain_risks', 'overall_risk_level', 'trend', 'insufficient_data']) AS k) GROUP BY ALL")
def declared_keys(spark: SparkSession, sf: str) -> DataFrame:
    rows = renderers.declared(results(spark, sf).select(F.lit("supply_chain").alias("task_id"), "result"))
    return rows.groupBy("task_id", "key").agg(F.count("value").alias("n_present"), F.count(F.lit(1)).alias("n"))
