"""Relations like those of filings, derived from the driver's tables with one formula for Spark and for DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_METRIC = "CASE c_mktsegment WHEN 'BUILDING' THEN 'Revenue' WHEN 'MACHINERY' THEN 'NetIncome' WHEN 'FURNITURE' THEN 'OperatingIncome' WHEN 'HOUSEHOLD' THEN 'OperatingCashFlow' ELSE CASE c_custkey % 4 WHEN 2 THEN 'LongTermDebt' WHEN 3 THEN 'SharesOutstanding' ELSE 'CapEx' END END"
_FACT = """CAST({entity} AS BIGINT) AS entity, {metric} AS metric, CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 AS concept_pos, o_orderkey AS entry_pos,
 {form} AS form, {fp} AS fp, CAST(o_orderdate AS DATE) AS end_date,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) - CAST(CASE WHEN o_orderkey % 7 = 0 THEN 364 WHEN o_orderkey % 13 = 0 THEN 182 ELSE 90 END AS INT) END AS start_date,
 CAST(extract(YEAR FROM o_orderdate) AS INT) + CAST(o_orderkey % 2 AS INT) AS fy,
 CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INT) AS STRING) AS filed, o_totalprice AS val"""
_ORDERS = "FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey"


def _facts(**parts: str) -> str:
    out = _FACT
    for k, v in {"metric": _METRIC, **parts}.items():
        out = out.replace("{" + k + "}", v)
    return out


_HEADS = ["Item 1. Business", "Item 1A. Risk Factors", "Item 1C. Cybersecurity", "Item 7. Management discussion", "Item 7A. Market risk", "Item 8. Financial Statements", "Item 9A. Controls", "Item 10. Directors", "Item 11. Executive pay", "Item 13. Certain deals"]
_HEAD = "CASE doc_id % 10 " + " ".join(f"WHEN {i} THEN '{h}'" for i, h in enumerate(_HEADS)) + " END"
_TOC_TITLE = "CASE doc_id % 10 WHEN 0 THEN 'Business' WHEN 1 THEN 'Risk Factors' WHEN 2 THEN 'Cybersecurity' WHEN 3 THEN 'Unlisted matter' WHEN 4 THEN 'Market risk' WHEN 5 THEN 'Financial Statements and Supplementary Data' WHEN 6 THEN 'Controls and Procedures' WHEN 7 THEN 'Directors' WHEN 8 THEN 'Executive Compensation' ELSE 'Certain Relationships' END"

#: In both dialects; {table} is a table of the driver, and JOINED(x, k) is x in order of k with line breaks between.
VIEWS = {
    "facts_v": "SELECT " + _facts(entity="n_regionkey", form="CASE WHEN o_orderkey % 11 = 0 THEN '10-Q/A' WHEN o_orderkey % 7 = 0 THEN '10-K' ELSE '10-Q' END", fp="CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 7 = 0 THEN 'FY' ELSE 'Q1' END") + f" {_ORDERS}",
    "annual_v": "SELECT " + _facts(entity="c_nationkey", form="CASE o_orderstatus WHEN 'F' THEN '10-K' WHEN 'O' THEN '10-K/A' ELSE '8-K' END", fp="CASE WHEN o_orderkey % 9 = 0 THEN 'Q4' ELSE 'FY' END") + f" {_ORDERS}",
    "units_v": "SELECT entity, concept, CASE WHEN entity % 2 = 1 AND concept = 'SalesRevenueNet' THEN 'shares' WHEN entry_pos % 4 = 0 THEN 'shares' ELSE 'USD' END AS unit, entry_pos, val FROM (SELECT CAST(n_regionkey AS BIGINT) AS entity, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Revenues' WHEN '2' THEN 'SalesRevenueNet' WHEN '3' THEN 'NetIncomeLoss' WHEN '4' THEN 'CommonStockSharesOutstanding' ELSE 'Unlisted' END AS concept, o_orderkey AS entry_pos, o_totalprice AS val " + _ORDERS + ")",
    "filings_v": "SELECT CAST(floor(doc_id / 10) AS BIGINT) AS doc_id, JOINED(concat(CASE WHEN floor(doc_id / 10) % 3 = 1 THEN upper(CASE WHEN doc_id % 10 = 0 THEN 'Item 1. Business' ELSE " + _HEAD + " END) ELSE concat('## ', " + _HEAD + ") END, chr(10), coalesce(text, '')), doc_id) AS text FROM {documents} GROUP BY floor(doc_id / 10)",
    "toc_v": "SELECT CAST(floor(doc_id / 10) AS BIGINT) AS doc_id, concat(JOINED(concat(CASE WHEN doc_id % 10 IN (2, 4) THEN '|  | ' ELSE '| Item 1 | ' END, CASE WHEN doc_id % 3 = 0 THEN " + _TOC_TITLE + " ELSE concat('[', " + _TOC_TITLE + ", '](#a_', CAST(doc_id AS STRING), ')') END, ' |'), doc_id), chr(10), repeat(concat('filler', chr(10)), 12), JOINED(concat('[anchor:a_', CAST(doc_id AS STRING), ']', chr(10), CASE WHEN doc_id % 2 = 0 THEN " + _HEAD + " ELSE " + _TOC_TITLE + " END, chr(10), coalesce(text, '')), doc_id)) AS text FROM {documents} GROUP BY floor(doc_id / 10)",
    "notes_v": "SELECT CAST(floor(doc_id / 26) AS BIGINT) AS doc_id, concat('Balance', chr(10), CASE WHEN floor(doc_id / 26) % 5 = 4 THEN 'Nothing else is said here' ELSE 'Notes to Consolidated Financial Statements' END, chr(10), JOINED(concat(CASE WHEN doc_id % 26 < 22 THEN concat(chr(CAST(65 + doc_id % 26 AS INT)), '. ') ELSE '' END, coalesce(text, '')), doc_id)) AS text FROM {documents} GROUP BY floor(doc_id / 26)",
    "transcripts_v": "SELECT conv_id AS doc_id, JOINED(concat(CASE WHEN turn = 2 THEN concat('Questions and Answers Session', chr(10)) ELSE '' END, CASE WHEN role = 'system' THEN '' WHEN role = 'user' THEN CASE WHEN turn % 4 = 2 THEN 'Seymore: ' ELSE 'Ross Seymore: ' END ELSE CASE WHEN turn % 4 = 1 THEN 'Patrick: ' ELSE 'Random Stranger: ' END END, CASE WHEN turn % 7 = 6 THEN '' ELSE replace(coalesce(text, ''), ':', '') END), turn) AS text FROM {conversations} GROUP BY conv_id",
    "people_v": "SELECT DISTINCT conv_id AS doc_id, CAST(p AS INT) AS pos, CASE p WHEN 0 THEN 'Patrick Gelsinger' WHEN 1 THEN 'Ross Seymore' ELSE CASE WHEN conv_id % 3 = 0 THEN 'Ross Smith' ELSE 'David Zinsner' END END AS name, CASE p WHEN 0 THEN 'CEO' WHEN 1 THEN 'Analyst' ELSE NULL END AS role, CASE p WHEN 1 THEN 'Bank' ELSE 'Maker' END AS affiliation FROM {conversations} CROSS JOIN (SELECT 0 AS p UNION ALL SELECT 1 UNION ALL SELECT 2)",
    "usage_v": "SELECT event_id, ts, event_type AS label, CAST(json_text(props, '$.k') AS BIGINT) AS n_in, CAST(floor(value) AS BIGINT) AS n_out FROM {events}",
    "state_v": "SELECT CAST(user_id AS STRING) AS step_key, event_id, ts, CASE event_type WHEN 'purchase' THEN 'done' WHEN 'click' THEN 'done' WHEN 'error' THEN 'running' ELSE 'pending' END AS status FROM {events}",
    "eval_v": "SELECT CAST(d.doc_id AS STRING) AS task_id, CAST((CASE WHEN quality IS NULL THEN 1 ELSE 0 END) + (CASE WHEN toxic IS NULL THEN 1 ELSE 0 END) AS INT) AS n_missing, CAST((CASE WHEN quality IS NULL THEN 1 ELSE 0 END) + (CASE WHEN toxic IS NULL OR toxic = 0 THEN 1 ELSE 0 END) + (CASE WHEN lang <> 'en' THEN 1 ELSE 0 END) AS INT) AS n_empty, CAST(n_chars % 101 AS INT) AS llm_subtotal, (d.doc_id % 17 = 0) AS hard FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id",
}
_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _joined(sql: str, form: str) -> str:
    """JOINED(x, k) written out; x may hold commas and brackets, k is a plain name."""
    while (a := sql.find("JOINED(")) >= 0:
        depth, i = 0, a + 6
        while True:
            depth += (sql[i] == "(") - (sql[i] == ")")
            if not depth:
                break
            i += 1
        x, k = sql[a + 7 : i].rsplit(",", 1)
        sql = sql[:a] + form.format(x=x.strip(), k=k.strip()) + sql[i + 1 :]
    return sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = _joined(VIEWS[name], "listagg({x}, chr(10)) WITHIN GROUP (ORDER BY {k})").replace("json_text(", "get_json_object(")
    used = [t for t in _TABLES if "{" + t + "}" in sql]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in used})


def duck(*names: str, then: str) -> str:
    """DuckDB SQL with these views before it."""
    parts = []
    for n in names:
        sql = _joined(VIEWS[n], "string_agg({x}, chr(10) ORDER BY {k})").replace("json_text(", "json_extract_string(")
        parts.append(f"{n} AS ({re.sub(r'{(\w+)}', r'\1', sql)})")
    body = then.strip()
    return "WITH " + ", ".join(parts) + (", " + body[5:] if body.upper().startswith("WITH ") else " " + body)
