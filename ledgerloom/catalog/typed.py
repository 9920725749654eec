"""Queries over typed results, rules on them, assembled inputs and what goes into later tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rules, sections, typed
from ..plans import dims
from . import query
from .text import _HITS, _SLICE
from .views import duck, table, view

#: Per task: its result by a document's columns, the same expression in both dialects, and the typed fields that are compared.
_N = "CAST(doc_id % 7 AS STRING)"
_NOTES = {
    "fn_revenue": ("""concat('{"revenue_recognition": {"policy": "', source, '", "timing": "', CASE doc_id % 3 WHEN 0 THEN 'over-time' ELSE 'never' END, '", "changed": ', CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END, '}, "new_standards": [{"standard": "', lang, '"}]}')""", {"policy": "revenue_recognition.policy", "changed": "revenue_recognition.changed", "standard": "new_standards[0].standard"}, "source AS policy, doc_id % 2 = 0 AS changed, lang AS standard"),
    "fn_segment": (f"""concat('{{"segments": [{{"name": "', source, '", "revenue": "', {_N}, '"}}, {{"name": "x"}}], "segment_redefined": ', CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'null' END, '}}')""", {"name": "segments[0].name", "revenue": "segments[0].revenue", "n": "size(segments)", "redefined": "segment_redefined"}, f"source AS name, {_N} AS revenue, 2 AS n, CASE WHEN doc_id % 2 = 0 THEN true END AS redefined"),
    "fn_receivables": (f"""concat('{{"securitization": {{"drawn_amount": "', {_N}, '"}}, "debt_structure": [', CASE WHEN doc_id % 2 = 0 THEN concat('{{"type": "', lang, '", "maturity": "2030"}}') ELSE '' END, '], "covenants": "', source, '"}}')""", {"drawn": "securitization.drawn_amount", "debts": "size(debt_structure)", "debt": "try_element_at(debt_structure, 1).type", "covenants": "covenants"}, f"{_N} AS drawn, CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END AS debts, CASE WHEN doc_id % 2 = 0 THEN lang END AS debt, source AS covenants"),
    "fn_assets": (f"""concat('{{"goodwill": {{"total": "', {_N}, '", "by_unit": [{{"unit": "', source, '", "amount": "1"}}, {{"unit": "', lang, '"}}]}}, "inventory": {{"method": "LIFO"}}}}')""", {"goodwill": "goodwill.total", "units": "array_join(goodwill.by_unit.unit, ',')", "method": "inventory.method"}, f"{_N} AS goodwill, source || ',' || lang AS units, 'LIFO' AS method"),
    "fn_risk": ("""concat('{"contingencies": [{"description": "', source, '", "likelihood": "', CASE doc_id % 4 WHEN 0 THEN 'probable' WHEN 1 THEN 'remote' WHEN 2 THEN 'likely' ELSE 'reasonably_possible' END, '"}], "leases": {"operating_total": "', lang, '"}}')""", {"likelihood": None, "leases": "leases.operating_total"}, "CASE doc_id % 4 WHEN 0 THEN 'probable' WHEN 1 THEN 'remote' WHEN 3 THEN 'reasonably_possible' END AS likelihood, lang AS leases"),
    "fn_pension": (f"""concat('{{"funded_status": {{"pbo": "', {_N}, '", "deficit": "', lang, '"}}, "assumptions": {{"discount_rate": "5%"}}}}')""", {"pbo": "funded_status.pbo", "deficit": "funded_status.deficit", "rate": "assumptions.discount_rate"}, f"{_N} AS pbo, lang AS deficit, '5%' AS rate"),
    "fn_compensation": (f"""concat('{{"sbc": {{"expense": "', {_N}, '", "to_revenue_pct": "12"}}, "eps": {{"basic": "', lang, '"}}, "aoci_components": []}}')""", {"expense": "sbc.expense", "sbc_pct": "sbc.to_revenue_pct", "eps": "eps.basic", "n_aoci": "size(aoci_components)"}, f"{_N} AS expense, '12' AS sbc_pct, lang AS eps, 0 AS n_aoci"),
    "fn_tax": (f"""concat('{{"effective_rate": "', {_N}, '%", "deferred_tax": {{"assets": "', source, '"}}, "tax_credits": ["', lang, '"]}}')""", {"rate": "effective_rate", "assets": "deferred_tax.assets", "credit": "tax_credits[0]", "disputes": "tax_disputes"}, f"{_N} || '%' AS rate, source AS assets, lang AS credit, NULL AS disputes"),
}


def _note(task: str):
    expr, fields, _ = _NOTES[task]

    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = table(spark, sf, "documents").select(F.col("doc_id").alias("entity"), F.lit(task).alias("task_id"), F.expr(expr).alias("result"))
        own = {k: F.expr(x) if x else typed.of_enum(F.expr("contingencies[0].likelihood"), "likelihood") for k, x in fields.items()}
        return typed.typed(rows, task).select("entity", *[v.cast("string").alias(k) if k == "disputes" else v.alias(k) for k, v in own.items()])

    run.__name__ = f"typed_{task}"
    return run


for _task, (_, _, _sql) in _NOTES.items():
    query(f"SELECT doc_id AS entity, {_sql} FROM documents")(_note(_task))


@query("SELECT doc_id AS entity, source AS name, CAST(doc_id % 11 AS DOUBLE) + 0.5 AS pct FROM documents WHERE doc_id % 11 + 0.5 > 5")
def governance_holders(spark: SparkSession, sf: str) -> DataFrame:
    text = """concat('{"audit_opinion": "qualified", "major_shareholders": [{"name": "', source, '", "pct": "', CAST(doc_id % 11 AS STRING), '.5%"}, {"name": "small", "pct": "5%"}, {"name": "none", "pct": "n/a"}]}')"""
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("entity"), F.lit("governance").alias("task_id"), F.expr(text).alias("result"))
    return typed.large_holders(typed.typed(rows, "governance"))


_MONTHLY = "SELECT c_nationkey AS entity, CAST(year(o_orderdate) AS INT) AS year, CAST(count(*) FILTER (o_orderstatus = 'O') AS DOUBLE) AS capex, CAST(count(*) AS DOUBLE) AS revenue, CAST(count(*) FILTER (o_orderpriority = '1-URGENT') AS DOUBLE) AS margin FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"


@query(f"WITH m AS ({_MONTHLY}), j AS (SELECT m.entity, m.year, CASE WHEN coalesce(a.revenue > m.revenue AND a.margin > m.margin, false) OR coalesce(b.revenue > m.revenue AND b.margin > m.margin, false) THEN 'bullish' WHEN coalesce(abs((a.revenue - m.revenue) / m.revenue * 100) <= 10 AND a.margin < m.margin, false) THEN 'bearish' ELSE 'neutral' END AS signal, m.capex > p.capex AS grown FROM m LEFT JOIN m p ON p.entity = m.entity AND p.year = m.year - 1 LEFT JOIN m a ON a.entity = m.entity AND a.year = m.year + 1 LEFT JOIN m b ON b.entity = m.entity AND b.year = m.year + 2) SELECT entity, year, signal FROM j WHERE grown")
def capex_effect(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    n = lambda c: F.count_if(c).cast("double")
    m = o.groupBy(F.col("c_nationkey").alias("entity"), F.year("o_orderdate").alias("year")).agg(n(F.col("o_orderstatus") == "O").alias("capex"), F.count(F.lit(1)).cast("double").alias("revenue"), n(F.col("o_orderpriority") == "1-URGENT").alias("margin"))
    return rules.capex_effect(m, flat=10.0)


_SHARES = "SELECT CAST(c_nationkey AS BIGINT) AS entity, o_orderpriority AS segment, CAST(year(o_orderdate) AS INT) AS year, CAST(count(*) AS DOUBLE) AS share FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"


@query(f"WITH s AS ({_SHARES}), l AS (SELECT entity, max(year) AS y FROM s GROUP BY entity) SELECT l.entity, bool_or(coalesce(s.year = l.y AND s.segment IN ('1-URGENT', '2-HIGH') AND s.share > p.share AND s.share - p.share > 5, false)) AS result FROM l JOIN s ON s.entity = l.entity LEFT JOIN s p ON p.entity = s.entity AND p.segment = s.segment AND p.year = s.year - 2 GROUP BY l.entity")
def structure_changing(spark: SparkSession, sf: str) -> DataFrame:
    """Segments of high quality are the urgent and high orders; all of them rise as far as their share says."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    s = o.groupBy(F.col("c_nationkey").cast("long").alias("entity"), F.col("o_orderpriority").alias("segment"), F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).cast("double").alias("share"))
    s = s.withColumn("margin_quality", F.when(F.col("segment").isin("1-URGENT", "2-HIGH"), "high").otherwise("low")).withColumn("direction", F.lit("rising"))
    return rules.structure_changing(s)


@query("SELECT o_orderkey, o_orderkey % 2 = 0 AS structure, o_orderkey % 3 = 0 AS quality, coalesce(o_orderkey % 5 = 0, false) AS narrative, o_orderkey % 7 = 0 AS emerging, o_orderkey % 11 = 0 OR o_orderstatus = 'P' AS insufficient FROM orders")
def rerate_assembly(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    r = rules.rerate_assembly(F.when(k % 2 == 0, True), k % 3 == 0, k % 5 == 0, k % 7 == 0, k % 11 == 0, F.when(F.col("o_orderstatus") == "P", True))
    o = table(spark, sf, "orders").select("o_orderkey", r.alias("r"))
    return o.select("o_orderkey", F.col("r.structure_changing.result").alias("structure"), F.col("r.quality_changing.result").alias("quality"), F.col("r.narrative_changing.result").alias("narrative"), F.col("r.narrative_changing.emerging").alias("emerging"), F.col("r.insufficient_data").alias("insufficient"))


_UNUSUAL = """concat('{"notes": {"red_flags": ["', source, '", "b"], "off_balance_sheet": {"amount": "', CASE WHEN doc_id % 2 = 0 THEN '5' ELSE '' END, '"}, "related_party": {"amount": "', lang, '"}, "revenue_recognition": {"changed": ', CASE WHEN doc_id % 3 = 0 THEN 'true' ELSE 'false' END, '}}, "financial": {"quality_flags": [', CASE WHEN doc_id % 5 = 0 THEN '"q"' ELSE '' END, ']}}')"""


@query("SELECT doc_id AS entity, 'red_flag' AS kind, source AS item FROM documents UNION ALL SELECT doc_id, 'red_flag', 'b' FROM documents UNION ALL SELECT doc_id, 'off_balance_sheet', '5' FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 'related_party', lang FROM documents UNION ALL SELECT doc_id, 'revenue_recognition', 'changed' FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, 'quality_flag', 'q' FROM documents WHERE doc_id % 5 = 0")
def unusual_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return rules.unusual_candidates(table(spark, sf, "documents").select(F.col("doc_id").alias("entity"), F.expr(_UNUSUAL).alias("result")))


@query("SELECT doc_id AS entity, t AS title, contains(lower(coalesce(text, '')), lower(t)) AS mdna_realized FROM documents CROSS JOIN (SELECT unnest(['The', 'tion', 'Zirconium']) AS t)")
def mdna_realized(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("entity"), "text")
    return rules.mdna_realized(d.select("entity", F.explode(F.array(*map(F.lit, ("The", "tion", "Zirconium")))).alias("title")), d)


@query("SELECT doc_id AS entity, CASE WHEN doc_id % 3 = 0 THEN '{\"structural_shift\": true, \"shift_description\": \"' || source || '\", \"rerating_candidate_structure\": null}' ELSE '{\"a\": 1, \"b\": \"' || lang || '\"}' END AS result FROM documents")
def slim_results(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    long = F.concat(F.lit('{"segment_table": [1, 2], "shift_description": "'), "source", F.lit('", "structural_shift": true}'))
    rows = d.select(F.col("doc_id").alias("entity"), F.when(F.col("doc_id") % 3 == 0, "segment_trend").otherwise("mdna").alias("task_id"), F.when(F.col("doc_id") % 3 == 0, long).otherwise(F.concat(F.lit('{"a": 1, "b": "'), "lang", F.lit('"}'))).alias("result"))
    return typed.slim(rows).select("entity", "result")


@query("SELECT doc_id AS entity, CASE doc_id % 4 WHEN 0 THEN 'fn_combined=' WHEN 1 THEN '' ELSE 'fn_risk=,fn_tax=' END AS notes FROM documents")
def note_summary(spark: SparkSession, sf: str) -> DataFrame:
    """fn_combined alone where it is valid, nothing where it is an error, else all notes in order of name."""
    d = table(spark, sf, "documents")
    first = F.when(F.col("doc_id") % 4 == 0, "{}").when(F.col("doc_id") % 4 == 1, '{"error": "x"}')
    rows = d.select(F.col("doc_id").alias("entity"), F.explode(F.map_from_arrays(F.array(F.lit("fn_tax"), F.lit("fn_risk"), F.lit("fn_combined"), F.lit("risk")), F.array(F.lit("{}"), F.lit("{}"), first, F.lit("{}")))).alias("task_id", "result"))
    notes = typed.note_summary(rows)
    return notes.select("entity", F.array_join(F.transform(F.map_keys("notes"), lambda k: F.concat(k, F.lit("="))), ",").alias("notes"))


@query("SELECT doc_id, '{\"lang\":\"' || lang || '\",\"n\":' || CAST(doc_id % 7 AS VARCHAR) || CASE WHEN doc_id % 2 = 0 THEN ',\"source\":\"' || source || '\"' ELSE '' END || '}' AS inputs FROM documents")
def inputs_json(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "lang", (F.col("doc_id") % 7).alias("n"), F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("source"), F.lit("x").alias("raw_text"))
    return typed.without_raw(d).select("doc_id", typed.inputs_json("lang", "n", "source").alias("inputs"))


_NAMES = ", ".join(f"('{k}', '{v}')" for k, v in dims.INPUT_NAMES.items())


@query(f"SELECT k AS input_key, v AS name FROM (VALUES {_NAMES}, ('other', 'other')) t(k, v)")
def input_names(spark: SparkSession, sf: str) -> DataFrame:
    keys = spark.createDataFrame([(k,) for k in [*dims.INPUT_NAMES, "other"]], "input_key STRING")
    return keys.select("input_key", typed.input_name(F.col("input_key")).alias("name"))


@query("SELECT doc_id AS entity, t AS task_id, CASE WHEN t = 'mdna' THEN coalesce(source, '') ELSE '' END AS source FROM documents CROSS JOIN (SELECT unnest(['mdna', 'risk', 'none']) AS t)")
def task_sources(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("entity"), F.lit("item7_current").alias("key"), F.col("source").alias("text"))
    keys = F.when(F.col("task_id") == "mdna", F.array(F.lit("item7_current"))).when(F.col("task_id") == "risk", F.array(F.lit("item1a_current"))).otherwise(F.array().cast("array<string>"))
    tasks = d.select("entity", F.explode(F.array(*map(F.lit, ("mdna", "risk", "none")))).alias("task_id")).withColumn("input_keys", keys)
    return typed.sources_of(tasks, d).select("entity", "task_id", "source")


@query("SELECT o_orderkey, CAST(least(34, o_orderkey % 50) + least(33, o_orderkey % 40) + greatest(0, least(33, o_orderkey % 45 - 5)) AS INT) AS score FROM orders")
def judge_scores(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", typed.bounded_scores([k % 50, k % 40, k % 45 - 5]).cast("int").alias("score"))


@query("WITH s AS (SELECT o_custkey AS entity, o_orderpriority AS dimension, CAST(max(o_orderkey % 14) AS BIGINT) AS score FROM orders GROUP BY ALL) SELECT entity, CAST(sum(least(10, score)) AS BIGINT) AS total, round(sum(least(10, score)) * 100 / 60.0, 1) AS percent, count(DISTINCT dimension) = 6 AS complete FROM s GROUP BY entity")
def coverage_rubric(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("entity"), F.col("o_orderpriority").alias("dimension")).agg(F.max(F.col("o_orderkey") % 14).alias("score"))
    return typed.coverage(o).withColumn("percent", F.col("percent").cast("double"))


@query("SELECT o_custkey AS entity, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS tasks FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey")
def low_confidence(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return typed.low_confidence(o.select(F.col("o_custkey").alias("entity"), F.col("o_orderpriority").alias("task_id"), (F.col("o_orderstatus") == "P").alias("low_confidence")))


_ITEM8 = "coalesce(max(text) FILTER (section = 'item8'), '')"


@query(duck("filings_v", then=_HITS + _SLICE + f", w AS (SELECT doc_id, coalesce(max(text) FILTER (section = 'item1'), '') AS item1, coalesce(max(text) FILTER (section = 'item1a'), '') AS item1a, coalesce(max(text) FILTER (section = 'item7'), '') AS item7, {_ITEM8} AS item8, coalesce(max(text) FILTER (section = 'item10'), '') || chr(10) || coalesce(max(text) FILTER (section = 'item11'), '') || chr(10) || coalesce(max(text) FILTER (section = 'item13'), '') AS p3 FROM x GROUP BY doc_id) SELECT f.doc_id, md5(coalesce(item1, '')) AS item1_current, md5(coalesce(item1a, '')) AS item1a_current, md5(coalesce(item7, '')) AS item7_current, md5(coalesce(p3, chr(10) || chr(10))) AS partiii_current, md5(substr(coalesce(item8, ''), 1, 5000)) AS item8_fs FROM filings_v f LEFT JOIN w USING (doc_id)"))
def assembled_10k(spark: SparkSession, sf: str) -> DataFrame:
    """A 10-K's sections as the inputs that tasks take; its notes have no marker here, so statements are cut at 5000 characters."""
    d = view(spark, sf, "filings_v")
    w = sections.assembled(d, sections.split_sections(d))
    return w.select("doc_id", *[F.md5(c).alias(c) for c in ("item1_current", "item1a_current", "item7_current", "partiii_current", "item8_fs")])


_TEN_Q = "SELECT doc_id, '## Item 1. Financial Statements' || chr(10) || lang || chr(10) || CASE WHEN doc_id % 2 = 0 THEN 'Notes to Financial Statements' ELSE 'Nothing' END || chr(10) || replace(coalesce(source, ''), 'item', '') || chr(10) || '## Item 2. Management' || chr(10) || CAST(doc_id AS STRING) AS text FROM documents"


@query("SELECT doc_id, '' AS item1_current, '## Item 2. Management' || chr(10) || doc_id AS item7_current, '' AS partiii_current, CASE WHEN doc_id % 2 = 0 THEN h || chr(10) ELSE h || chr(10) || 'Nothing' || chr(10) || source END AS item8_fs, CASE WHEN doc_id % 2 = 0 THEN 'Notes to Financial Statements' || chr(10) || source ELSE h || chr(10) || 'Nothing' || chr(10) || source END AS fn_combined FROM (SELECT *, '## Item 1. Financial Statements' || chr(10) || lang AS h FROM documents)")
def assembled_10q(spark: SparkSession, sf: str) -> DataFrame:
    """A 10-Q: statements in item1, the discussion in item2, notes in one piece."""
    d = spark.sql(_TEN_Q.replace("FROM documents", "FROM {d}"), d=table(spark, sf, "documents"))
    return sections.assembled(d, sections.split_sections(d, "10-Q"), "10-Q").drop("item1a_current")
