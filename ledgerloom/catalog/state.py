"""Queries over scores, state, usage, rules and rendered lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import evaluation, report, rules, state
from ..plans import dims, skills
from ..streaming import usage as stream
from . import query
from .views import duck, table, view

_TOTAL = "WITH t AS (SELECT *, greatest(0, 25 - 8 * n_missing - 4 * n_empty) AS schema_score FROM eval_v), e AS (SELECT *, CASE WHEN hard THEN 0 ELSE llm_subtotal + schema_score END AS total FROM t), f AS (SELECT *, NOT hard AND total >= 70 AS pass FROM e)"


@query(duck("eval_v", then=_TOTAL + " SELECT task_id, CAST(schema_score AS INT) AS schema_score FROM t"))
def schema_score(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "eval_v").select("task_id", evaluation.schema_score(F.col("n_missing"), F.col("n_empty")).alias("schema_score"))


def _evals(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "eval_v")
    return evaluation.totals(v.withColumn("schema_score", evaluation.schema_score(F.col("n_missing"), F.col("n_empty"))))


@query(duck("eval_v", then=_TOTAL + " SELECT task_id, CAST(total AS INT) AS total, pass FROM f"))
def eval_total(spark: SparkSession, sf: str) -> DataFrame:
    return _evals(spark, sf).select("task_id", "total", "pass")


@query(duck("eval_v", then=_TOTAL + " SELECT task_id, CASE WHEN hard THEN '[Hard rule] hard rule failed: ' || task_id ELSE '' END AS retry_hint FROM f WHERE NOT pass"))
def eval_failed(spark: SparkSession, sf: str) -> DataFrame:
    hint = F.when(F.col("hard"), F.concat(F.lit("[Hard rule] hard rule failed: "), "task_id"))
    return evaluation.failed(_evals(spark, sf).withColumn("retry_hint", hint))


_RESULTS = "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'fn_revenue' WHEN 1 THEN 'financial' WHEN 2 THEN 'three_statement_cross' WHEN 3 THEN 'competitor_mapping' ELSE 'supply_chain' END AS task_id, concat(CASE WHEN doc_id % 3 = 0 THEN 'Revenue Recognition and supply chain ' ELSE '' END, text) AS source, CASE WHEN doc_id % 2 = 0 THEN '{\"metrics\": {}, \"overall_signals\": [], \"named_competitors\": []}' ELSE '{\"metrics\": {\"a\": 1}, \"overall_signals\": [1], \"named_competitors\": [\"x\"], \"supply_chain_risks\": [2], \"revenue_recognition\": {\"policy\": \"p\"}}' END AS result FROM documents"


@query(f"SELECT doc_id, task_id, CASE task_id WHEN 'fn_revenue' THEN contains(lower(source), 'revenue recognition') AND doc_id % 2 = 0 WHEN 'financial' THEN doc_id % 2 = 0 WHEN 'three_statement_cross' THEN length(source) > 100 AND doc_id % 2 = 0 WHEN 'competitor_mapping' THEN length(source) > 1000 AND doc_id % 2 = 0 ELSE contains(lower(source), 'supply chain') AND doc_id % 2 = 0 END AS hard FROM ({_RESULTS})")
def hard_rules(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "documents").createOrReplaceTempView("__documents")
    r = spark.sql(_RESULTS.replace("FROM documents", "FROM __documents"))
    return r.select("doc_id", "task_id", evaluation.hard_fail(F.col("task_id"), F.col("source"), F.col("result")).alias("hard"))


@query(duck("state_v", then="SELECT step_key, event_id, CASE WHEN status = 'running' THEN 'pending' ELSE status END AS status FROM (SELECT *, row_number() OVER (PARTITION BY step_key ORDER BY ts DESC, event_id DESC) AS k FROM state_v) WHERE k = 1"))
def state_latest(spark: SparkSession, sf: str) -> DataFrame:
    return state.latest_state(view(spark, sf, "state_v"), ["step_key"], ["ts", "event_id"]).select("step_key", "event_id", "status")


_LATEST = "WITH s AS (SELECT step_key, status FROM (SELECT *, row_number() OVER (PARTITION BY step_key ORDER BY ts DESC, event_id DESC) AS k FROM state_v) WHERE k = 1)"


@query(duck("state_v", then=_LATEST + " SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS step_key FROM orders WHERE CAST(o_custkey AS VARCHAR) NOT IN (SELECT step_key FROM s WHERE status = 'done')"))
def pending_steps(spark: SparkSession, sf: str) -> DataFrame:
    latest = state.latest_state(view(spark, sf, "state_v"), ["step_key"], ["ts", "event_id"])
    steps = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("step_key")).distinct()
    return state.pending_steps(steps, latest, "step_key")


@query(duck("state_v", then=_LATEST + " SELECT step_key, CASE WHEN step_key IN ('7', '8') OR step_key LIKE '1%' OR status = 'running' THEN 'pending' ELSE status END AS status FROM s"))
def invalidate_cascade(spark: SparkSession, sf: str) -> DataFrame:
    latest = state.latest_state(view(spark, sf, "state_v"), ["step_key"], ["ts", "event_id"])
    return state.invalidated(latest, "step_key", ["7", "8"], ["1"]).select("step_key", "status")


@query(duck("state_v", then="SELECT step_key, CAST(count(*) AS INT) AS n_history, max(event_id) FILTER (k = 1) AS last_event FROM (SELECT *, row_number() OVER (PARTITION BY step_key ORDER BY ts DESC, event_id DESC) AS k FROM state_v) GROUP BY step_key"))
def state_history(spark: SparkSession, sf: str) -> DataFrame:
    """Every change of a step in order, and the last."""
    h = view(spark, sf, "state_v").groupBy("step_key").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "status"))).alias("h"))
    return h.select("step_key", F.size("h").alias("n_history"), F.element_at("h", -1)["event_id"].alias("last_event"))


@query(duck("usage_v", then="SELECT label, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_calls, CAST(sum(n_in) AS BIGINT) AS n_in, CAST(sum(n_out) AS BIGINT) AS n_out, CAST(sum(n_in) AS BIGINT) * 3e-6::DOUBLE + CAST(sum(n_out) AS BIGINT) * 15e-6::DOUBLE AS cost FROM usage_v GROUP BY ALL"))
def usage_cost(spark: SparkSession, sf: str) -> DataFrame:
    return state.usage_cost(view(spark, sf, "usage_v").withColumn("day", F.to_date("ts").cast("string")), "label", "day")


@query(duck("usage_v", then="SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, label, count(*) AS n_calls, sum(n_in * 3e-6 + n_out * 15e-6) AS cost FROM usage_v GROUP BY ALL"))
def usage_windowed(spark: SparkSession, sf: str) -> DataFrame:
    """The streaming cost query over a table: the same plan without a watermark."""
    return stream.windowed_cost(view(spark, sf, "usage_v"))


@query(duck("state_v", then=_LATEST + " SELECT step_key, status FROM s"))
def running_state(spark: SparkSession, sf: str) -> DataFrame:
    return stream.running_state(view(spark, sf, "state_v"))


_TASKS = ", ".join(f"('{t}')" for t, _, _ in dims.TASKS) + ", ('fn_combined')"


@query(f"WITH f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '10-K' ELSE '10-Q' END AS ft, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Q' || (1 + o_orderkey % 4) END AS q, CASE WHEN o_orderkey % 8 = 4 THEN NULL ELSE 1997 END AS py, CAST(o_orderkey % 1000 AS INT) AS pc FROM orders), t(task_id) AS (VALUES {_TASKS}) SELECT o_orderkey, task_id FROM f CROSS JOIN t WHERE NOT (ft = '10-Q' AND (task_id IN ('governance', 'business', 'risk') OR (task_id LIKE 'fn\\_%' ESCAPE '\\' AND task_id <> 'fn_combined'))) AND NOT (ft = '10-Q' AND coalesce(q, '') IN ('Q2', 'Q3') AND task_id IN ('terms_glossary', 'competitor_mapping')) AND NOT (ft = '10-K' AND task_id = 'fn_combined') AND NOT (ft = '10-Q' AND coalesce(q, '') = 'Q1' AND task_id = 'competitor_mapping' AND py IS NULL) AND NOT (task_id = 'fn_pension' AND pc < 500)")
def task_plan(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    f = table(spark, sf, "orders").select("o_orderkey", F.when(k % 3 == 0, "10-K").otherwise("10-Q").alias("filing_type"), F.when(k % 3 != 0, F.concat(F.lit("Q"), (1 + k % 4).cast("string"))).alias("quarter"), F.when(k % 8 != 4, 1997).alias("prior_year"), (k % 1000).cast("int").alias("pension_chars"))
    return state.task_plan(f).select("o_orderkey", "task_id")


@query("WITH a AS (SELECT DISTINCT o_custkey AS entity, o_orderpriority AS name FROM orders WHERE year(o_orderdate) = 1997), b AS (SELECT DISTINCT o_custkey AS entity, o_orderpriority AS name FROM orders WHERE year(o_orderdate) = 1996) SELECT coalesce(a.entity, b.entity) AS entity, coalesce(a.name, b.name) AS name, CASE WHEN b.entity IS NULL THEN 'new' WHEN a.entity IS NULL THEN 'removed' ELSE 'unchanged' END AS status FROM a FULL JOIN b ON a.entity = b.entity AND a.name = b.name")
def yoy_status_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("entity"), F.col("o_orderpriority").alias("name"), F.year("o_orderdate").alias("y"))
    return rules.period_status(o.where("y = 1997"), o.where("y = 1996"), ["entity", "name"])


_COUNTS = "SELECT c_nationkey AS entity, CAST(year(o_orderdate) AS INT) AS year, count(*) FILTER (o_orderstatus = 'O') AS early, count(*) FILTER (o_orderstatus = 'F') AS mature FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"


@query(f"WITH c AS ({_COUNTS}), d AS (SELECT *, early - lag(early) OVER w AS early_delta, mature - lag(mature) OVER w AS mature_delta FROM c WINDOW w AS (PARTITION BY entity ORDER BY year)) SELECT entity, year, CAST(early_delta AS DOUBLE) AS early_delta, CAST(mature_delta AS DOUBLE) AS mature_delta, CASE WHEN mature_delta > 0 OR early_delta > 0 THEN 'accelerating' WHEN mature_delta = 0 AND early_delta = 0 THEN 'stable' WHEN mature_delta < 0 OR early_delta < 0 THEN 'decelerating' END AS direction FROM d")
def narrative_momentum(spark: SparkSession, sf: str) -> DataFrame:
    return rules.narrative_momentum(_counts(spark, sf), "entity", "year").select("entity", "year", F.col("early_delta").cast("double").alias("early_delta"), F.col("mature_delta").cast("double").alias("mature_delta"), "direction")


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.groupBy(F.col("c_nationkey").alias("entity"), F.year("o_orderdate").alias("year")).agg(F.count_if(F.col("o_orderstatus") == "O").alias("early"), F.count_if(F.col("o_orderstatus") == "F").alias("mature"))


@query(f"SELECT entity, year, (early > mature % 7 AND mature % 7 = 0 AND NOT (year % 2 = 0)) AS quality, mature >= 3 AS narrative, NOT (mature >= 3) AND early > 2 AS emerging FROM ({_COUNTS})")
def rerate_signals(spark: SparkSession, sf: str) -> DataFrame:
    c = _counts(spark, sf).withColumn("bullish", F.col("early")).withColumn("bearish", F.col("mature") % 7).withColumn("cashflow_bearish", F.col("year") % 2 == 0)
    c = c.withColumn("direction", F.when(F.col("early") > 2, "accelerating").otherwise("stable"))
    return rules.rerating(c).select("entity", "year", "quality", "narrative", "emerging")


@query("SELECT o_custkey AS doc_id, o_orderkey AS item, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY CASE importance WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, o_orderkey) AS INT) AS place FROM (SELECT *, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'high' WHEN '3' THEN 'medium' WHEN '5' THEN 'low' END AS importance FROM orders)")
def rank_sort_importance(spark: SparkSession, sf: str) -> DataFrame:
    p = F.substring("o_orderpriority", 1, 1)
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("item"), F.when(p == "1", "high").when(p == "3", "medium").when(p == "5", "low").alias("importance"))
    return report.by_importance(o, ["doc_id"], "item").select("doc_id", "item", "place")


@query("WITH c AS (SELECT o_custkey AS doc_id, o_orderpriority AS topic, count(*) AS n FROM orders GROUP BY ALL) SELECT doc_id, topic, n, CAST(k AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, topic) AS k FROM c) WHERE k <= 3")
def topk_concerns(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("doc_id"), F.col("o_orderpriority").alias("topic")).agg(F.count(F.lit(1)).alias("n"))
    return rules.top_k(c, ["doc_id"], 3)


@query("SELECT event_type AS topic, CAST(user_id AS BIGINT) AS doc_id, count(*) AS n FROM events GROUP BY ALL")
def question_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("topic"), F.col("user_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang, count(*) AS n, count(*) FILTER (n_chars > 2000) AS n_high FROM documents GROUP BY lang")
def category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_chars") > 2000).alias("n_high"))


@query("SELECT doc_id, market, names, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY f) AS INT) AS place FROM (SELECT c_nationkey AS doc_id, c_mktsegment AS market, string_agg(c_name, '、' ORDER BY c_custkey) AS names, min(c_custkey) AS f FROM customer GROUP BY ALL)")
def group_concat_ordered(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("doc_id"), F.col("c_mktsegment").alias("market"), "c_name", "c_custkey")
    return report.grouped_names(c, ["doc_id"], "market", "c_name", "c_custkey")


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '高' WHEN '3-MEDIUM' THEN '中' WHEN '5-LOW' THEN '低' ELSE o_orderpriority END AS shown FROM orders")
def enum_decode(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", report.decoded(F.col("o_orderpriority"), {"1-URGENT": "高", "3-MEDIUM": "中", "5-LOW": "低"}).alias("shown"))


@query("SELECT doc_id, text_len FROM (SELECT doc_id, length(text) AS text_len, CASE WHEN doc_id % 3 = 0 THEN 'high' ELSE 'low' END AS importance FROM documents) WHERE importance = 'high'".replace("length(text) AS", "CAST(length(text) AS INT) AS"))
def glossary_high(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").withColumn("importance", F.when(F.col("doc_id") % 3 == 0, "high").otherwise("low"))
    return d.where("importance = 'high'").select("doc_id", F.char_length("text").alias("text_len"))


@query("SELECT c_nationkey AS doc_id, bool_or(c_acctbal < 0) AS any_short, bool_and(c_acctbal > -990) AS all_fine, count(*) AS n FROM customer GROUP BY 1")
def bool_aggs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("doc_id")).agg(F.bool_or(F.col("c_acctbal") < 0).alias("any_short"), F.bool_and(F.col("c_acctbal") > -990).alias("all_fine"), F.count(F.lit(1)).alias("n"))


@query("WITH a AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer), b AS (SELECT c_custkey + 100 AS k, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name END AS v FROM customer) SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NOT NULL THEN b.v ELSE a.v END AS v FROM a FULL JOIN b ON a.k = b.k")
def overlay_merge(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    a = c.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"))
    return report.overlaid(a, c.select((F.col("c_custkey") + 100).alias("k"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_name")).alias("v")), ["k"], "v")


@query("SELECT doc_id, condition, CASE WHEN result THEN '🟢' WHEN emerging THEN '🟡' ELSE '🔴' END AS light FROM (SELECT *, bool_or(result OR emerging) OVER (PARTITION BY doc_id) AS judged FROM (SELECT o_custkey AS doc_id, o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'structure' WHEN 1 THEN 'quality' ELSE 'narrative' END AS condition, o_orderkey % 5 = 0 AS result, o_orderkey % 7 = 0 AS emerging FROM orders) WHERE condition <> 'structure') WHERE judged")
def traffic_light(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    s = table(spark, sf, "orders").select(F.col("o_custkey").alias("doc_id"), F.when(k % 3 == 0, "structure").when(k % 3 == 1, "quality").otherwise("narrative").alias("condition"), (k % 5 == 0).alias("result"), (k % 7 == 0).alias("emerging"))
    return report.lights(s, "10-Q")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def json_extract_props(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit("```json\n"), "props", F.lit("\n```"))
    return table(spark, sf, "events").select("event_id", F.get_json_object(text.parsed_reply(raw), "$.k").cast("int").alias("k"))


@query("SELECT o_orderkey, list_filter([CASE WHEN o_orderkey % 2 = 0 THEN 'revenue_recognition_changed' END, CASE WHEN o_orderpriority = '1-URGENT' THEN 'high_contingency' END, CASE WHEN o_totalprice > 100000 THEN 'dilution' END, CASE WHEN o_orderkey % 5 > 0 THEN 'off_balance_sheet' END], lambda x: x IS NOT NULL) AS f FROM orders".replace("SELECT o_orderkey, list_filter(", "SELECT o_orderkey, array_to_string(list_filter(").replace(" AS f FROM", ", ',') AS flags FROM"))
def quality_flags(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    f = rules.quality_flags(F.col("o_orderkey") % 2 == 0, F.when(F.col("o_orderpriority") == "1-URGENT", "high").otherwise("low"), F.col("o_totalprice") / 10000, (F.col("o_orderkey") % 5).cast("double"))
    return o.select("o_orderkey", F.array_join(f, ",").alias("flags"))


#: A dry run: canned replies, one of them fenced, one broken.
_REPLIES = {
    "financial": '{"metrics": {"a": 1}, "quality_flags": [], "trend_summary": "up", "insufficient_data": false}',
    "risk": '```json\n{"risks": [1], "top_3": [1], "insufficient_data": false}\n```',
    "three_statement_cross": 'Result: {"checks": [1]} and more',
    "supply_chain": "no JSON at all",
}


@query("""SELECT doc_id, n[doc_id % 5 + 1] AS task_id, r[doc_id % 5 + 1] AS result, doc_id % 5 = 2 AND length(text) > 100 AS low_confidence FROM documents, (SELECT ['financial', 'risk', 'three_statement_cross', 'supply_chain', 'fn_tax'] AS n, ['{"metrics": {"a": 1}, "quality_flags": [], "trend_summary": "up", "insufficient_data": false}', '{"risks": [1], "top_3": [1], "insufficient_data": false}', '{"checks": [1]}', '{"error": "JSON parse failed", "raw": "no JSON at all", "skill": null}', '{"insufficient_data": false}'] AS r)""")
def eval_loop(spark: SparkSession, sf: str) -> DataFrame:
    """A task for each document through the dry-run provider, judged, failed ones once more; what fails twice is of low confidence."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    names = F.array(*[F.lit(t) for t in ("financial", "risk", "three_statement_cross", "supply_chain", "fn_tax")])
    tasks = d.select("doc_id", F.get(names, F.pmod("doc_id", F.lit(5)).cast("int")).alias("task_id"), F.col("text").alias("source"))
    tasks = tasks.withColumn("prompt", text.prompt([("source", text.truncated(F.col("source"), 3000))]))
    return skills.evaluated_run(tasks, skills.dry_run(_REPLIES), 81, "doc_id")


@query("SELECT o_orderkey, concat_ws(' / ', nullif(CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderstatus END, ''), nullif(o_orderpriority, '5-LOW')) AS meta, CASE WHEN o_orderkey % 2 = 0 THEN '10-Q' ELSE '10-K' END || ' ' || year(o_orderdate) AS label FROM orders")
def joined_meta(spark: SparkSession, sf: str) -> DataFrame:
    o, even = table(spark, sf, "orders"), F.col("o_orderkey") % 2 == 0
    meta = text.joined([F.when(even, "").otherwise(F.col("o_orderstatus")), F.nullif("o_orderpriority", F.lit("5-LOW"))])
    return o.select("o_orderkey", meta.alias("meta"), F.concat(F.when(even, "10-Q").otherwise("10-K"), F.lit(" "), F.year("o_orderdate").cast("string")).alias("label"))


