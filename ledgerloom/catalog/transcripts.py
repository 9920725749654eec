"""Queries over transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import transcripts as t
from . import query
from .views import duck, table, view

_NAME = r"^\s*([\w\p{L}][\w\p{L}\t .\-'']*?)[ \t]*:\s*"
_HALVES = "WITH q AS (SELECT doc_id, text, coalesce(nullif(strpos(text, 'Questions and Answers Session'), 0), length(text) + 1) AS cut FROM transcripts_v), h AS (SELECT doc_id, 'prepared' AS part, substr(text, 1, cut - 1) AS text FROM q UNION ALL SELECT doc_id, 'qa', substr(text, cut) FROM q)"
_TURNS = _HALVES + f", l AS (SELECT doc_id, part, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM h), n AS (SELECT *, nullif(trim(regexp_extract(line, '{_NAME}(.*)$', 1)), '') AS name, CASE WHEN regexp_matches(line, '{_NAME}') THEN regexp_extract(line, '{_NAME}(.*)$', 2) ELSE line END AS said FROM l), c AS (SELECT *, count(name) OVER (PARTITION BY doc_id, part ORDER BY i) AS turn FROM n), t AS (SELECT doc_id, part, turn, max(name) AS speaker_raw, trim(string_agg(said, chr(10) ORDER BY i), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS text FROM c GROUP BY ALL)"
_CLAIMS = "WITH w AS (SELECT *, string_split(lower(trim(name)), ' ') AS ws FROM people_v), c AS (SELECT doc_id, name, lower(trim(name)) AS alias, true AS is_full FROM w UNION ALL SELECT doc_id, name, ws[1], false FROM w WHERE len(ws) >= 2 UNION ALL SELECT doc_id, name, ws[-1], false FROM w WHERE len(ws) >= 2), g AS (SELECT doc_id, alias, count(*) FILTER (is_full) AS full_n, count(*) AS n, max(name) AS name FROM c GROUP BY doc_id, alias)"


@query(duck("transcripts_v", then=_HALVES + " SELECT doc_id, part, md5(text) AS text_md5, CAST(length(text) AS INT) AS n_chars FROM h"))
def qa_split(spark: SparkSession, sf: str) -> DataFrame:
    return t.halves(view(spark, sf, "transcripts_v")).select("doc_id", "part", F.md5("text").alias("text_md5"), F.char_length("text").alias("n_chars"))


@query(duck("transcripts_v", then=_TURNS + " SELECT doc_id, part, turn, speaker_raw, md5(text) AS text_md5 FROM t"))
def speaker_turns(spark: SparkSession, sf: str) -> DataFrame:
    out = t.turns(t.halves(view(spark, sf, "transcripts_v")))
    return out.select("doc_id", "part", "turn", "speaker_raw", F.md5("text").alias("text_md5"))


@query(duck("people_v", then=_CLAIMS + " SELECT doc_id, alias, n FROM g"))
def alias_unique(spark: SparkSession, sf: str) -> DataFrame:
    return t.alias_claims(view(spark, sf, "people_v")).groupBy("doc_id", "alias").agg(F.count(F.lit(1)).alias("n"))


@query(duck("people_v", then=_CLAIMS + " SELECT doc_id, alias, name FROM g WHERE full_n > 0 OR n = 1"))
def speaker_alias(spark: SparkSession, sf: str) -> DataFrame:
    return t.alias_index(view(spark, sf, "people_v"))


@query()
def speaker_fuzzy(spark: SparkSession, sf: str) -> DataFrame:
    out = t.speakers(t.turns(t.halves(view(spark, sf, "transcripts_v"))), view(spark, sf, "people_v"))
    return out.select("doc_id", "part", "turn", "speaker_raw", "speaker")


@query()
def parsed_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    out = t.parse_transcripts(view(spark, sf, "transcripts_v"), view(spark, sf, "people_v"))
    return out.withColumn("text", F.md5("text"))


@query(duck("transcripts_v", then=_TURNS + " SELECT doc_id, part, turn FROM t WHERE NOT (speaker_raw IS NULL AND trim(text) = '')"))
def drop_empty_unknown(spark: SparkSession, sf: str) -> DataFrame:
    said = t.turns(t.halves(view(spark, sf, "transcripts_v"))).withColumn("speaker", F.coalesce("speaker_raw", F.lit("Unknown")))
    return t.drop_empty_unknown(said).select("doc_id", "part", "turn")


@query("SELECT doc_id, CASE WHEN length(coalesce(text, '')) < 1000 THEN 'short_text' WHEN doc_id % 9 = 0 THEN 'no_participants' END AS problem FROM documents")
def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", t.quality_error(F.col("text"), F.when(F.col("doc_id") % 9 == 0, 0).otherwise(2)).alias("problem"))


@query("SELECT c_custkey, CASE WHEN NOT regexp_matches(upper(trim(tick)), '^[A-Z]{1,5}$') THEN 'ticker' WHEN NOT regexp_matches(q, '(?i)^Q[1-4]$') THEN 'quarter' WHEN NOT regexp_matches(y, '^\\d{4}$') THEN 'year' END AS problem FROM (SELECT c_custkey, substr(c_mktsegment, 1, CAST(1 + c_custkey % 7 AS INT)) AS tick, 'q' || (c_custkey % 6) AS q, CAST(CASE WHEN c_custkey % 5 = 0 THEN c_custkey % 1000 ELSE 2000 + c_custkey % 20 END AS VARCHAR) AS y FROM customer)")
def validate_inputs(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    year = F.when(k % 5 == 0, k % 1000).otherwise(2000 + k % 20).cast("string")
    return c.select("c_custkey", t.input_error(F.substring("c_mktsegment", F.lit(1), (1 + k % 7).cast("int")), F.concat(F.lit("q"), (k % 6).cast("string")), year).alias("problem"))


@query("SELECT event_id, CASE WHEN event_type = 'view' THEN 'ok' WHEN contains(lower(m), 'auth wall') OR contains(lower(m), 'sign in') THEN 'auth' WHEN contains(lower(m), 'transcript not found') THEN 'not_found' ELSE 'retry' END AS kind FROM (SELECT event_id, event_type, CASE event_type WHEN 'click' THEN 'Auth Wall hit' WHEN 'signup' THEN 'please Sign In' WHEN 'error' THEN 'Transcript NOT found' END AS m FROM events)".replace("lower(m)", "lower(coalesce(m, ''))"))
def error_classify(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_type")
    m = F.when(e == "click", "Auth Wall hit").when(e == "signup", "please Sign In").when(e == "error", "Transcript NOT found")
    return table(spark, sf, "events").select("event_id", t.failure_kind(m, F.when(e == "view", 0).otherwise(1)).alias("kind"))


@query("SELECT o_custkey AS page_id, CAST(min(o_orderkey) AS BIGINT) AS pos, 'h' || min(o_orderkey) AS href FROM (SELECT *, 'Call  q' || quarter(o_orderdate) || CASE WHEN o_orderkey % 2 = 0 THEN ' fy' ELSE '-' END || year(o_orderdate) AS title FROM orders) WHERE regexp_matches(upper(title), 'Q2[\\s-]*(FY)?1998') GROUP BY o_custkey")
def anchor_first_match(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    title = F.concat(F.lit("Call  q"), F.quarter("o_orderdate").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, " fy").otherwise("-"), F.year("o_orderdate").cast("string"))
    anchors = o.select(F.col("o_custkey").alias("page_id"), F.col("o_orderkey").alias("pos"), title.alias("title"), F.concat(F.lit("h"), F.col("o_orderkey").cast("string")).alias("href"))
    return t.first_anchor(anchors, "Q2", "1998")


@query("SELECT doc_id, md5(coalesce(CASE WHEN length(a) BETWEEN 1000 AND 200000 THEN a END, CASE WHEN length(b) BETWEEN 1000 AND 200000 THEN b END, text)) AS text_md5 FROM (SELECT doc_id, text, CASE WHEN doc_id % 2 = 0 THEN text END AS a, concat(source, ' ', text) AS b FROM documents)")
def coalesce_candidates(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    body = F.col("text")
    candidates = [F.when(F.col("doc_id") % 2 == 0, body), F.concat("source", F.lit(" "), body)]
    return d.select("doc_id", F.md5(t.first_fitting(candidates, body, 1000, 200_000)).alias("text_md5"))
