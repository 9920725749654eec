"""The operators of this subpackage as queries over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import line_dedup, mixing, near_dup, packing, passages, quality, sharding, suffix_dedup, token_counts, topk

CONTEXT = 2048


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(_table(spark, sf_dir, "documents"), _tokenizer())
    return counts.withColumn("over_limit", F.col("n_tokens") > CONTEXT)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _tokenizer(), CONTEXT, 1)


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passages.dedup_passages(_table(spark, sf_dir, "documents"))
    size = F.aggregate(F.coalesce("removed", F.array()), F.lit(0), lambda n, s: n + s["stop"] - s["start"]).cast("long")
    return out.select("doc_id", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_spans"), size.alias("n_removed"), "removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_documents(_table(spark, sf_dir, "documents"), sharding.even_tree(8))
    return sharding.place(rows.withColumn("law", F.lit("key")), sharding.even_tree(9), "doc_id", "grown_shard")


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(_table(spark, sf_dir, "documents")).withColumn("positions", mixing.positions())
    plan = plan.orderBy(F.try_element_at("positions", F.lit(1)).asc_nulls_last(), "doc_id")
    return plan.select("doc_id", "source", "size", "source_size", "target", "taken", "positions")


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20, 64)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_counts, op2_quality, op3_near_duplicates, op4_lines, op5_pack, op6_passages, op7_shards, op8_mix, op9_repeats, op10_top_k)}


_LINES = """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
h AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.i, k.line, h.key IS NOT NULL AND k.doc_id <> h.last AS gone FROM k LEFT JOIN h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id
"""

_TOP = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def _quality_sql() -> str:
    """Measures by windows over words and lines, sketches by bucket, fences by quartile, then the verdict."""
    ratios = quality.RATIOS
    values = ", ".join(f"('{k}', CASE WHEN {x[1]} > 0 THEN {x[0]} * {x[2]} // {x[1]} ELSE 0 END, {x[0]} * {x[2]}, {x[1]}, {x[6] * x[2]})" for k, x in ratios.items())
    high = {k: f"q{x[3]} + {x[5]} * (q{x[3]} - q50) + {quality.CLOSEST}" for k, x in ratios.items()}
    low = {k: f"q{x[4]} - {x[5]} * (q50 - q{x[4]}) - {quality.CLOSEST}" for k, x in ratios.items() if x[4] is not None}
    limits = "CASE ratio " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in high.items()) + " END AS hi, CASE ratio " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in low.items()) + " END AS lo"
    quartiles = ", ".join(f"min(CASE WHEN below * 100 >= total * {p} THEN bucket END) AS q{p}" for p in (25, 50, 75, 90, 98)) + ", max(total) AS n_docs"

    def fences(keys: str) -> str:
        by = f"PARTITION BY {keys}, ratio" if keys else "PARTITION BY ratio"
        group = f"{keys}, ratio" if keys else "ratio"
        lead = f"{keys}, " if keys else ""
        return f"(SELECT {lead}ratio, n_docs, {limits} FROM (SELECT {lead}ratio, {quartiles} FROM (SELECT {lead}ratio, bucket, sum(n) OVER ({by} ORDER BY bucket) AS below, sum(n) OVER ({by}) AS total FROM (SELECT {lead}ratio, bucket, sum(n) AS n FROM sk GROUP BY {group}, bucket)) GROUP BY {group}))"

    return f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w0, generate_subscripts(ws, 1) AS i FROM d),
t AS (SELECT *, lead(w0, 1) OVER o AS w1, lead(w0, 2) OVER o AS w2 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w0, w1, w2) AS c FROM t WHERE w2 IS NOT NULL) WHERE c >= 2),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r CROSS JOIN (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
ln AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (SELECT d.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines FROM d LEFT JOIN rep ON rep.doc_id = d.doc_id LEFT JOIN ln ON ln.doc_id = d.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
v AS (SELECT b.doc_id, b.lang, b.source, b.base_failed, x.ratio, CAST(x.v AS BIGINT) AS v, x.a, x.per, x.units FROM b CROSS JOIN LATERAL (VALUES {values}) x(ratio, v, a, per, units)),
sk AS (SELECT lang, source, ratio, (v >> greatest(length(bin(v)) - {quality.BITS}, 0)) << greatest(length(bin(v)) - {quality.BITS}, 0) AS bucket, count(*) AS n FROM v WHERE NOT base_failed GROUP BY ALL),
f AS (SELECT g.lang, g.source, g.ratio, CASE WHEN g.n_docs >= {quality.LEAST} THEN g.hi WHEN l.n_docs >= {quality.LEAST} THEN l.hi ELSE a.hi END AS hi, CASE WHEN g.n_docs >= {quality.LEAST} THEN g.lo WHEN l.n_docs >= {quality.LEAST} THEN l.lo ELSE a.lo END AS lo
 FROM {fences("lang, source")} g JOIN {fences("lang")} l ON l.ratio = g.ratio AND l.lang IS NOT DISTINCT FROM g.lang JOIN {fences("")} a ON a.ratio = g.ratio),
ok AS (SELECT v.doc_id, bool_and(coalesce(v.a <= f.hi * v.per + v.units AND (f.lo IS NULL OR v.a >= f.lo * v.per - v.units), true)) AS fine FROM v LEFT JOIN f ON f.ratio = v.ratio AND f.lang IS NOT DISTINCT FROM v.lang AND f.source IS NOT DISTINCT FROM v.source GROUP BY v.doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed, NOT base_failed AND fine AS kept FROM b JOIN ok ON ok.doc_id = b.doc_id
"""


def oracle_sql() -> dict[str, str]:
    """SQL of the three that it can express in whole; the others have brute-force tests."""
    return {"op2_quality": _quality_sql(), "op4_lines": _LINES, "op10_top_k": _TOP}
