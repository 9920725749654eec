"""Pipeline state: latest state per key, pending steps, invalidation, usage cost, task plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import dims


def latest_state(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of an append-only log the last row per key; what was running when the log ended is pending."""
    rest = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("s")).select(*keys, "s.*")
    return last.withColumn("status", F.when(F.col("status") == "running", "pending").otherwise(F.col("status")))


def pending_steps(steps: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """Steps that aren't done: what a resumed run still has to do."""
    return steps.join(state.where("status = 'done'").select(key), key, "left_anti")


def invalidated(state: DataFrame, key: str, tasks: list[str], also: list[str]) -> DataFrame:
    """States with the named tasks and whatever begins with ``also`` (later phases) set back to pending."""
    hit = F.col(key).isin(tasks)
    for p in also:
        hit = hit | F.col(key).startswith(p)
    return state.withColumn("status", F.when(hit, "pending").otherwise(F.col("status")))


def call_cost(n_in: Column, n_out: Column) -> Column:
    return n_in * F.lit(dims.TOKEN_PRICE[0]) + n_out * F.lit(dims.TOKEN_PRICE[1])


def usage_cost(calls: DataFrame, *by: str) -> DataFrame:
    """Calls, tokens and dollars by label (and day)."""
    return calls.groupBy(*by).agg(F.count(F.lit(1)).alias("n_calls"), F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out")).withColumn("cost", call_cost(F.col("n_in"), F.col("n_out")))


def task_plan(filings: DataFrame) -> DataFrame:
    """(.., task_id, skill, input_keys, extra) for each filing (filing_type, quarter, prior_year, pension_chars).

    A 10-Q drops governance, business and risk, and replaces the notes' tasks by fn_combined; its second and third
    quarters also drop the glossary and competitors; its first compares competitors with the prior 10-K, if there is one."""
    spark: SparkSession = filings.sparkSession
    rows = [*dims.TASKS, ("fn_combined", "footnotes_combined", ["fn_combined"])]
    tasks = spark.createDataFrame([(i, *t) for i, t in enumerate(rows)], "pos INT, task_id STRING, skill STRING, input_keys ARRAY<STRING>")
    t, q10, q = F.col("task_id"), F.col("filing_type") == "10-Q", F.col("quarter")
    every = filings.withColumn("__t", F.explode(F.array(*[F.lit(x[0]) for x in rows])))
    plan = every.join(F.broadcast(tasks), F.col("__t") == t).drop("__t")  # fifteen tasks
    drop = q10 & (t.isin("governance", "business", "risk") | (t.startswith("fn_") & (t != "fn_combined")))
    drop = drop | (q10 & q.isin("Q2", "Q3") & t.isin("terms_glossary", "competitor_mapping")) | (~q10 & (t == "fn_combined"))
    drop = drop | (q10 & (q == "Q1") & (t == "competitor_mapping") & F.col("prior_year").isNull())
    drop = drop | ((t == "fn_pension") & (F.coalesce("pension_chars", F.lit(0)) < dims.PENSION_MIN_CHARS))
    plan = plan.where(~F.coalesce(drop, F.lit(False)))
    first = q10 & (q == "Q1") & (t == "competitor_mapping")
    extra = F.when(q10 & (t == "mdna"), F.concat(F.lit("filing_type=10-Q,quarter="), F.coalesce(q, F.lit(""))))
    extra = F.when(first, F.concat(F.lit("mode=q1_vs_10k,prior_year="), F.col("prior_year").cast("string"))).otherwise(extra)
    keys = F.when(first, F.array(F.lit("item1_prior_as_current"))).otherwise(F.col("input_keys"))
    return plan.withColumn("input_keys", keys).withColumn("extra", extra)
