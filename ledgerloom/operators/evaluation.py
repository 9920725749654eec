"""Scores of task results: schema completeness, hard rules, totals, failures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import dims


def schema_score(n_missing: Column, n_empty: Column) -> Column:
    """25 less 8 for each missing key and 4 for each empty one; a missing key is empty too. Not below 0."""
    return F.greatest(F.lit(0), F.lit(dims.FULL_SCHEMA) - dims.MISSING_COST * n_missing - dims.EMPTY_COST * n_empty)


def json_schema_score(result: Column, task: Column) -> Column:
    """``schema_score`` of a JSON object text for its task's required keys; '', null and [] are empty."""
    names = F.coalesce(F.json_object_keys(result), F.array().cast("array<string>"))
    required = F.create_map(*[x for k, v in dims.REQUIRED_KEYS.items() for x in (F.lit(k), F.array(*[F.lit(s) for s in v]))])
    keys = F.coalesce(F.element_at(required, task), F.array().cast("array<string>"))
    values = F.from_json(result, "map<string,string>")
    empty = lambda k: F.coalesce(F.element_at(values, k), F.lit("")).isin("", "[]")
    return schema_score(F.size(F.filter(keys, lambda k: ~F.array_contains(names, k))), F.size(F.filter(keys, empty)))


def hard_fail(task: Column, source: Column, result: Column) -> Column:
    """Whether a fixed rule fails the result, whatever its score."""
    get = lambda p: F.coalesce(F.get_json_object(result, p), F.lit(""))
    none = lambda p: get(p).isin("", "[]", "{}", "null", "false", "0")
    src = F.coalesce(source, F.lit(""))
    rules = {
        "fn_revenue": F.lower(src).contains("revenue recognition") & none("$.revenue_recognition.policy"),
        "financial": none("$.metrics"),
        "three_statement_cross": (F.char_length(src) > 100) & none("$.overall_signals"),
        "competitor_mapping": (F.char_length(src) > 1000) & none("$.named_competitors"),
        "supply_chain": F.lower(src).contains("supply chain") & none("$.supply_chain_risks"),
    }
    return reduce(lambda c, r: F.when(task == r[0], r[1]).otherwise(c), rules.items(), F.lit(False))


def totals(rows: DataFrame) -> DataFrame:
    """Rows (.., hard, llm_subtotal, schema_score) with total and pass; a hard failure totals 0."""
    total = F.when(F.col("hard"), F.lit(0)).otherwise(F.coalesce("llm_subtotal", F.lit(0)) + F.col("schema_score"))
    rows = rows.withColumn("total", total)
    return rows.withColumn("pass", ~F.col("hard") & (F.col("total") >= dims.PASS_TOTAL))


def failed(evals: DataFrame, key: str = "task_id") -> DataFrame:
    """(key, retry_hint) of results that didn't pass or have no verdict."""
    return evals.where(~F.coalesce("pass", F.lit(False))).select(key, F.coalesce("retry_hint", F.lit("")).alias("retry_hint"))
