"""Extraction and judging tasks as a pluggable provider over partitions, with a deterministic dry run.

The provider is the only place that a model would be called from; tasks' prompts go in as rows, and each row's reply
comes back as text and as JSON text. Replies are written before anything reads them, so each task is called once for each
try, and a run that is started again calls only what it hasn't got; failed tasks are tried once more with the judge's hint."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import parsed_reply
from ..operators import evaluation
from ..session import run_folder

#: (task_id, prompt) -> reply.
Provider = Callable[[str, str], str]


def dry_run(outputs: dict[str, str]) -> Provider:
    """Canned replies by task; one that has none isn't insufficient, and says no more."""

    def reply(task_id: str, prompt: str) -> str:
        return outputs.get(task_id, '{"insufficient_data": false}')

    return reply


def run_tasks(tasks: DataFrame, provider: Provider) -> DataFrame:
    """(task_id, .., raw, result): each row's prompt through the provider; result is JSON text, salvaged if need be."""
    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(raw=[provider(t, p) for t, p in zip(b["task_id"], b["prompt"], strict=True)])

    schema = T.StructType([*tasks.schema.fields, T.StructField("raw", T.StringType())])
    return tasks.mapInPandas(call, schema).withColumn("result", parsed_reply(F.col("raw")))


def evaluate(results: DataFrame, subtotal: Callable[[str], int] | int, key: str = "task_id") -> DataFrame:
    """(key, task_id, total, pass, retry_hint) of results (task_id, source, result); those that are errors have no row."""
    rows = results.where(F.get_json_object("result", "$.error").isNull())
    rows = rows.withColumn("hard", evaluation.hard_fail(F.col("task_id"), F.col("source"), F.col("result")))
    rows = rows.withColumn("schema_score", evaluation.json_schema_score(F.col("result"), F.col("task_id"))).withColumn("llm_subtotal", F.lit(subtotal))
    rows = evaluation.totals(rows)
    hint = F.when(F.col("hard"), F.concat(F.lit("[Hard rule] hard rule failed: "), "task_id")).otherwise(F.lit(""))
    return rows.select(*dict.fromkeys([key, "task_id"]), "schema_score", "total", "pass", hint.alias("retry_hint"))


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def run_once(tasks: DataFrame, provider: Provider, path: str, key: str = "task_id") -> DataFrame:
    """The tasks' results by way of the table at ``path``: only those whose ``key`` it doesn't have yet are run and added.

    A write is all or nothing, so a run that dies leaves whole results of earlier runs only."""
    spark = tasks.sparkSession
    todo = tasks
    if _exists(spark, path):
        todo = tasks.join(spark.read.parquet(path).select(F.col(key).alias("__done")), F.col(key).eqNullSafe(F.col("__done")), "left_anti")
    if not _exists(spark, path) or not todo.isEmpty():
        run_tasks(todo, provider).write.mode("append").parquet(path)
    done = spark.read.parquet(path)
    return done.join(tasks.select(F.col(key).alias("__asked")).distinct(), F.col(key).eqNullSafe(F.col("__asked")), "left_semi")


def evaluated_run(tasks: DataFrame, provider: Provider, subtotal: int, key: str = "task_id", path: str | None = None) -> DataFrame:
    """Run, judge, run what failed once more with its hint, judge again; what fails twice is of low confidence.

    ``key`` is a column that tells tasks apart, where several have the same task_id; it is returned too. path: a folder that
    keeps the replies of both tries, so that the same run finds them there; a new one in the shared folder by default."""
    path = path or run_folder(tasks.sparkSession, "run")
    first = run_once(tasks, provider, f"{path}/first", key)
    failed = evaluation.failed(evaluate(first, subtotal, key), key)
    again = tasks.join(failed, key).withColumn("prompt", F.concat_ws("\n\n", "prompt", F.concat(F.lit("## retry_hint\n"), "retry_hint"))).drop("retry_hint")
    second = run_once(again.select(*tasks.columns), provider, f"{path}/second", key)
    verdicts = evaluate(second, subtotal, key).select(key, F.col("pass").alias("second_pass"))
    kept = first.join(failed.select(key), key, "left_anti").unionByName(second)
    return kept.join(verdicts, key, "left").select(*dict.fromkeys([key, "task_id"]), "result", (~F.coalesce("second_pass", F.lit(True))).alias("low_confidence"))
