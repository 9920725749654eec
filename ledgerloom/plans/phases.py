"""The phases of an analysis: each phase's tasks read what earlier phases found, and each phase is written before the next.

A phase is one pass over its tasks of all entities. Its results are a table in the run's folder, so a run that is started
again reads the phases that are there and calls the provider only for tasks that are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import typed
from ..operators.state import task_plan
from . import dims
from .skills import Provider, run_once


def first_tasks(filings: DataFrame, inputs: DataFrame) -> DataFrame:
    """(step, entity, task_id, source, prompt) of the first phase: filings (entity, filing_type, quarter, prior_year,
    pension_chars) and their inputs (entity, key, text). A task's prompt has its inputs that have text, by their names."""
    plan = task_plan(filings).select("entity", "task_id", "input_keys", "extra")
    named = plan.select("entity", "task_id", "extra", F.posexplode("input_keys").alias("pos", "key")).join(inputs, ["entity", "key"], "left")
    block = F.when(F.coalesce("text", F.lit("")) != "", F.concat(F.lit("## "), typed.input_name(F.col("key")), F.lit("\n"), "text"))
    rows = named.groupBy("entity", "task_id").agg(F.max("extra").alias("extra"), F.array_sort(F.collect_list(F.struct("pos", block.alias("b"), F.coalesce("text", F.lit("")).alias("text")))).alias("i"))
    prompt = F.concat_ws("\n\n", F.array_compact(F.transform("i", lambda x: x["b"])), F.when(F.col("extra").isNotNull(), F.concat(F.lit("## extra\n"), "extra")))
    return _steps(rows.select("entity", "task_id", F.coalesce(F.try_element_at("i", F.lit(1))["text"], F.lit("")).alias("source"), prompt.alias("prompt")), "phase1")


def _steps(tasks: DataFrame, phase: str) -> DataFrame:
    step = F.concat(F.col("entity").cast("string"), F.lit(f".{phase}."), "task_id")
    return tasks.select(step.alias("step"), "entity", "task_id", "source", "prompt")


def later_tasks(entities: DataFrame, results: DataFrame, phase: str, tasks: list[tuple]) -> DataFrame:
    """A phase's tasks for all entities: the results that each reads, as JSON by name; results that are errors aren't read. The
    synthesis gets long ones slimmed."""
    good = results.where(F.get_json_object("result", "$.error").isNull())
    good = typed.slim(good) if phase == "synthesis" else good
    notes = typed.note_summary(results).select("entity", F.lit("notes").alias("task_id"), F.to_json(F.transform_values("notes", lambda _, v: F.from_json(v, "map<string,string>"))).alias("result"))
    pool = good.select("entity", "task_id", "result").unionByName(notes)
    reads = [(t, k, i) for t, _, ks in tasks for i, k in enumerate(ks)]
    wanted = F.broadcast(entities.sparkSession.createDataFrame(reads, "task STRING, task_id STRING, pos INT"))  # a phase's reads, a few rows
    found = wanted.join(pool, "task_id")
    block = F.concat(F.lit("## "), "task_id", F.lit("\n"), "result")
    prompts = found.groupBy("entity", "task").agg(F.array_sort(F.collect_list(F.struct("pos", block.alias("b")))).alias("b"))
    every = entities.select("entity", F.explode(F.array(*[F.lit(t) for t, _, _ in tasks])).alias("task"))
    rows = every.join(prompts, ["entity", "task"], "left").select("entity", F.col("task").alias("task_id"), F.coalesce(F.array_join("b.b", "\n\n"), F.lit("")).alias("prompt"))
    return _steps(rows.withColumn("source", F.col("prompt")), phase)


def run_phases(filings: DataFrame, inputs: DataFrame, provider: Provider, path: str) -> DataFrame:
    """(entity, phase, task_id, result) of all phases, each written under ``path`` and read from there if it is there already.

    A 10-Q has no segment trend and no structure condition."""
    entities = filings.select("entity", "filing_type")
    out = run_once(first_tasks(filings, inputs), provider, f"{path}/phase1", "step").select("entity", F.lit("phase1").alias("phase"), "task_id", "result")
    for phase, tasks in dims.PHASES:
        todo = later_tasks(entities.select("entity"), out, phase, tasks)
        todo = todo.join(entities, "entity").where((F.col("filing_type") != "10-Q") | ~F.col("task_id").isin("segment_trend", "rerate_structure")).drop("filing_type")
        done = run_once(todo, provider, f"{path}/{phase}", "step")
        out = out.unionByName(done.select("entity", F.lit(phase).alias("phase"), "task_id", "result"))
    return out
