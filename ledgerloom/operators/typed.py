"""Results of tasks as typed columns, and what goes from results into later tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import dims


def typed(results: DataFrame, task: str) -> DataFrame:
    """(entity, ..) with the fields of the task's result as typed columns; what isn't of its type is null."""
    rows = results.where(F.col("task_id") == task)
    return rows.select("entity", F.from_json("result", dims.NOTE_SCHEMAS[task]).alias("r")).select("entity", "r.*")


def of_enum(value: Column, name: str) -> Column:
    """The value if it is one that the field may have, else null."""
    return F.when(value.isin(dims.ENUMS[name]), value)


def large_holders(governance: DataFrame) -> DataFrame:
    """(entity, name, pct): holders of more than HOLDER_PERCENT, by the numbers in their text."""
    rows = governance.select("entity", F.explode("major_shareholders").alias("h")).select("entity", "h.name", F.regexp_extract("h.pct", r"(\d+(?:\.\d+)?)", 1).try_cast("double").alias("pct"))
    return rows.where(F.col("pct") > dims.HOLDER_PERCENT)


def _key(result: Column, name: str) -> Column:
    """"name": its JSON text, or null."""
    x = F.get_json_object(result, f"$.{name}")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(result), f"$.{name}", "variant"))
    return F.concat(F.lit(f'"{name}": '), F.coalesce(F.when(kind == "STRING", F.concat(F.lit('"'), F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))).otherwise(x), F.lit("null")))


def slim(results: DataFrame) -> DataFrame:
    """Results (.., task_id, result) of which long ones keep only the keys that the synthesis reads."""
    out = F.col("result")
    for task, keys in dims.SLIM_KEYS.items():
        short = F.concat(F.lit("{"), F.concat_ws(", ", *[_key(F.col("result"), k) for k in keys]), F.lit("}"))
        out = F.when((F.col("task_id") == task) & F.col("result").startswith("{"), short).otherwise(out)
    return results.withColumn("result", out)


def note_summary(results: DataFrame) -> DataFrame:
    """(entity, notes): the notes' valid results by task, in order of name; fn_combined, where an entity has it, is all there is,
    and nothing is where that one is an error."""
    rows = results.where(F.col("task_id").startswith("fn_") & F.coalesce(F.col("result").startswith("{"), F.lit(False)))
    pair = F.struct("task_id", "result")
    g = rows.groupBy("entity").agg(F.max(F.when(F.col("task_id") == "fn_combined", pair)).alias("c"), F.array_sort(F.collect_list(F.when(F.col("task_id") != "fn_combined", pair))).alias("l"))
    good = F.get_json_object("c.result", "$.error").isNull()
    empty = F.lit(None).cast(g.schema["l"].dataType)
    return g.select("entity", F.map_from_entries(F.when(F.col("c").isNull(), F.col("l")).when(good, F.array("c")).otherwise(F.coalesce(empty, F.array().cast(g.schema["l"].dataType)))).alias("notes"))


def inputs_json(*columns: str) -> Column:
    """The columns as one JSON object, as a prompt takes it; nulls are left out, text stays as it is beyond ASCII."""
    return F.to_json(F.struct(*columns))


def without_raw(rows: DataFrame) -> DataFrame:
    """Rows without the raw text, which later tasks don't read: the scan then leaves the column out."""
    return rows.drop("raw_text")


def input_name(key: Column) -> Column:
    """The name under which a task takes a section; a key without one keeps its own."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in dims.INPUT_NAMES.items() for x in kv]), key), key)


def sources_of(tasks: DataFrame, inputs: DataFrame) -> DataFrame:
    """Tasks (entity, task_id, input_keys, ..) with the text they were given: their first input's, or none."""
    keyed = tasks.withColumn("key", F.try_element_at("input_keys", F.lit(1)))
    return keyed.join(inputs.select("entity", "key", F.col("text").alias("source")), ["entity", "key"], "left").withColumn("source", F.coalesce("source", F.lit(""))).drop("key")


def bounded_scores(parts: list[Column]) -> Column:
    """The sum of a judge's part scores, each cut to its bounds."""
    total = F.lit(0)
    for x, most in zip(parts, dims.SCORE_PARTS, strict=True):
        total = total + F.greatest(F.lit(0), F.least(F.lit(most), F.coalesce(x, F.lit(0))))
    return total


def coverage(scores: DataFrame) -> DataFrame:
    """(entity, total, percent, grade_ready) of a completeness rubric (entity, dimension, score): six dimensions of 0 to 10."""
    cut = F.greatest(F.lit(0), F.least(F.lit(10), F.coalesce("score", F.lit(0))))
    g = scores.groupBy("entity").agg(F.sum(cut).cast("long").alias("total"), F.count_distinct("dimension").alias("__n"))
    return g.select("entity", "total", F.round(F.col("total") * 100 / (10 * dims.COVERAGE_DIMENSIONS), 1).alias("percent"), (F.col("__n") == dims.COVERAGE_DIMENSIONS).alias("complete"))


def low_confidence(runs: DataFrame) -> DataFrame:
    """(entity, tasks): names of an entity's tasks of low confidence, in order."""
    return runs.where("low_confidence").groupBy("entity").agg(F.array_join(F.array_sort(F.collect_set("task_id")), ", ").alias("tasks"))
