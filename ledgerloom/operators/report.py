"""Results to rendered rows: decoding, ordering, grouping and the lines of a report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numbers import money, percent, shares
from ..plans import dims
from ..plans import report_layouts as layouts_of
from . import layouts, renderers


def decoded(value: Column, names: dict[str, str]) -> Column:
    """The display name, or the value itself."""
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.element_at(table, value), value)


def importance_rank(importance: Column) -> Column:
    return F.when(importance == "high", 0).when(importance == "medium", 1).otherwise(2)


def by_importance(rows: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """Rows with their place: high, medium, then low and unknown, in source order."""
    w = Window.partitionBy(*keys).orderBy(importance_rank(F.col("importance")), pos)
    return rows.withColumn("place", F.row_number().over(w))


def grouped_names(rows: DataFrame, keys: list[str], group: str, name: str, pos: str, separator: str = "、") -> DataFrame:
    """(keys.., group, names, place): names joined in source order, groups in order of first appearance."""
    g = rows.groupBy(*keys, group).agg(F.min(pos).alias("__first"), F.array_sort(F.collect_list(F.struct(pos, name))).alias("__n"))
    w = Window.partitionBy(*keys).orderBy("__first")
    return g.select(*keys, group, F.array_join(F.col("__n")[name], separator).alias("names"), F.row_number().over(w).alias("place"))


def traffic_light(result: Column, emerging: Column) -> Column:
    return F.when(F.coalesce(result, F.lit(False)), "🟢").when(F.coalesce(emerging, F.lit(False)), "🟡").otherwise("🔴")


def lights(signals: DataFrame, filing_type: str) -> DataFrame:
    """(doc_id, condition, light), for documents that have anything but red; a 10-Q has no structure condition."""
    s = signals.where(F.col("condition") != "structure") if filing_type == "10-Q" else signals
    any_judged = F.bool_or(F.coalesce("result", F.lit(False)) | F.coalesce("emerging", F.lit(False))).over(Window.partitionBy("doc_id"))
    return s.withColumn("__any", any_judged).where("__any").select("doc_id", "condition", traffic_light(F.col("result"), F.col("emerging")).alias("light"))


def overlaid(base: DataFrame, over: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Key-value rows of both, the second's value where both have the key (a null there counts)."""
    a, b = base.select(*keys, F.col(value).alias("__a")), over.select(*keys, F.col(value).alias("__b"), F.lit(True).alias("__has"))
    return a.join(b, keys, "full_outer").select(*keys, F.when(F.col("__has"), F.col("__b")).otherwise(F.col("__a")).alias(value))


def financial_lines(table: DataFrame, years: list[int]) -> DataFrame:
    """(entity, line_no, text): the metric table as Markdown rows, line 0 its head; growth with its sign, ratios in percent,
    amounts as money, shares in millions. Metrics that the report doesn't have are left out."""
    form = F.create_map(*[F.lit(x) for m, _, f in dims.REPORT_ROWS for x in (m, f)])[F.col("metric")]
    label = F.create_map(*[F.lit(x) for m, name, _ in dims.REPORT_ROWS for x in (m, name)])[F.col("metric")]
    cell = lambda v: F.when(form == "signed", percent(v, True)).when(form == "percent", percent(v)).when(form == "shares", shares(v)).otherwise(money(v))
    text = F.concat(F.lit("| "), F.concat_ws(" | ", label, *[cell(F.col(f"y{y}")) for y in years]), F.lit(" |"))
    place = F.array_position(F.array(*[F.lit(m) for m, _, _ in dims.REPORT_ROWS]), F.col("metric"))
    rows = table.where(form.isNotNull()).select("entity", place.cast("long").alias("line_no"), text.alias("text"))
    head = "| 指標 | " + " | ".join(map(str, years)) + " |\n|------|" + "|".join("------:" for _ in years) + "|"
    return rows.unionByName(table.select("entity").distinct().select("entity", F.lit(0).cast("long").alias("line_no"), F.lit(head).alias("text")))


def quarter_lines(quarters: DataFrame, least: int = 2) -> DataFrame:
    """(entity, line_no, text): the quarterly table, of entities with at least two quarters."""
    w = Window.partitionBy("entity")
    rows = quarters.withColumn("__n", F.count(F.lit(1)).over(w)).where(F.col("__n") >= least)
    text = F.concat(F.lit("| "), F.concat_ws(" | ", "quarter", money(F.col("revenue")), percent(F.col("rev_growth_yoy"), True), percent(F.col("op_margin")), percent(F.col("net_margin"))), F.lit(" |"))
    return rows.select("entity", F.row_number().over(w.orderBy("quarter")).cast("long").alias("line_no"), text.alias("text"))


def report(sections: list[DataFrame]) -> DataFrame:
    """(entity, section_no, line_no, text) of rendered sections in order; sections without rows are left out."""
    out = None
    for k, s in enumerate(sections):
        s = s.select("entity", F.lit(k).alias("section_no"), "line_no", "text")
        out = s if out is None else out.unionByName(s)
    return out


def unavailable(entities: DataFrame) -> DataFrame:
    """(entity, section_no, line_no, text): what stands in the three transcript sections where there is none."""
    rows = F.array(*[F.struct(F.lit(k).alias("section_no"), F.lit(0).cast("long").alias("line_no"), F.lit(layouts_of.UNAVAILABLE.format(section=x)).alias("text")) for k, x in enumerate(layouts_of.TRANSCRIPT_SECTIONS)])
    return entities.select("entity", F.explode(rows).alias("l")).select("entity", "l.*")


def transcript_lines(results: DataFrame) -> DataFrame:
    """(entity, section_no, line_no, text) of the three transcript sections of results (entity, result), null where there is no
    transcript. Each section's blocks have numbers in hundreds."""
    there = results.where("result is not null")
    head = lambda k: there.select("entity", F.lit(100 * k).alias("section_no"), F.lit(0).cast("long").alias("line_no"), F.lit("## " + layouts_of.TRANSCRIPT_SECTIONS[k]).alias("text"))
    moved = lambda df, by: df.withColumn("section_no", F.col("section_no") + by)
    highlights = layouts.rendered(there, layouts_of.HIGHLIGHTS)
    empty = there.where(F.coalesce(F.size(F.json_object_keys("result")), F.lit(0)) == 0).select("entity", F.lit(201).alias("section_no"), F.lit(0).cast("long").alias("line_no"), F.lit(layouts_of.NO_HIGHLIGHTS).alias("text"))
    concerns = renderers.concerns(there).select("entity", F.lit(101).alias("section_no"), "line_no", "text")
    none = unavailable(results.where("result is null")).withColumn("section_no", F.col("section_no") * 100)
    parts = [head(0), moved(layouts.rendered(there, layouts_of.GUIDANCE), 1), head(1), concerns, head(2), moved(highlights, 201), empty, none]
    return reduce(DataFrame.unionByName, parts)


def full_report(results: DataFrame, transcripts: DataFrame, table: DataFrame, years: list[int], quarters: DataFrame, filing_type: str = "10-K") -> DataFrame:
    """(entity, section_no, line_no, text) of whole reports: transcript, divider, numbers, then what the filing's results say.

    results: (entity, result) with all tasks' results in one object; transcripts: (entity, result or null)."""
    at = lambda df, base: df.select("entity", (F.col("section_no") + base).alias("section_no"), "line_no", "text")
    one = lambda df, n: df.select("entity", F.lit(n).alias("section_no"), "line_no", "text")
    line = lambda n, k, text: results.select("entity", F.lit(n).alias("section_no"), F.lit(k).cast("long").alias("line_no"), F.lit(text).alias("text"))
    divider = line(400, 0, layouts_of.DIVIDER.format(filing_type=filing_type))
    known = results.select("entity")
    numbers = one(financial_lines(table, years).join(known, "entity", "left_semi"), 411).unionByName(line(410, 0, "## 財務數據"))
    quarter = quarter_lines(quarters).join(known, "entity", "left_semi")
    heads = quarter.select("entity").distinct().select("entity", F.lit(0).cast("long").alias("line_no"), F.lit("### 季度趨勢\n| 季度 | 營收 | 營收 YoY | 營業利益率 | 淨利率 |\n|------|-----:|------:|------:|------:|").alias("text"))
    parts = [transcript_lines(transcripts), divider, numbers, one(quarter.unionByName(heads), 420), at(layouts.rendered(results, layouts_of.filing_sections(filing_type)), 500)]
    return reduce(DataFrame.unionByName, parts)
