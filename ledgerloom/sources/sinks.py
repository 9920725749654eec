"""Writers: ordered reports, JSON results, append-only logs and write-once caches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report(lines: DataFrame, path: str) -> None:
    """Rendered (section_no, line_no, text) as one Markdown file, or with (entity, ..) one in a folder for each entity.

    One report's lines are few and are sorted in one task; entities are dealt over tasks."""
    if "entity" not in lines.columns:
        lines.orderBy("section_no", "line_no").select("text").coalesce(1).write.mode("overwrite").text(path)
        return
    dealt = lines.repartition("entity").sortWithinPartitions("entity", "section_no", "line_no")
    dealt.select("entity", "text").write.mode("overwrite").partitionBy("entity").text(path)


def append_contexts(calls: DataFrame, path: str) -> None:
    """Append calls (label, prompt, raw) as Markdown rows (label, text) to a log, by label; labels are made safe for paths."""
    from ..functions.text import safe_label

    text = F.concat(F.lit("## request\n"), F.coalesce("prompt", F.lit("")), F.lit("\n\n## response\n"), F.coalesce("raw", F.lit("")))
    calls.select(safe_label(F.col("label")).alias("label"), text.alias("text")).write.mode("append").partitionBy("label").json(path)


def write_json(rows: DataFrame, path: str, *keys: str) -> None:
    """JSON lines, in folders by ``keys``."""
    w = rows.write.mode("overwrite")
    (w.partitionBy(*keys) if keys else w).json(path)


def append_usage(calls: DataFrame, path: str) -> None:
    """Append calls (label, version, in, out, ..) with their cost to the usage log."""
    from ..operators.state import call_cost

    calls.withColumn("cost", call_cost(F.col("in"), F.col("out"))).write.mode("append").json(path)


def cache_once(rows: DataFrame, path: str) -> DataFrame:
    """Read-through cache: written if nothing is there, then read."""
    rows.write.mode("ignore").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
