"""Blocks of a report whose lines need more than a template (see ``layouts``), and lists of results as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blockquote, substituted
from ..plans import dims


#: Fixed values of the report.
NO_CONCERNS = "（本季無市場關注議題記錄）"
_LEVEL = {"high": "高", "medium": "中", "low": "低"}
_AGAINST = {"intensifying": "加劇", "stable": "持平", "easing": "緩解"}
_CATEGORY = {"concentration": "集中", "geopolitical": "地緣", "price": "價格", "shortage": "短缺", "logistics": "物流", "regulatory": "法規"}


def soft(text: Column) -> Column:
    return substituted(text, dims.TERM_SUBSTITUTES)


def items(results: DataFrame, path: str, kind: str = "array<map<string,string>>") -> DataFrame:
    """(entity, pos, item) of a list in the results; none where it is missing or isn't a list."""
    found = F.from_json(F.get_json_object("result", path), kind)
    return results.select("entity", F.posexplode(found).alias("pos", "item"))


def concerns(results: DataFrame) -> DataFrame:
    """(entity, line_no, text): a block per topic with its frequency, the answer, the quote and signs of evasion."""
    get = lambda k: F.coalesce(F.element_at("item", k), F.lit(""))
    head = F.concat(F.lit("### "), soft(F.translate(get("topic"), "\n\r", "  ")), F.when(~get("frequency").isin("", "0"), F.concat(F.lit("（被問 "), get("frequency"), F.lit(" 次）"))).otherwise(""))
    answer = F.when(get("management_response") != "", F.concat(F.lit("**管理層回應**："), soft(get("management_response"))))
    evasion = F.when(get("evasion_signal") != "", F.concat(F.lit("迴避訊號："), soft(get("evasion_signal"))))
    text = F.concat_ws("\n\n", head, answer, F.nullif(blockquote(get("verbatim_response")), F.lit("")), evasion)
    rows = items(results, "$.market_concerns").select("entity", F.col("pos").cast("long").alias("line_no"), text.alias("text"))
    n = F.coalesce(F.size(F.from_json(F.get_json_object("result", "$.market_concerns"), "array<string>")), F.lit(0))
    return rows.unionByName(results.where(n <= 0).select("entity", F.lit(0).cast("long").alias("line_no"), F.lit(NO_CONCERNS).alias("text")))


def pressure(results: DataFrame) -> DataFrame:
    """(entity, line_no, text): competitive-pressure signals; the quote has a line of its own where there is a summary."""
    from .report import decoded

    get = lambda k: F.element_at("item", k)
    some = lambda k: F.nullif(get(k), F.lit(""))
    against = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in _AGAINST.items() for x in kv]), get("vs_prior_quarter")), F.lit("—"))
    text = F.concat(F.lit("- ["), decoded(F.coalesce(get("severity"), F.lit("")), _LEVEL), F.lit("] **"), soft(F.coalesce(some("summary_zh"), get("quote"), F.lit(""))), F.lit("** — "), F.coalesce(get("market"), F.lit("")), F.lit("（vs 上季："), against, F.lit("）"))
    quote = F.when(some("summary_zh").isNotNull() & some("quote").isNotNull(), F.concat(F.lit('  > "'), soft(get("quote")), F.lit('"')))
    return items(results, "$.competitive_pressure_signals").select("entity", F.col("pos").cast("long").alias("line_no"), F.concat_ws("\n", text, quote).alias("text"))


def supply_risks(results: DataFrame) -> DataFrame:
    """(entity, line_no, text): supply-chain risks with their decoded category."""
    from .report import decoded

    get = lambda k: F.coalesce(F.element_at("item", k), F.lit(""))
    text = F.concat(F.lit("- ["), decoded(get("category"), _CATEGORY), F.lit("] "), get("title"), F.lit("："), soft(get("summary")))
    return items(results, "$.supply_chain_risks").select("entity", F.col("pos").cast("long").alias("line_no"), text.alias("text"))


def commitments(results: DataFrame) -> DataFrame:
    """(entity, text): purchase commitments, only where they were found."""
    get = lambda k: F.get_json_object("result", f"$.purchase_commitments.{k}")
    pct = F.nullif(get("commitment_to_revenue_pct"), F.lit(""))
    text = F.concat(F.coalesce(get("total_commitment_description"), F.lit("")), F.when(pct.isNotNull(), F.concat(F.lit("（佔 Revenue 約 "), pct, F.lit("）"))).otherwise(""))
    return results.where(get("found") == "true").select("entity", text.alias("text"))


def declared(results: DataFrame) -> DataFrame:
    """(task_id, key, value): the keys that a task declares, typed as VARIANT where present."""
    keys = F.create_map(*[x for k, v in dims.REQUIRED_KEYS.items() for x in (F.lit(k), F.array(*[F.lit(s) for s in v]))])
    rows = results.select("task_id", F.explode(F.element_at(keys, F.col("task_id"))).alias("key"), F.from_json("result", "map<string,string>").alias("r"))
    return rows.select("task_id", "key", F.try_parse_json(F.element_at("r", F.col("key"))).alias("value"))
