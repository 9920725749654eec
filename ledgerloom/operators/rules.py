"""Deterministic rules: phrase scans, period comparisons, share shifts, divergences, rerating signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Phrases that the scans look for (fixed values), any case.
PHRASES = {
    "competition": ["pricing pressure", "competitive environment", "market share", "new entrants", "competitor", "competitive dynamics", "increased competition", "competitive headwinds"],
    "finance": ["recurring revenue", "visibility", "platform transformation", "lifetime value", "operating leverage", "margin expansion", "annualized run rate", "contracted backlog"],
    "unusual": ["securitization", "factoring", "sale-leaseback", "synthetic lease", "special purpose", "variable interest entity", "off-balance", "non-GAAP", "adjusted", "excluding", "accelerated", "deferred", "channel stuffing", "bill-and-hold"],
    "supply_structure": ["Suppliers", "Raw Materials", "Sources of Supply", "Procurement", "Single-source", "Sole-source"],
    "supply_risk": ["supply chain", "supplier", "raw material", "single source", "geopolitical", "tariff", "trade restriction", "shortage", "rare earth", "titanium", "nickel", "aluminum", "semiconductor"],
    "supply_impact": ["supply chain", "supplier", "raw material", "inflation", "cost headwind", "price increase", "availability"],
    "supply_commitment": ["purchase commitment", "take-or-pay", "long-term supply", "minimum purchase", "supply agreement"],
}


def phrase_hits(docs: DataFrame, phrases: list[str] | dict[str, list[str]], keys: list[str]) -> DataFrame:
    """(keys.., phrase, n): how often each phrase is in the text, any case, where it is at all; of several lists (list, ..) too.

    One pass, whatever the number of lists."""
    low, size = F.col("__low"), F.char_length("__low")
    lists = phrases if isinstance(phrases, dict) else {"": phrases}
    times = lambda p: F.when(low.contains(p), ((size - F.char_length(F.replace(low, F.lit(p), F.lit("")))) / len(p)).cast("long")).otherwise(F.lit(0).cast("long"))
    found = F.array(*[F.struct(F.lit(k).alias("list"), F.lit(p).alias("phrase"), times(p.lower()).alias("n")) for k, ps in lists.items() for p in ps])
    out = docs.select(*keys, F.lower("text").alias("__low")).select(*keys, F.explode(F.filter(found, lambda x: x["n"] > 0)).alias("f"))
    return out.select(*keys, *(["f.list"] if isinstance(phrases, dict) else []), "f.phrase", "f.n")


def period_status(now: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """(keys.., status): new, removed or unchanged against the period before; one full outer join of distinct keys."""
    a, b = now.select(*keys).distinct().withColumn("__now", F.lit(True)), before.select(*keys).distinct().withColumn("__then", F.lit(True))
    both = a.join(b, keys, "full_outer")
    return both.select(*keys, F.when(F.col("__then").isNull(), "new").when(F.col("__now").isNull(), "removed").otherwise("unchanged").alias("status"))


def narrative_momentum(counts: DataFrame, entity: str, period: str) -> DataFrame:
    """(.., early, mature) with deltas to the period before and their direction; growth of either is looked at first."""
    w = Window.partitionBy(entity).orderBy(period)
    e, m = F.col("early") - F.lag("early").over(w), F.col("mature") - F.lag("mature").over(w)
    rows = counts.withColumn("early_delta", e).withColumn("mature_delta", m)
    e, m = F.col("early_delta"), F.col("mature_delta")
    return rows.withColumn("direction", F.when((m > 0) | (e > 0), "accelerating").when((m == 0) & (e == 0), "stable").when((m < 0) | (e < 0), "decelerating"))


def share_shift(values: DataFrame, segment: str, year: str, val: str, big: float = 15.0, small: float = 5.0) -> DataFrame:
    """(segment, year, share, shift, kind): percent of the year's whole, its change over two years, and whether that is
    structural (over ``big`` points) or stable (under ``small``)."""
    totals = values.groupBy(year, segment).agg(F.sum(val).alias("__v"))
    whole = F.sum("__v").over(Window.partitionBy(year))
    rows = totals.withColumn("share", F.round(F.col("__v") / F.nullif(whole, F.lit(0.0)) * 100, 1))
    then = F.max("share").over(Window.partitionBy(segment).orderBy(year).rangeBetween(-2, -2))
    rows = rows.withColumn("shift", F.round(F.col("share") - then, 1))
    kind = F.when(F.abs("shift") > big, "structural").when(F.abs("shift") < small, "stable").when(F.col("shift").isNotNull(), "moving")
    return rows.withColumn("kind", kind).drop("__v")


def growth_divergence(rows: DataFrame, entity: str, period: str, item: str, revenue: str, run: int = 2) -> DataFrame:
    """Rows with the growth of an item and of revenue over the period before, whether the item outgrows revenue, for how
    many periods in a row, and whether that is a warning (``run`` or more)."""
    w = Window.partitionBy(entity).orderBy(period)
    grow = lambda c: (F.col(c) - F.lag(c).over(w)) / F.nullif(F.lag(c).over(w), F.lit(0.0))
    d = rows.withColumn("item_growth", F.round(grow(item) * 100, 1)).withColumn("revenue_growth", F.round(grow(revenue) * 100, 1))
    d = d.withColumn("faster", F.coalesce(F.col("item_growth") > F.col("revenue_growth"), F.lit(False)))
    d = d.withColumn("__island", F.sum((~F.col("faster")).cast("int")).over(w))
    d = d.withColumn("run", F.sum(F.col("faster").cast("long")).over(Window.partitionBy(entity, "__island").orderBy(period)))
    return d.withColumn("warning", F.col("run") >= run).drop("__island")


def jumps(annual: DataFrame, least: float = 20.0) -> DataFrame:
    """Annual rows whose value moved by more than ``least`` percent within a year."""
    from .facts import annual_growth

    return annual_growth(annual).where(F.abs("yoy_pct") > least)


def rerating(signals: DataFrame) -> DataFrame:
    """(.., quality, narrative, emerging) from counts: bullish without any bearish and without a cash-flow contradiction;
    three mature phrases; or else a growing narrative."""
    q = (F.col("bullish") > F.col("bearish")) & (F.col("bearish") == 0) & ~F.coalesce(F.col("cashflow_bearish"), F.lit(False))
    n = F.coalesce(F.col("mature") >= 3, F.lit(False))
    return signals.withColumn("quality", q).withColumn("narrative", n).withColumn("emerging", ~n & F.coalesce(F.col("direction") == "accelerating", F.lit(False)))


def quality_flags(changed: Column, likelihood: Column, sbc_pct: Column, off_balance: Column) -> Column:
    """Names of the flags that a financial summary earns."""
    return F.array_compact(F.array(
        F.when(changed, "revenue_recognition_changed"), F.when(likelihood == "high", "high_contingency"), F.when(sbc_pct > 10, "dilution"), F.when(F.coalesce(off_balance, F.lit(0.0)) > 0, "off_balance_sheet"),
    ))


def top_k(counts: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k rows of highest ``n`` per group, ties by topic; groups of any size are cut before they are shuffled."""
    w = Window.partitionBy(*by).orderBy(F.col("n").desc(), "topic")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def capex_effect(annual: DataFrame, flat: float = 1.0) -> DataFrame:
    """(entity, year, signal) of years in which capital expenditure grew, by what follows: bullish if revenue and the margin
    grow in the next year or the one behind it; bearish if revenue stays within ``flat`` percent and the margin falls; else neutral.

    annual: (entity, year, capex, revenue, margin)."""
    by = Window.partitionBy("entity").orderBy("year")
    at = lambda c, k: F.max(c).over(by.rangeBetween(k, k))
    grown = lambda k: (at("revenue", k) > F.col("revenue")) & (at("margin", k) > F.col("margin"))
    change = (at("revenue", 1) - F.col("revenue")) / F.nullif(F.col("revenue"), F.lit(0.0)) * 100
    bear = (F.abs(change) <= flat) & (at("margin", 1) < F.col("margin"))
    good = F.coalesce(grown(1), F.lit(False)) | F.coalesce(grown(2), F.lit(False))
    signal = F.when(good, "bullish").when(F.coalesce(bear, F.lit(False)), "bearish").otherwise("neutral")
    return annual.withColumn("__before", at("capex", -1)).withColumn("signal", signal).where("capex > __before").select("entity", "year", "signal")


def structure_changing(segments: DataFrame, points: float = 5.0, years: int = 2) -> DataFrame:
    """(entity, result): whether a segment of high margin quality that rises gained over ``points`` of share in ``years`` years.

    segments: (entity, segment, year, share, margin_quality, direction); the last year's quality and direction count."""
    by = Window.partitionBy("entity", "segment").orderBy("year")
    rows = segments.withColumn("__then", F.max("share").over(by.rangeBetween(-years, -years))).withColumn("__last", F.max("year").over(Window.partitionBy("entity")))
    hit = (F.col("year") == F.col("__last")) & (F.col("margin_quality") == "high") & (F.col("direction") == "rising") & (F.col("share") - F.col("__then") > points)
    return rows.groupBy("entity").agg(F.coalesce(F.bool_or(hit), F.lit(False)).alias("result"))


def rerate_assembly(structure: Column, quality: Column, narrative: Column, emerging: Column, *insufficient: Column) -> Column:
    """The three conditions as one struct; insufficient if any of them is."""
    cond = lambda r, e: F.struct(F.coalesce(r, F.lit(False)).alias("result"), F.coalesce(e, F.lit(False)).alias("emerging"))
    lacking = F.lit(False)
    for x in insufficient:
        lacking = lacking | F.coalesce(x, F.lit(False))
    return F.struct(cond(structure, F.lit(False)).alias("structure_changing"), cond(quality, F.lit(False)).alias("quality_changing"), cond(narrative, emerging).alias("narrative_changing"), lacking.alias("insufficient_data"))


def unusual_candidates(results: DataFrame) -> DataFrame:
    """(entity, kind, item): what may be unusual by the notes' and the financial summary's results (entity, result): red flags,
    off-balance and related-party amounts, a changed revenue policy, quality flags, anomalies."""
    lists = {"red_flag": "$.notes.red_flags", "quality_flag": "$.financial.quality_flags", "anomaly": "$.financial.anomalies"}
    one = lambda k, x: F.struct(F.lit(k).alias("kind"), x.alias("item"))
    none = F.array().cast("array<struct<kind:string,item:string>>")
    listed = lambda k, p: F.transform(F.from_json(F.get_json_object("result", p), "array<string>"), lambda x: one(k, x))
    found = [F.coalesce(listed(k, p), none) for k, p in lists.items()]
    amount = lambda p: F.nullif(F.get_json_object("result", p), F.lit(""))
    for k, p in (("off_balance_sheet", "$.notes.off_balance_sheet.amount"), ("related_party", "$.notes.related_party.amount")):
        found.append(F.when(amount(p).isNotNull(), F.array(one(k, amount(p)))).otherwise(none))
    changed = F.get_json_object("result", "$.notes.revenue_recognition.changed") == "true"
    found.append(F.when(changed, F.array(one("revenue_recognition", F.coalesce(amount("$.notes.revenue_recognition.change_detail"), F.lit("changed"))))).otherwise(none))
    return results.select("entity", F.explode(F.concat(*found)).alias("f")).select("entity", "f.*")


def mdna_realized(risks: DataFrame, mdna: DataFrame) -> DataFrame:
    """The risks (entity, title, ..) with whether the entity's MD&A (entity, text) speaks of them by that title, any case."""
    rows = risks.join(mdna.select("entity", F.lower("text").alias("__t")), "entity", "left")
    return rows.withColumn("mdna_realized", F.coalesce(F.col("__t").contains(F.lower("title")), F.lit(False))).drop("__t")
