"""Annual and quarterly metrics over the flat fact relation.

Facts: entity, metric, concept_pos, entry_pos, form, fp, fy, start_date, end_date, val, filed (see sources.tables and
``with_metrics``). All latest/first choices have a total order and are aggregates, so they combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans import dims


def metric_map(spark, concepts: dict[str, list[str]]) -> DataFrame:
    """(metric, concept, concept_pos, unit): a dozen rows."""
    rows = [(m, c, i, "shares" if m == "SharesOutstanding" else "USD") for m, cs in concepts.items() for i, c in enumerate(cs)]
    return spark.createDataFrame(rows, "metric STRING, concept STRING, concept_pos INT, unit STRING")


def with_metrics(facts: DataFrame, concepts: dict[str, list[str]]) -> DataFrame:
    """Facts of known concepts, in the metric's unit; a concept without USD facts falls back to its share counts."""
    m = F.broadcast(metric_map(facts.sparkSession, concepts)).withColumnRenamed("unit", "__unit")  # a dozen fixed rows
    return unit_fallback(facts.join(m, "concept"), F.col("__unit")).drop("__unit")


def unit_fallback(rows: DataFrame, wanted: Column, keys: tuple[str, ...] = ("entity", "concept")) -> DataFrame:
    """Rows in the wanted unit, or in shares where USD is wanted and the key has none."""
    has = F.max(F.col("unit") == wanted).over(Window.partitionBy(*keys))
    return rows.withColumn("__has", has).where((F.col("unit") == wanted) | (~F.col("__has") & (wanted == "USD") & (F.col("unit") == "shares"))).drop("__has")


def of_filing_type(facts: DataFrame, filing_type: str) -> DataFrame:
    forms, periods = dims.FORMS[filing_type]
    return facts.where(F.col("form").isin(forms) & F.col("fp").isin(periods))


def fact_year() -> Column:
    """The year of an instant's end; else the filing's fiscal year."""
    return F.when(F.col("start_date").isNull() & F.col("end_date").isNotNull(), F.year("end_date")).otherwise(F.col("fy"))


def annual_latest(facts: DataFrame, filing_type: str = "10-K") -> DataFrame:
    """(entity, metric, year[, fp], val, filed, first_seen): per key the latest filed; ties go to the later concept, then entry."""
    keys = ["entity", "metric", "year"] + (["fp"] if filing_type == "10-Q" else [])
    rank = F.struct("filed", "concept_pos", "entry_pos")
    rows = of_filing_type(facts, filing_type).withColumn("year", fact_year())
    return rows.groupBy(*keys).agg(F.max_by("val", rank).alias("val"), F.max(rank)["filed"].alias("filed"), F.min(rank).alias("first_seen"))


def annual_metrics(facts: DataFrame, filing_type: str = "10-K", n: int = 5) -> DataFrame:
    """The last ``n`` rows of ``annual_latest`` by filing date, per entity and metric."""
    w = Window.partitionBy("entity", "metric").orderBy(F.col("filed").desc(), F.col("first_seen").desc())
    rows = annual_latest(facts, filing_type).withColumn("recency", F.row_number().over(w)).where(F.col("recency") <= n)
    return rows.drop("first_seen")


def growth(now: Column, before: Column) -> Column:
    """Percent over before, to one decimal; null where before is missing or zero."""
    return F.round((now - before) / F.nullif(before, F.lit(0.0)) * 100, 1)


def annual_growth(annual: DataFrame) -> DataFrame:
    """Annual rows with the value of the year before (gaps stay gaps) and the growth over it; a zero counts as missing."""
    w = Window.partitionBy("entity", "metric").orderBy("year").rangeBetween(-1, -1)
    rows = annual.withColumn("prev_val", F.max("val").over(w))
    return rows.withColumn("yoy_pct", F.when(F.col("val") != 0, growth(F.col("val"), F.col("prev_val"))))


def quarter_label(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def quarter_candidates(facts: DataFrame) -> DataFrame:
    """Single quarters (60 to 100 days) and whole fiscal years (340 to 380 days, as Q4), from unamended forms with both dates."""
    days = F.datediff("end_date", "start_date")
    single, whole = days.between(*dims.QUARTER_DAYS), days.between(*dims.ANNUAL_DAYS) & (F.col("fp") == "FY")
    rows = facts.where(F.col("form").isin("10-Q", "10-K") & F.col("start_date").isNotNull() & F.col("end_date").isNotNull())
    rows = rows.withColumn("is_annual", F.when(single, False).when(whole, True)).where(F.col("is_annual").isNotNull())
    return rows.withColumn("label", F.when(F.col("is_annual"), F.concat(F.year("end_date").cast("string"), F.lit("Q4"))).otherwise(quarter_label(F.col("end_date"))))


def first_concept(rows: DataFrame) -> DataFrame:
    """Only the rows of the first concept that has any, per entity and metric."""
    best = F.min("concept_pos").over(Window.partitionBy("entity", "metric"))
    return rows.withColumn("__best", best).where(F.col("concept_pos") == F.col("__best")).drop("__best")


def quarter_first(rows: DataFrame) -> DataFrame:
    """One row per (entity, metric, label, val), the first filed in source order with its flag."""
    first = F.min(F.struct("entry_pos", "is_annual", "end_date"))
    return rows.groupBy("entity", "metric", "label", "val").agg(first.alias("f")).select("entity", "metric", "label", "val", "f.*")


def quarter_series(facts: DataFrame) -> DataFrame:
    """(entity, metric, label, val): single quarters, the last by end date per label."""
    rows = quarter_first(first_concept(quarter_candidates(facts))).where(~F.col("is_annual"))
    return rows.groupBy("entity", "metric", "label").agg(F.max_by("val", F.struct("end_date", "entry_pos")).alias("val"))


def quarter_wide(facts: DataFrame) -> DataFrame:
    """(entity, quarter, revenue, op_income, net_income) of quarters with both revenue and net income, one shuffle."""
    of = lambda m: F.max(F.when(F.col("metric") == m, F.col("val")))
    wide = quarter_series(facts).groupBy("entity", "label").agg(of("Revenue").alias("revenue"), of("OperatingIncome").alias("op_income"), of("NetIncome").alias("net_income"))
    return wide.withColumnRenamed("label", "quarter")


def quarterly_metrics(facts: DataFrame, n: int = 5) -> DataFrame:
    """(entity, quarter, revenue, rev_growth_yoy, op_margin, net_margin) of the last ``n`` quarters.

    Growth is over the same quarter of the year before, anywhere in the history, not over the row before."""
    wide = quarter_wide(facts).withColumn("__y", F.substring("quarter", 1, 4).cast("int")).withColumn("__q", F.substring("quarter", 6, 1))
    prev = F.max("revenue").over(Window.partitionBy("entity", "__q").orderBy("__y").rangeBetween(-1, -1))
    rows = wide.withColumn("prev_revenue", prev).where(F.col("revenue").isNotNull() & F.col("net_income").isNotNull())
    last = Window.partitionBy("entity").orderBy(F.col("quarter").desc())
    rows = rows.withColumn("__k", F.row_number().over(last)).where(F.col("__k") <= n)
    margin = lambda x: F.round(F.col(x) / F.nullif(F.col("revenue"), F.lit(0.0)) * 100, 1)
    return rows.select("entity", "quarter", "revenue", growth(F.col("revenue"), F.col("prev_revenue")).alias("rev_growth_yoy"), margin("op_income").alias("op_margin"), margin("net_income").alias("net_margin"))


def series_precedence(series: DataFrame) -> DataFrame:
    """Of (entity, metric, year, val, priority) the rows of the first priority that has any value, whole series at a time."""
    best = F.min(F.when(F.col("val").isNotNull(), F.col("priority"))).over(Window.partitionBy("entity", "metric"))
    return series.withColumn("__best", best).where(F.col("priority") == F.col("__best")).drop("__best")


def report_metrics(annual: DataFrame) -> DataFrame:
    """(entity, year, metric, val): raw metrics and derived ratios, a missing or zero operand giving null."""
    of = lambda m: F.max(F.when(F.col("metric") == m, F.col("val"))).alias(m)
    raw = ["Revenue", "OperatingIncome", "NetIncome", "OperatingCashFlow", "CapEx", "LongTermDebt", "SharesOutstanding"]
    wide = annual.groupBy("entity", "year").agg(*[of(m) for m in raw])
    some = lambda c: F.nullif(F.col(c), F.lit(0.0))
    w = Window.partitionBy("entity").orderBy("year").rangeBetween(-1, -1)
    prev = lambda c: F.nullif(F.max(c).over(w), F.lit(0.0))
    derived = {
        "rev_yoy": F.round((some("Revenue") - prev("Revenue")) / prev("Revenue") * 100, 1),
        "ni_yoy": F.round((some("NetIncome") - prev("NetIncome")) / prev("NetIncome") * 100, 1),
        "op_margin": F.round(some("OperatingIncome") / some("Revenue") * 100, 1),
        "net_margin": F.round(some("NetIncome") / some("Revenue") * 100, 1),
        "fcf_to_revenue": F.round((some("OperatingCashFlow") - F.coalesce("CapEx", F.lit(0.0))) / some("Revenue") * 100, 1),
        "capex_to_revenue": F.round(some("CapEx") / some("Revenue") * 100, 1),
    }
    wide = wide.withColumns(derived)
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("val")) for m in raw + list(derived)])
    return wide.select("entity", "year", F.explode(pairs).alias("p")).select("entity", "year", "p.metric", "p.val")


def metric_table(metrics: DataFrame, years: list[int]) -> DataFrame:
    """Metrics by year as columns y<year>; the years are given, so no pass is needed to find them."""
    out = metrics.groupBy("entity", "metric").pivot("year", years).agg(F.max("val"))
    return out.select("entity", "metric", *[F.col(str(y)).alias(f"y{y}") for y in years])


def first_filing(index: DataFrame, form: str, year: int, quarter: int | None = None) -> DataFrame:
    """Per entity the first filing in source order of a form (or its amendment) filed in the year or the next; for a
    10-Q also of the calendar quarter of its report."""
    rows = index.where(F.col("form").isin(form, f"{form}/A") & F.substring("filingDate", 1, 4).cast("int").isin(year, year + 1))
    if form == "10-Q" and quarter:
        rows = rows.where(F.quarter(F.to_date("reportDate")) == quarter)
    return rows.groupBy("entity").agg(F.min_by(F.struct(*index.columns), "pos").alias("f")).select("f.*")


def prior_period(year: Column, filing_type: Column, quarter: Column, override: Column | None = None) -> Column:
    """struct(year, filing_type, quarter) of the period that a filing is compared with."""
    o = F.lit(None).cast("int") if override is None else override
    annual = F.struct(F.coalesce(o, year - 1).alias("year"), F.lit("10-K").alias("filing_type"), F.lit(None).cast("string").alias("quarter"))
    before = lambda q: F.struct(F.coalesce(o, year).alias("year"), F.lit("10-Q").alias("filing_type"), F.lit(q).alias("quarter"))
    return F.when((filing_type == "10-K") | (quarter == "Q1"), annual).when(quarter == "Q2", before("Q1")).when(quarter == "Q3", before("Q2"))


def lookup_entity(wanted: DataFrame, names: DataFrame) -> DataFrame:
    """(ticker, cik): upper-cased tickers with the first of their numbers, padded to ten digits; null if unknown."""
    first = names.groupBy(F.upper("ticker").alias("ticker")).agg(F.min_by("cik", "pos").alias("cik"))
    return wanted.select(F.upper(F.trim("ticker")).alias("ticker")).join(first, "ticker", "left").withColumn("cik", F.lpad(F.col("cik").cast("string"), 10, "0"))
