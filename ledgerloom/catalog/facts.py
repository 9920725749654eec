"""Queries over facts, metrics and filings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import facts, report, rules
from ..plans import dims
from ..sources import tables
from . import query
from .views import duck, table, view

_CANDIDATES = "WITH a AS (SELECT *, CASE WHEN start_date IS NULL AND end_date IS NOT NULL THEN CAST(year(end_date) AS INT) ELSE fy END AS year FROM annual_v WHERE form IN ('10-K', '10-K/A') AND fp = 'FY'), r AS (SELECT *, row_number() OVER (PARTITION BY entity, metric, year ORDER BY filed DESC, concept_pos DESC, entry_pos DESC) AS k, row_number() OVER (PARTITION BY entity, metric ORDER BY filed, concept_pos, entry_pos) AS o FROM a), d AS (SELECT entity, metric, year, max(CASE WHEN k = 1 THEN val END) AS val, max(CASE WHEN k = 1 THEN filed END) AS filed, min(o) AS first_seen FROM r GROUP BY entity, metric, year)"
_LAST5 = _CANDIDATES + ", last5 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, metric ORDER BY filed DESC, first_seen DESC) AS recency FROM d) WHERE recency <= 5)"
_GROWN = _LAST5 + ", g AS (SELECT c.entity, c.metric, c.year, c.val, p.val AS prev_val, CASE WHEN c.val <> 0 THEN round((c.val - p.val) / nullif(p.val, 0) * 100, 1) END AS yoy_pct FROM last5 c LEFT JOIN last5 p ON c.entity = p.entity AND c.metric = p.metric AND c.year = p.year + 1)"


@query(duck("annual_v", then="SELECT entry_pos, form, fp FROM annual_v WHERE form IN ('10-K', '10-K/A') AND fp = 'FY'"))
def facts_form_filter(spark: SparkSession, sf: str) -> DataFrame:
    return facts.of_filing_type(view(spark, sf, "annual_v"), "10-K").select("entry_pos", "form", "fp")


@query(duck("facts_v", then="SELECT entry_pos, CAST(CASE WHEN start_date IS NULL AND end_date IS NOT NULL THEN year(end_date) ELSE fy END AS INT) AS year FROM facts_v"))
def facts_year_derive(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "facts_v").select("entry_pos", facts.fact_year().cast("int").alias("year"))


@query(duck("units_v", then="SELECT entity, concept, unit, count(*) AS n, max(val) AS max_val FROM (SELECT *, max(CASE WHEN unit = 'USD' THEN 1 ELSE 0 END) OVER (PARTITION BY entity, concept) AS has FROM units_v) WHERE unit = 'USD' OR (has = 0 AND unit = 'shares') GROUP BY entity, concept, unit"))
def unit_fallback(spark: SparkSession, sf: str) -> DataFrame:
    rows = facts.unit_fallback(view(spark, sf, "units_v"), F.lit("USD"))
    return rows.groupBy("entity", "concept", "unit").agg(F.count(F.lit(1)).alias("n"), F.max("val").alias("max_val"))


_MAP = ", ".join(f"('{m}', '{c}', {i}, '{'shares' if m == 'SharesOutstanding' else 'USD'}')" for m, cs in dims.ANNUAL_CONCEPTS.items() for i, c in enumerate(cs))


@query(duck("units_v", then=f"WITH m(metric, concept, concept_pos, wanted) AS (VALUES {_MAP}), j AS (SELECT u.*, m.metric, m.concept_pos, m.wanted, max(CASE WHEN u.unit = m.wanted THEN 1 ELSE 0 END) OVER (PARTITION BY entity, u.concept) AS has FROM units_v u JOIN m ON u.concept = m.concept) SELECT entity, metric, CAST(concept_pos AS INT) AS concept_pos, unit, count(*) AS n, max(val) AS max_val FROM j WHERE unit = wanted OR (has = 0 AND wanted = 'USD' AND unit = 'shares') GROUP BY ALL"))
def metric_concept_join(spark: SparkSession, sf: str) -> DataFrame:
    rows = facts.with_metrics(view(spark, sf, "units_v"), dims.ANNUAL_CONCEPTS)
    return rows.groupBy("entity", "metric", "concept_pos", "unit").agg(F.count(F.lit(1)).alias("n"), F.max("val").alias("max_val"))


@query(duck("units_v", then="SELECT entity, concept, unit, count(*) AS n, max(val) AS max_val FROM units_v GROUP BY ALL"))
def facts_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Nested company facts, as the source has them, flattened again."""
    u = view(spark, sf, "units_v").withColumn("e", F.expr("named_struct('form', '10-K', 'fp', 'FY', 'fy', 2020, 'start', '', 'end', '2020-12-31', 'val', val, 'filed', string(null))"))
    entries = u.groupBy("entity", "concept", "unit").agg(F.collect_list("e").alias("es"))
    units = entries.groupBy("entity", "concept").agg(F.map_from_entries(F.collect_list(F.struct("unit", "es"))).alias("units"))
    nested = units.groupBy("entity").agg(F.map_from_entries(F.collect_list(F.struct(F.col("concept"), F.struct("units")))).alias("us-gaap"))
    flat = tables.flatten_facts(nested.select("entity", F.struct(F.col("`us-gaap`")).alias("facts")))
    return flat.groupBy("entity", "concept", "unit").agg(F.count(F.lit(1)).alias("n"), F.max("val").alias("max_val"))


@query(duck("annual_v", then=_CANDIDATES + " SELECT entity, metric, year, val, filed FROM d"))
def annual_dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return facts.annual_latest(view(spark, sf, "annual_v")).select("entity", "metric", "year", "val", "filed")


@query(duck("annual_v", then=_LAST5 + " SELECT entity, metric, year, val FROM last5"))
def annual_last5(spark: SparkSession, sf: str) -> DataFrame:
    return facts.annual_metrics(view(spark, sf, "annual_v")).select("entity", "metric", "year", "val")


@query(duck("annual_v", then=_GROWN + " SELECT * FROM g"))
def annual_yoy(spark: SparkSession, sf: str) -> DataFrame:
    return facts.annual_growth(facts.annual_metrics(view(spark, sf, "annual_v"))).select("entity", "metric", "year", "val", "prev_val", "yoy_pct")


@query(duck("annual_v", then=_GROWN + " SELECT entity, metric, year, yoy_pct FROM g WHERE abs(yoy_pct) > 20"))
def yoy_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    return rules.jumps(facts.annual_metrics(view(spark, sf, "annual_v"))).select("entity", "metric", "year", "yoy_pct")


@query(duck("annual_v", then=_LAST5 + " SELECT entity, year, max(year) OVER (PARTITION BY entity) AS current_year FROM (SELECT DISTINCT entity, year FROM last5 WHERE val IS NOT NULL)"))
def distinct_years(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql.window import Window

    years = facts.annual_metrics(view(spark, sf, "annual_v")).where("val is not null").select("entity", "year").distinct()
    return years.withColumn("current_year", F.max("year").over(Window.partitionBy("entity")))


_SPAN = "WITH c AS (SELECT *, date_diff('day', start_date, end_date) AS days FROM facts_v WHERE form IN ('10-Q', '10-K') AND start_date IS NOT NULL AND end_date IS NOT NULL), q AS (SELECT entity, metric, concept_pos, entry_pos, end_date, val, CASE WHEN days BETWEEN 60 AND 100 THEN year(end_date) || 'Q' || quarter(end_date) ELSE year(end_date) || 'Q4' END AS label, NOT (days BETWEEN 60 AND 100) AS is_annual FROM c WHERE days BETWEEN 60 AND 100 OR (days BETWEEN 340 AND 380 AND fp = 'FY'))"
_FIRST = _SPAN + ", b AS (SELECT *, min(concept_pos) OVER (PARTITION BY entity, metric) AS best FROM q), f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, metric, label, val ORDER BY entry_pos) AS k FROM b WHERE concept_pos = best) WHERE k = 1)"
_SERIES = _FIRST + ", s AS (SELECT entity, metric, label, val FROM (SELECT *, row_number() OVER (PARTITION BY entity, metric, label ORDER BY end_date DESC, entry_pos DESC) AS j FROM f WHERE NOT is_annual) WHERE j = 1)"
_WIDE = _SERIES + ", w AS (SELECT r.entity, r.label AS quarter, r.val AS revenue, o.val AS op_income, n.val AS net_income FROM s r JOIN s n ON n.metric = 'NetIncome' AND n.entity = r.entity AND n.label = r.label LEFT JOIN s o ON o.metric = 'OperatingIncome' AND o.entity = r.entity AND o.label = r.label WHERE r.metric = 'Revenue'), p AS (SELECT w.*, b.val AS prev_revenue, row_number() OVER (PARTITION BY w.entity ORDER BY w.quarter DESC) AS k FROM w LEFT JOIN s b ON b.metric = 'Revenue' AND b.entity = w.entity AND b.label = CAST(CAST(substr(w.quarter, 1, 4) AS INT) - 1 AS VARCHAR) || substr(w.quarter, 5))"
_QUARTERLY = _WIDE + ", m AS (SELECT entity, quarter, revenue, round((revenue - prev_revenue) / nullif(prev_revenue, 0) * 100, 1) AS rev_growth_yoy, round(op_income / nullif(revenue, 0) * 100, 1) AS op_margin, round(net_income / nullif(revenue, 0) * 100, 1) AS net_margin FROM p WHERE k <= 5)"


@query(duck("facts_v", then=_SPAN + " SELECT entry_pos, label, is_annual FROM q"))
def facts_quarter_span(spark: SparkSession, sf: str) -> DataFrame:
    return facts.quarter_candidates(view(spark, sf, "facts_v")).select("entry_pos", "label", "is_annual")


@query(duck("facts_v", then=_SPAN + " SELECT entity, metric, min(concept_pos) AS concept_pos, count(*) FILTER (concept_pos = best) AS n FROM (SELECT *, min(concept_pos) OVER (PARTITION BY entity, metric) AS best FROM q) GROUP BY entity, metric"))
def first_nonempty_concept(spark: SparkSession, sf: str) -> DataFrame:
    rows = facts.first_concept(facts.quarter_candidates(view(spark, sf, "facts_v")))
    return rows.groupBy("entity", "metric").agg(F.min("concept_pos").alias("concept_pos"), F.count(F.lit(1)).alias("n"))


@query(duck("facts_v", then=_FIRST + " SELECT entity, metric, label, val, entry_pos, is_annual FROM f"))
def quarter_dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = facts.quarter_first(facts.first_concept(facts.quarter_candidates(view(spark, sf, "facts_v"))))
    return rows.select("entity", "metric", "label", "val", "entry_pos", "is_annual")


@query(duck("facts_v", then=_SERIES + " SELECT entity, label FROM s WHERE metric = 'Revenue' INTERSECT SELECT entity, label FROM s WHERE metric = 'NetIncome'"))
def quarter_intersect(spark: SparkSession, sf: str) -> DataFrame:
    s = facts.quarter_series(view(spark, sf, "facts_v"))
    return s.where("metric = 'Revenue'").select("entity", "label").intersect(s.where("metric = 'NetIncome'").select("entity", "label"))


@query(duck("facts_v", then=_WIDE + " SELECT entity, quarter, revenue, prev_revenue, round((revenue - prev_revenue) / nullif(prev_revenue, 0) * 100, 1) AS growth FROM p"))
def quarter_yoy(spark: SparkSession, sf: str) -> DataFrame:
    """By a self-join on the key a year back (the metrics query uses a range window)."""
    w = facts.quarter_wide(view(spark, sf, "facts_v"))
    before = w.select(F.col("entity"), F.concat((F.substring("quarter", 1, 4).cast("int") + 1).cast("string"), F.substring("quarter", 5, 2)).alias("quarter"), F.col("revenue").alias("prev_revenue"))
    rows = w.where("revenue is not null and net_income is not null").join(before, ["entity", "quarter"], "left")
    return rows.select("entity", "quarter", "revenue", "prev_revenue", facts.growth(F.col("revenue"), F.col("prev_revenue")).alias("growth"))


@query(duck("facts_v", then=_WIDE + " SELECT entity, quarter, k AS recency FROM p WHERE k <= 5"))
def quarter_lastn(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql.window import Window

    w = facts.quarter_wide(view(spark, sf, "facts_v")).where("revenue is not null and net_income is not null")
    k = F.row_number().over(Window.partitionBy("entity").orderBy(F.col("quarter").desc())).cast("long")
    return w.select("entity", "quarter", k.alias("recency")).where("recency <= 5")


@query(duck("facts_v", then=_QUARTERLY + " SELECT * FROM m"))
def quarterly_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return facts.quarterly_metrics(view(spark, sf, "facts_v"))


@query(duck("facts_v", then=_QUARTERLY + " SELECT entity, quarter, unnest(['rev_growth_yoy', 'op_margin', 'net_margin']) AS series, unnest([rev_growth_yoy, op_margin, net_margin]) AS val FROM m WHERE entity IN (SELECT entity FROM m GROUP BY entity HAVING count(*) >= 2)"))
def chart_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Three series of quarterly ratios, for entities with two quarters or more."""
    from pyspark.sql.window import Window

    m = facts.quarterly_metrics(view(spark, sf, "facts_v")).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("entity"))).where("n >= 2")
    return m.unpivot(["entity", "quarter"], ["rev_growth_yoy", "op_margin", "net_margin"], "series", "val")


@query(duck("annual_v", then=_LAST5 + ", s AS (SELECT entity, metric, year, CASE WHEN entity % 3 = 0 THEN NULL ELSE val END AS val, 0 AS priority FROM last5 WHERE metric <> 'CapEx' UNION ALL SELECT entity, metric, year, val + 1, 1 FROM last5), b AS (SELECT *, min(CASE WHEN val IS NOT NULL THEN priority END) OVER (PARTITION BY entity, metric) AS best FROM s) SELECT entity, metric, year, val, priority FROM b WHERE priority = best"))
def series_precedence(spark: SparkSession, sf: str) -> DataFrame:
    a = facts.annual_metrics(view(spark, sf, "annual_v"))
    first = a.where("metric <> 'CapEx'").select("entity", "metric", "year", F.when(F.col("entity") % 3 != 0, F.col("val")).alias("val"), F.lit(0).alias("priority"))
    second = a.select("entity", "metric", "year", (F.col("val") + 1).alias("val"), F.lit(1).alias("priority"))
    return facts.series_precedence(first.unionByName(second))


_REPORT = _LAST5 + """, x AS (SELECT entity, year, max(CASE WHEN metric = 'Revenue' THEN val END) AS r, max(CASE WHEN metric = 'OperatingIncome' THEN val END) AS oi, max(CASE WHEN metric = 'NetIncome' THEN val END) AS ni, max(CASE WHEN metric = 'OperatingCashFlow' THEN val END) AS ocf, max(CASE WHEN metric = 'CapEx' THEN val END) AS cx, max(CASE WHEN metric = 'LongTermDebt' THEN val END) AS ltd, max(CASE WHEN metric = 'SharesOutstanding' THEN val END) AS sh FROM last5 GROUP BY entity, year),
 y AS (SELECT c.*, nullif(p.r, 0) AS pr, nullif(p.ni, 0) AS pni FROM x c LEFT JOIN x p ON p.entity = c.entity AND p.year = c.year - 1),
 z AS (SELECT entity, year, unnest(['Revenue', 'OperatingIncome', 'NetIncome', 'OperatingCashFlow', 'CapEx', 'LongTermDebt', 'SharesOutstanding', 'rev_yoy', 'ni_yoy', 'op_margin', 'net_margin', 'fcf_to_revenue', 'capex_to_revenue']) AS metric, unnest([r, oi, ni, ocf, cx, ltd, sh, round((nullif(r, 0) - pr) / pr * 100, 1), round((nullif(ni, 0) - pni) / pni * 100, 1), round(nullif(oi, 0) / nullif(r, 0) * 100, 1), round(nullif(ni, 0) / nullif(r, 0) * 100, 1), round((nullif(ocf, 0) - coalesce(cx, 0)) / nullif(r, 0) * 100, 1), round(nullif(cx, 0) / nullif(r, 0) * 100, 1)]) AS val FROM y)"""
_YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]


@query(duck("annual_v", then=_REPORT + " SELECT * FROM z"))
def report_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return facts.report_metrics(facts.annual_metrics(view(spark, sf, "annual_v")))


@query(duck("annual_v", then=_REPORT + " SELECT entity, metric, " + ", ".join(f"max(CASE WHEN year = {y} THEN val END) AS y{y}" for y in _YEARS) + " FROM z GROUP BY entity, metric"))
def financial_table(spark: SparkSession, sf: str) -> DataFrame:
    return facts.metric_table(facts.report_metrics(facts.annual_metrics(view(spark, sf, "annual_v"))), _YEARS)


_FORM = {"money": "CASE WHEN {v} IS NULL THEN '—' WHEN abs({v}) >= 1e9 THEN '$' || format('{{:,.1f}}', {v} / 1e9) || 'B' WHEN abs({v}) >= 1e6 THEN '$' || format('{{:,.0f}}', {v} / 1e6) || 'M' ELSE format('{{:,.0f}}', {v}) END", "shares": "CASE WHEN {v} IS NULL THEN '—' WHEN abs({v}) >= 1e6 THEN format('{{:,.1f}}', {v} / 1e6) || 'M' ELSE format('{{:,.0f}}', {v}) END", "signed": "CASE WHEN {v} IS NULL THEN '—' ELSE format('{{:+.1f}}%', {v}) END", "percent": "CASE WHEN {v} IS NULL THEN '—' ELSE format('{{:.1f}}%', {v}) END"}
_LINE = " UNION ALL ".join(f"SELECT entity, 0 AS section_no, CAST({i} AS BIGINT) AS line_no, '| {label} | ' || " + " || ' | ' || ".join(_FORM[form].format(v=f"y{y}") for y in _YEARS) + f" || ' |' AS text FROM w WHERE metric = '{m}'" for i, (m, label, form) in enumerate(dims.REPORT_ROWS, 1))
_HEAD = f"SELECT DISTINCT entity, 0, 0, '| 指標 | {' | '.join(map(str, _YEARS))} |' || chr(10) || '|------|{'|'.join('------:' for _ in _YEARS)}|' FROM w"
_WIDE_YEARS = ", ".join(f"max(CASE WHEN year = {y} THEN val END) AS y{y}" for y in _YEARS)
_QLINE = "SELECT entity, 1, row_number() OVER (PARTITION BY entity ORDER BY quarter), '| ' || quarter || ' | ' || " + _FORM["money"].format(v="revenue") + " || ' | ' || " + _FORM["signed"].format(v="rev_growth_yoy") + " || ' | ' || " + _FORM["percent"].format(v="op_margin") + " || ' | ' || " + _FORM["percent"].format(v="net_margin") + " || ' |' FROM m WHERE entity IN (SELECT entity FROM m GROUP BY entity HAVING count(*) >= 2)"


@query(duck("annual_v", "facts_v", then=f"SELECT * FROM ({_REPORT}, w AS (SELECT entity, metric, {_WIDE_YEARS} FROM z GROUP BY entity, metric) {_LINE} UNION ALL {_HEAD}) UNION ALL SELECT * FROM ({_QUARTERLY} {_QLINE})"))
def report_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Both tables of a report as ordered Markdown lines."""
    table_ = facts.metric_table(facts.report_metrics(facts.annual_metrics(view(spark, sf, "annual_v"))), _YEARS)
    quarters = facts.quarterly_metrics(view(spark, sf, "facts_v"))
    return report.report([report.financial_lines(table_, _YEARS), report.quarter_lines(quarters)]).orderBy("entity", "section_no", "line_no")


@query("SELECT o_custkey AS entity, min(o_orderkey) AS pos, arg_min(form, o_orderkey) AS form, arg_min(filingDate, o_orderkey) AS filing_date FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN '10-Q' WHEN 'O' THEN '10-Q/A' ELSE '8-K' END AS form, CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INT) AS VARCHAR) AS filingDate FROM orders) WHERE form IN ('10-Q', '10-Q/A') AND CAST(substr(filingDate, 1, 4) AS INT) IN (1997, 1998) AND quarter(o_orderdate) = 2 GROUP BY o_custkey")
def filing_select_first(spark: SparkSession, sf: str) -> DataFrame:
    """First 10-Q in source order for the second quarter, filed in 1997 or 1998, from struct-of-arrays indexes."""
    o = table(spark, sf, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    form = F.when(F.col("o_orderstatus") == "F", "10-Q").when(F.col("o_orderstatus") == "O", "10-Q/A").otherwise("8-K")
    o = o.select("o_custkey", "o_orderkey", form.alias("form"), F.expr("string(d + int(o_orderkey % 60))").alias("filingDate"), F.col("d").cast("string").alias("reportDate"))
    arrays = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "form", "filingDate", "reportDate"))).alias("a"))
    recent = F.struct(F.col("a.form").alias("form"), F.col("a.filingDate").alias("filingDate"), F.col("a.reportDate").alias("reportDate"), F.col("a.o_orderkey").alias("accessionNumber"), F.col("a.form").alias("primaryDocument"))
    index = tables.index_filings(arrays.select(F.col("o_custkey").alias("entity"), F.struct(recent.alias("recent")).alias("filings")))
    first = facts.first_filing(index, "10-Q", 1997, 2)
    return first.select("entity", F.col("accessionNumber").alias("pos"), "form", F.col("filingDate").alias("filing_date"))


_FILED = "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CASE WHEN o_orderkey % 3 = 0 THEN '10-K' ELSE '10-Q' END AS filing_type, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Q' || (1 + o_orderkey % 3) END AS quarter FROM orders"


def _filed(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    annual = F.col("o_orderkey") % 3 == 0
    return o.select("o_orderkey", F.year("o_orderdate").alias("year"), F.when(annual, "10-K").otherwise("10-Q").alias("filing_type"), F.when(~annual, F.concat(F.lit("Q"), (1 + F.col("o_orderkey") % 3).cast("string"))).alias("quarter"))


@query(f"SELECT o_orderkey, CASE WHEN filing_type = '10-K' OR quarter = 'Q1' THEN year - 1 ELSE year END AS prior_year, CASE WHEN filing_type = '10-K' OR quarter = 'Q1' THEN '10-K' ELSE '10-Q' END AS prior_type, CASE WHEN quarter = 'Q2' THEN 'Q1' WHEN quarter = 'Q3' THEN 'Q2' END AS prior_quarter FROM ({_FILED})")
def prior_period(spark: SparkSession, sf: str) -> DataFrame:
    p = facts.prior_period(F.col("year"), F.col("filing_type"), F.col("quarter"))
    return _filed(spark, sf).select("o_orderkey", p["year"].alias("prior_year"), p["filing_type"].alias("prior_type"), p["quarter"].alias("prior_quarter"))


@query(duck("annual_v", then=_LAST5 + " SELECT c.entity, c.metric, c.year, c.val AS current_val, p.val AS prior_val FROM last5 c LEFT JOIN last5 p ON p.entity = c.entity AND p.metric = c.metric AND p.year = c.year - 1"))
def period_pair(spark: SparkSession, sf: str) -> DataFrame:
    """Each period beside the one before, joined on the key that ``prior_period`` gives."""
    a = facts.annual_metrics(view(spark, sf, "annual_v")).select("entity", "metric", "year", F.col("val").alias("current_val"))
    p = facts.prior_period(F.col("year"), F.lit("10-K"), F.lit(None).cast("string"))["year"]
    prior = a.select("entity", "metric", F.col("year").alias("prior_year"), F.col("current_val").alias("prior_val"))
    return a.withColumn("prior_year", p).join(prior, ["entity", "metric", "prior_year"], "left").drop("prior_year")


@query("WITH n AS (SELECT upper('s' || (s_suppkey % 50)) AS ticker, s_suppkey FROM supplier), f AS (SELECT ticker, arg_min(s_suppkey, s_suppkey) AS cik FROM n GROUP BY ticker) SELECT upper('s' || c_custkey % 60) AS ticker, lpad(CAST(max(cik) AS VARCHAR), 10, '0') AS cik FROM customer LEFT JOIN f ON upper('s' || c_custkey % 60) = f.ticker GROUP BY 1")
def lookup_entity(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "supplier").select(F.concat(F.lit("s"), (F.col("s_suppkey") % 50).cast("string")).alias("ticker"), F.col("s_suppkey").alias("cik"), F.col("s_suppkey").alias("pos"))
    wanted = table(spark, sf, "customer").select(F.concat(F.lit(" s"), (F.col("c_custkey") % 60).cast("string"), F.lit(" ")).alias("ticker")).distinct()
    return facts.lookup_entity(wanted, names)


@query("SELECT o_orderkey, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS label, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') AS INT) AS days FROM orders")
def quarter_label(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", facts.quarter_label(F.col("o_orderdate")).alias("label"), F.datediff(F.lit("2000-01-01").cast("date"), F.col("o_orderdate").cast("date")).alias("days"))


@query("WITH s AS (SELECT n_name AS segment, year(o_orderdate) AS year, CAST(o_totalprice * 100 AS BIGINT) AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey), t AS (SELECT year, segment, sum(v) AS v FROM s GROUP BY ALL), h AS (SELECT year, segment, round(CAST(v AS DOUBLE) / sum(v) OVER (PARTITION BY year) * 100, 1) AS share FROM t) SELECT CAST(c.year AS INT) AS year, c.segment, c.share, round(c.share - p.share, 1) AS shift, CASE WHEN abs(round(c.share - p.share, 1)) > 15 THEN 'structural' WHEN abs(round(c.share - p.share, 1)) < 5 THEN 'stable' WHEN p.share IS NOT NULL THEN 'moving' END AS kind FROM h c LEFT JOIN h p ON p.segment = c.segment AND p.year = c.year - 2")
def segment_share_shift(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = o.select(F.col("n_name").alias("segment"), F.year("o_orderdate").alias("year"), F.round(F.col("o_totalprice") * 100).cast("long").alias("v"))
    return rules.share_shift(rows, "segment", "year", "v")


@query("WITH m AS (SELECT c_nationkey AS entity, CAST(year(o_orderdate) AS INT) * 100 + CAST(month(o_orderdate) AS INT) AS period, CAST(count(*) AS DOUBLE) AS revenue, CAST(count(*) FILTER (o_orderstatus = 'O') AS DOUBLE) AS item FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL), g AS (SELECT *, round((item - lag(item) OVER w) / nullif(lag(item) OVER w, 0) * 100, 1) AS item_growth, round((revenue - lag(revenue) OVER w) / nullif(lag(revenue) OVER w, 0) * 100, 1) AS revenue_growth FROM m WINDOW w AS (PARTITION BY entity ORDER BY period)), f AS (SELECT *, coalesce(item_growth > revenue_growth, false) AS faster FROM g), i AS (SELECT *, sum(CASE WHEN faster THEN 0 ELSE 1 END) OVER (PARTITION BY entity ORDER BY period) AS island FROM f), r AS (SELECT *, CAST(sum(CASE WHEN faster THEN 1 ELSE 0 END) OVER (PARTITION BY entity, island ORDER BY period) AS BIGINT) AS run FROM i) SELECT entity, period, item_growth, revenue_growth, faster, run, run >= 2 AS warning FROM r")
def growth_divergence(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    m = o.groupBy(F.col("c_nationkey").alias("entity"), (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("period")).agg(F.count(F.lit(1)).cast("double").alias("revenue"), F.count_if(F.col("o_orderstatus") == "O").cast("double").alias("item"))
    return rules.growth_divergence(m, "entity", "period", "item", "revenue").drop("item", "revenue")
