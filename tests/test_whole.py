"""Queries that take their table's rows and texts whole."""

from __future__ import annotations

import hashlib
import math
from decimal import ROUND_HALF_UP, Decimal

import duckdb
from pyspark.sql import functions as F

from ledgerloom import catalog
from ledgerloom.functions import numbers
from ledgerloom.plans import dims

catalog.load()


def test_percent_rounds_ties_away_from_zero(spark):
    values = [k / 8 for k in range(-200, 201)] + [123456.25, -123456.75, None]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    for r in df.select("v", numbers.percent(F.col("v"), True).alias("signed"), numbers.percent(F.col("v")).alias("plain")).collect():
        want = "—" if r.v is None else f"{Decimal(r.v).quantize(Decimal('0.1'), ROUND_HALF_UP)}%"
        assert r.plain.replace("-0.0", "0.0") == want.replace("-0.0", "0.0")
        assert r.signed.lstrip("+-") == want.lstrip("-") and (r.v is None or r.signed[0] == ("-" if r.v < 0 else "+"))


def test_signed_percent_has_every_order_and_its_ties(spark, tmp_path):
    prices = [10.0, 14.0, 9.0, 2.0, 6.0]
    spark.createDataFrame([(i, p) for i, p in enumerate(prices, 1)], "o_orderkey LONG, o_totalprice DOUBLE").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.o_orderkey: (r.growth, r.margin) for r in catalog.QUERIES["signed_percent"](spark, str(tmp_path)).collect()}
    assert got == {1: ("+1.3%", "1.3%"), 2: ("+1.8%", "1.8%"), 3: ("+1.1%", "1.1%"), 4: ("+0.3%", "0.3%"), 5: ("+0.8%", "0.8%")}


def both_shown(spark, path, name, prices, keys=26):
    """(order, price, shown by Spark, shown by DuckDB) of each price under so many keys."""
    orders = [(i * keys + k, p) for i, p in enumerate(prices) for k in range(keys)]
    spark.createDataFrame(orders, "o_orderkey LONG, o_totalprice DOUBLE").write.parquet(f"{path}/orders.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{path}/orders.parquet/*.parquet'")
    theirs = dict(con.execute(catalog.SQL[name]).fetchall())
    ours = {r.o_orderkey: r.shown for r in catalog.QUERIES[name](spark, str(path)).collect()}
    assert ours.keys() == theirs.keys() and len(ours) == len(orders)
    return [(k, p, ours[k], theirs[k]) for k, p in orders]


def odd_prices():
    ties = [(n * 1000 + 500) * s for n in range(80) for s in (1.0, 10.0)]
    beside = [math.nextafter(p, to) for p in ties for to in (0.0, 1e9)]
    return ties + beside + [-p for p in ties] + [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 0.3, -0.3, -0.004, 9999.99, 9999.996, 999999.5, 1.5e6, 2.5e6, 1.15e14]


def test_fmt_val_has_its_sql_s_rows_at_ties(spark, tmp_path):
    assert [x for x in both_shown(spark, tmp_path, "fmt_val", odd_prices()) if x[2] != x[3]] == []


def test_money_in_reports_goes_to_the_nearest_of_the_exact_double(spark):
    values = [1.25e9, 1.35e9, -1.15e9, 2.5e6, 3.5e6, math.nan, -math.inf, None]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE").select(numbers.money(F.col("v")).alias("exact"), numbers.money(F.col("v"), away=True).alias("away"))
    got = df.collect()
    assert [r.exact for r in got] == ["$1.2B", "$1.4B", "$-1.1B", "$2M", "$4M", "$nanB", "$-infB", "—"]
    assert [r.away for r in got] == ["$1.3B", "$1.4B", "$-1.2B", "$2M", "$4M", "$nanB", "$-infB", "—"]


def test_shares_has_its_sql_s_rows_at_ties(spark, tmp_path):
    assert [x for x in both_shown(spark, tmp_path, "shares", odd_prices()) if x[2] != x[3]] == []


def test_shares_in_reports_go_to_the_nearest_of_the_exact_double(spark):
    df = spark.createDataFrame([(v,) for v in (1.25e6, 1.35e6, -1.15e6, 999999.0, None)], "v DOUBLE")
    got = df.select(numbers.shares(F.col("v")).alias("exact"), numbers.shares(F.col("v"), away=True).alias("away")).collect()
    assert [r.exact for r in got] == ["1.2M", "1.4M", "-1.1M", "999,999", "—"]
    assert [r.away for r in got] == ["1.3M", "1.4M", "-1.2M", "999,999", "—"]


def test_texts_are_taken_whole(spark, tmp_path):
    texts = ["x" * 100 + "|a\nb\rc CapEx", "y " * 2000 + "| CapEx", "z " * 700, None]
    spark.createDataFrame([(i, x, "s") for i, x in enumerate(texts)], "doc_id LONG, text STRING, source STRING").write.parquet(f"{tmp_path}/documents.parquet")
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    of = lambda name, col: {r.doc_id: r[col] for r in catalog.QUERIES[name](spark, str(tmp_path)).collect()}
    cells = [(x or "").replace("|", "\\|").replace("\n", " ").replace("\r", " ") for x in texts]
    assert of("escape_cell", "cell_md5") == {i: md5(x) for i, x in enumerate(cells)}
    folded = of("term_substitute", "text_md5")
    for i, start in enumerate(("OperatingIncomeLoss ", "NetIncome and CapEx ", "大幅惡化 ")):
        want = start + texts[i]
        for a, b in dims.TERM_SUBSTITUTES:
            want = want.replace(a, b)
        assert folded[i] == md5(want)
    assert of("coalesce_candidates", "text_md5") == {0: md5(texts[0]), 1: md5("s " + texts[1]), 2: md5(texts[2]), 3: None}


def test_eval_loop_runs_every_document(spark, tmp_path):
    spark.createDataFrame([(i, "x" * (200 if i < 10 else 20)) for i in range(20)], "doc_id LONG, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.task_id, r.low_confidence) for r in catalog.QUERIES["eval_loop"](spark, str(tmp_path)).collect()}
    names = ("financial", "risk", "three_statement_cross", "supply_chain", "fn_tax")
    assert got == {i: (names[i % 5], i in (2, 7)) for i in range(20)}
