"""Runs of line hashes: what is shuffled, what repeats, and how long a text of many lines takes."""

from __future__ import annotations

import random
import time

from ledgerloom.llm import line_dedup
from ledgerloom.llm._shared import settings
from pyspark.sql import functions as F

LINE = "a line that is long enough to count"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_runs_are_not_shuffled_or_sorted_again(spark):
    runs = line_dedup.LineRuns(spark, fanout=3)
    for i in (2, 1):
        runs.add(spark.range(500).select(F.lit(i).cast("long").alias("doc_id"), F.xxhash64(F.col("id") + 300 * i).alias("h1"), F.col("id").alias("h2")))
    batch = spark.range(500).select(F.lit(0).cast("long").alias("doc_id"), F.xxhash64(F.col("id") + 100).alias("h1"), F.col("id").alias("h2"))
    with settings(spark, line_dedup.RUN_SETTINGS | {"spark.sql.adaptive.enabled": "false"}):
        joined, merged = plan(runs.joined(batch)), plan(runs.compaction(runs.runs()))
    assert "Exchange" not in merged and joined.count("Exchange hashpartitioning") == 1  # the batch alone
    assert joined.count("SortMergeJoin") == 2 and joined.count("Sort [") == 1
    assert len(runs.runs()) == 2 and runs.repeats[0].count() == 0
    runs.forget(*runs.runs())


def test_runs_hold_a_line_once(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    rows = [(5, 1, 1), (4, 1, 1), (4, 2, 2)], [(3, 1, 1), (3, 3, 3)], [(2, 3, 3), (2, 2, 2), (1, 4, 4)]
    for r in rows:
        runs.add(spark.createDataFrame(r, "doc_id LONG, h1 LONG, h2 LONG"))
    held = sorted((r.h1, r.last) for run in runs.runs() for r in run.collect())
    assert held == [(1, 5), (2, 4), (3, 3), (4, 1)] and [len(x) for x in runs.levels] == [1, 1]
    assert [tuple(r) for r in runs.common(3).collect()] == [(1, 1, 5)]
    assert sorted(r.h1 for r in runs.common(2).collect()) == [1, 2, 3]
    runs.forget(*runs.runs())


def test_hashes_are_sparks(spark):
    lines = ["  The LINE \t", "É Ünïcode ÀÈ", "", "\x0bx\r"]
    df = spark.createDataFrame([(x,) for x in lines], "l STRING").select("l", line_dedup._hashes(line_dedup.line_key(F.col("l"))).alias("k"))
    for r in df.collect():
        assert line_dedup.key_hashes(r.l.encode()) == b"".join((x % 2**64).to_bytes(8, "big") for x in r.k)


def test_an_id_counts_once(spark):
    df = spark.createDataFrame([(1, LINE), (1, LINE + "\nmore"), (2, LINE)], "doc_id LONG, text STRING")
    assert {r.n_dropped for r in line_dedup.dedup_lines(df).collect()} == {0}
    df = df.union(spark.createDataFrame([(3, f"x\n{LINE.upper()}\n{LINE}")], df.schema))
    got = sorted((r.doc_id, r.n_dropped, r.text) for r in line_dedup.dedup_lines(df).collect())
    assert got == [(1, 1, ""), (1, 1, "more"), (2, 1, ""), (3, 0, f"x\n{LINE.upper()}\n{LINE}")]


def test_clashing_names_in_any_case(spark):
    df = spark.createDataFrame([(1, LINE, 7, 8, 9, 10)], "doc_id LONG, text STRING, N_Lines INT, n_DROPPED INT, __gone INT, row INT")
    out = line_dedup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "__gone", "row", "n_lines", "n_dropped"]
    assert [tuple(r) for r in out.collect()] == [(1, LINE, 9, 10, 1, 0)]


def test_time_is_linear_in_lines(spark):
    rng = random.Random(1)
    lines = [f"{LINE} {rng.random()}" for _ in range(40_000)]

    def seconds(n: int) -> float:
        df = spark.createDataFrame([(i, "\n".join(lines[:n])) for i in range(3)], "doc_id LONG, text STRING").cache()
        df.count()
        start = time.time()
        assert sorted(r.n_dropped for r in line_dedup.dedup_lines(df, n_batches=1).select("n_dropped").collect()) == [0, n, n]
        return time.time() - start

    assert seconds(40_000) < 6 * seconds(10_000) + 1
