"""Semantics that the tables don't reach: small fixtures with known answers."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.operators import evaluation, facts, layouts, renderers, report, sections, state, typed
from ledgerloom.operators import transcripts as t
from ledgerloom.plans import dims, phases, report_layouts, skills
from ledgerloom.sources import scraped, sinks, tables
from ledgerloom.streaming import usage

PEOPLE = [(1, 0, "Patrick Gelsinger", "CEO", "Intel"), (1, 1, "David Zinsner", "CFO", "Intel"), (1, 2, "Ross Seymore", "Analyst", "Deutsche Bank")]


def parsed(spark, raw, people=PEOPLE):
    docs = spark.createDataFrame([(1, raw)], "doc_id INT, text STRING")
    who = spark.createDataFrame(people, "doc_id INT, pos INT, name STRING, role STRING, affiliation STRING")
    return [r.asDict() for r in t.parse_transcripts(docs, who).orderBy("part", "turn").collect()]


def test_prepared_remarks_and_questions(spark):
    out = parsed(spark, "Operator: Welcome.\nPatrick Gelsinger: Thank you.\nDavid Zinsner: Numbers.\nQuestions and Answers Session\nRoss Seymore: Why?\nDavid Zinsner: Because.")
    prepared, qa = [r for r in out if r["part"] == "prepared"], [r for r in out if r["part"] == "qa"]
    assert ("Patrick Gelsinger", "CEO", "Intel") in [(r["speaker"], r["role"], r["affiliation"]) for r in prepared]
    assert "Ross Seymore" in [r["speaker"] for r in qa] and "Ross Seymore" not in [r["speaker"] for r in prepared]


@pytest.mark.parametrize(("name", "found"), [("Pat Gelsinger", "Patrick Gelsinger"), ("Random Stranger", "Unknown"), ("Patrick", "Patrick Gelsinger"), ("seymore", "Ross Seymore")])
def test_names(spark, name, found):
    assert [r["speaker"] for r in parsed(spark, f"{name}: Hello there.")] == [found]


def test_shared_surname_is_no_alias(spark):
    people = [(1, 0, "John Smith", None, None), (1, 1, "Jane Smith", None, None)]
    assert [r["speaker"] for r in parsed(spark, "Smith: Hello.", people)] == ["Unknown"]


def test_earliest_marker_splits(spark):
    out = parsed(spark, "Patrick Gelsinger: We move to Q&A.\nRoss Seymore: First.\nQuestions and Answers Session\nRoss Seymore: Next.")
    assert all(r["part"] == "qa" for r in out if r["speaker"] == "Ross Seymore")


def test_no_marker_and_no_people(spark):
    who = spark.createDataFrame([], "doc_id INT, pos INT, name STRING, role STRING, affiliation STRING")
    docs = spark.createDataFrame([(1, "Alice: One.\nBob: Two.")], "doc_id INT, text STRING")
    assert [(r.part, r.speaker) for r in t.parse_transcripts(docs, who).collect()] == [("prepared", "Unknown")] * 2


FACTS = "entity INT, metric STRING, concept_pos INT, entry_pos INT, form STRING, fp STRING, fy INT, start_date DATE, end_date DATE, val DOUBLE, filed STRING"


def test_growth_skips_gaps_and_zeros(spark):
    rows = [(1, "Revenue", 0, i, "10-K", "FY", y, None, None, v, f"{y + 1}-02-01") for i, (y, v) in enumerate([(2018, 10.0), (2020, 20.0), (2021, 0.0), (2022, 5.0)])]
    df = spark.createDataFrame(rows, FACTS.replace("DATE", "STRING")).withColumn("start_date", F.to_date("start_date")).withColumn("end_date", F.to_date("end_date"))
    got = {r.year: r.yoy_pct for r in facts.annual_growth(facts.annual_metrics(df)).collect()}
    assert got == {2018: None, 2020: None, 2021: None, 2022: None}
    rows = [(1, "Revenue", 0, i, "10-K", "FY", 2018 + i, None, None, v, f"{2019 + i}-02-01") for i, v in enumerate([10.0, 15.0, 12.0, -3.0])]
    df = spark.createDataFrame(rows, FACTS.replace("DATE", "STRING")).withColumn("start_date", F.to_date("start_date")).withColumn("end_date", F.to_date("end_date"))
    assert {r.year: r.yoy_pct for r in facts.annual_growth(facts.annual_metrics(df)).collect()} == {2018: None, 2019: 50.0, 2020: -20.0, 2021: -125.0}


def test_latest_filed_ties_go_to_later_concept(spark):
    rows = [(1, "Revenue", c, e, "10-K", "FY", 2020, None, None, v, "2021-01-01") for c, e, v in [(0, 9, 1.0), (1, 2, 2.0), (1, 1, 3.0)]]
    df = spark.createDataFrame(rows, FACTS.replace("DATE", "STRING")).withColumn("start_date", F.to_date("start_date")).withColumn("end_date", F.to_date("end_date"))
    assert [r.val for r in facts.annual_latest(df).collect()] == [2.0]


def test_spans_at_their_limits(spark):
    rows = [(1, "Revenue", 0, d, "10-Q", "FY", 2020, "2020-01-01", d, 1.0, "") for d in (59, 60, 100, 101, 339, 340, 380, 381)]
    df = spark.createDataFrame(rows, FACTS.replace("start_date DATE", "start_date STRING").replace("end_date DATE", "end_date INT"))
    df = df.withColumn("start_date", F.to_date("start_date")).withColumn("end_date", F.expr("start_date + end_date"))
    assert sorted(r.entry_pos for r in facts.quarter_candidates(df).collect()) == [60, 100, 340, 380]


def test_salvage():
    assert json.loads(text.salvage('x {"a": {"b": 1}} y')) == {"a": {"b": 1}}
    assert json.loads(text.salvage("none"))["error"] == "JSON parse failed"
    assert "error" in json.loads(text.salvage('{"a": "}"} x'))


def test_schema_score(spark):
    rows = [("risk", '{"risks": [], "top_3": [1], "insufficient_data": false}'), ("risk", '{"risks": [1]}'), ("fn_combined", "{}"), ("other", "{}")]
    df = spark.createDataFrame(rows, "task STRING, result STRING")
    assert [r[0] for r in df.select(evaluation.json_schema_score(F.col("result"), F.col("task"))).collect()] == [21, 1, 0, 25]


def test_dry_run_flags_what_fails_twice(spark):
    replies = {"three_statement_cross": '{"checks": [1]}', "financial": '{"metrics": {"a": 1}, "quality_flags": [], "trend_summary": "x", "insufficient_data": false}'}
    df = spark.createDataFrame([(k, "x" * 200, "p") for k in ("three_statement_cross", "financial")], "task_id STRING, source STRING, prompt STRING")
    out = {r.task_id: r.low_confidence for r in skills.evaluated_run(df, skills.dry_run(replies), 81).collect()}
    assert out == {"three_statement_cross": True, "financial": False}


def counting(path, reply="{}"):
    """A provider that adds a line to a file for each call, as workers are other processes."""

    def call(task_id, prompt):
        with open(path, "a") as f:
            f.write(f"{task_id} {len(prompt)}\n")
        return reply[task_id] if isinstance(reply, dict) else reply

    return call


def test_each_task_is_called_once_for_each_try(spark, tmp_path):
    calls, folder = tmp_path / "calls", f"file://{tmp_path}/run"
    replies = {"three_statement_cross": '{"checks": [1]}', "fn_tax": '{"insufficient_data": false}'}
    df = spark.createDataFrame([(k, "x" * 200, "p") for k in replies], "task_id STRING, source STRING, prompt STRING")
    out = skills.evaluated_run(df, counting(calls, replies), 81, path=folder)
    for _ in range(2):
        assert {r.task_id: r.low_confidence for r in out.collect()} == {"three_statement_cross": True, "fn_tax": False}
    assert len(calls.read_text().splitlines()) == 3  # one task failed and was tried again
    skills.evaluated_run(df, counting(calls, replies), 81, path=folder).collect()
    assert len(calls.read_text().splitlines()) == 3
    more = df.union(spark.createDataFrame([("fn_tax2", "s", "p")], df.schema))
    done = skills.run_once(more, counting(calls), f"{folder}/first")
    assert done.count() == 3 and len(calls.read_text().splitlines()) == 4


def test_phases_read_each_other_and_run_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dims, "PHASES", [p for p in dims.PHASES if p[0] in ("phase2", "phase2b", "synthesis")])
    calls, folder = tmp_path / "calls", f"file://{tmp_path}/phases"
    filings = spark.createDataFrame([(1, "10-K", None, 2020, 900), (2, "10-Q", "Q2", 2020, 0)], "entity LONG, filing_type STRING, quarter STRING, prior_year INT, pension_chars INT")
    inputs = spark.createDataFrame([(1, "item1_current", "business text"), (1, "fn_tax", "tax"), (2, "item7_current", "mdna")], "entity LONG, key STRING, text STRING")

    def reply(task_id, prompt):
        with open(calls, "a") as f:
            f.write(f"{task_id}\n")
        return json.dumps({"task": task_id, "prompt": prompt, "structural_shift": True, "x": "y" * 100})

    out = phases.run_phases(filings, inputs, reply, folder)
    got = {(r.entity, r.task_id): json.loads(r.result) for r in out.collect()}
    assert got[1, "business"]["prompt"] == "## current_section\nbusiness text" and (2, "business") not in got and (2, "segment_trend") not in got
    assert '"fn_tax"' in got[1, "financial"]["prompt"] and "## notes" in got[2, "financial"]["prompt"] and '"fn_combined"' in got[2, "financial"]["prompt"]
    assert "## business" in got[1, "segment_trend"]["prompt"] and got[1, "insight"]["prompt"].startswith("## business")
    assert '{"structural_shift": true, "shift_description": null, "rerating_candidate_structure": null}' in got[1, "insight"]["prompt"]
    n = len(calls.read_text().splitlines())
    assert n == len(got)
    assert phases.run_phases(filings, inputs, reply, folder).count() == n and len(calls.read_text().splitlines()) == n


def test_a_whole_report(spark):
    results = spark.createDataFrame([(1, json.dumps({"business": {"company_positioning": "here"}}))], "entity LONG, result STRING")
    metrics = spark.createDataFrame([(1, "Revenue", 2.5e9, None), (1, "SharesOutstanding", 1.25e6, 900.0), (1, "rev_yoy", -1.25, 3.0), (1, "op_margin", 12.0, None), (1, "unknown", 1.0, 1.0)], "entity LONG, metric STRING, y2020 DOUBLE, y2021 DOUBLE")
    quarters = spark.createDataFrame([(1, "2020Q1", 1e6, 2.0, 3.0, None), (1, "2020Q2", None, None, 1.0, 1.0), (2, "2020Q1", 1.0, 1.0, 1.0, 1.0)], "entity LONG, quarter STRING, revenue DOUBLE, rev_growth_yoy DOUBLE, op_margin DOUBLE, net_margin DOUBLE")
    calls = results.select("entity", F.lit(None).cast("string").alias("result"))
    rows = report.full_report(results, calls, metrics, [2020, 2021], quarters, "10-Q").orderBy("section_no", "line_no").collect()
    text_ = [r.text for r in rows]
    assert text_[0].startswith("## Forward Guidance\n\n*") and text_[3].startswith("---") and "10-Q" in text_[3] and text_[4] == "## 財務數據"
    assert text_[5:10] == ["| 指標 | 2020 | 2021 |\n|------|------:|------:|", "| 營收 | $2.5B | — |", "| 流通股數 | 1.3M | 900 |", "| 營收 YoY | -1.3% | +3.0% |", "| 營業利益率 | 12.0% | — |"] or text_[7] == "| 流通股數 | 1.2M | 900 |"
    assert "| 2020Q1 | $1M | +2.0% | 3.0% | — |" in text_ and "## 公司定位" in text_ and "> 本季 MD&A 無明顯競爭壓力新增揭露。" in text_ and {r.entity for r in rows} == {1}
    combined = layouts.combined(spark.createDataFrame([(1, "b", '{"x": 1}'), (1, "a", None), (2, "a", "[]")], "entity LONG, task_id STRING, result STRING"))
    assert {r.entity: json.loads(r.result) for r in combined.collect()} == {1: {"a": None, "b": {"x": 1}}, 2: {"a": []}}


def test_third_tier_and_sources(spark, tmp_path):
    docs = spark.createDataFrame([(1, "words\nSTART HERE and on\nbody\n")], "doc_id LONG, text STRING")
    wanted = spark.createDataFrame([(1, "item7", "START HERE and on")], "doc_id LONG, section STRING, anchor STRING")
    assert [(r.section, r.tier, r.start_line) for r in sections.located_sections(docs, wanted).collect()] == [("item7", 3, 1)]
    (tmp_path / "c.json").write_text('{"provider": "none", "max_tokens_by_skill": {"a": 8192}}')
    config = tables.read_config(spark, str(tmp_path / "c.json"))
    assert tables.token_cap(config, "a") == 8192 and tables.token_cap(config, "b") == 4096 and config.first().model is None
    calls = spark.createDataFrame([("a/b c", "p", "r"), ("x", None, "r")], "label STRING, prompt STRING, raw STRING")
    sinks.append_contexts(calls, str(tmp_path / "ctx"))
    assert {(r.label, r.text) for r in spark.read.json(str(tmp_path / "ctx")).select("label", "text").collect()} == {("a_b_c", "## request\np\n\n## response\nr"), ("x", "## request\n\n\n## response\nr")}
    lines = spark.createDataFrame([(1, 2, 1, "b"), (1, 1, 1, "a"), (2, 1, 1, "c")], "entity INT, section_no INT, line_no INT, text STRING")
    sinks.write_report(lines, str(tmp_path / "reports"))
    assert [r.value for r in spark.read.text(str(tmp_path / "reports" / "entity=1")).collect()] == ["a", "b"]


def test_typed_results_of_a_wrong_type(spark):
    rows = spark.createDataFrame([(1, "fn_risk", '{"contingencies": "none", "leases": {"operating_total": 5}}'), (2, "fn_risk", "no JSON")], "entity LONG, task_id STRING, result STRING")
    assert [(r.contingencies, r.leases and r.leases.operating_total) for r in typed.typed(rows, "fn_risk").orderBy("entity").collect()] == [(None, "5"), (None, None)]


def test_notes_without_letters_are_all_revenue(spark):
    docs = spark.createDataFrame([(1, "plain\ntext")], "doc_id INT, text STRING")
    assert [(r.grp, r.text) for r in sections.grouped_notes(docs).collect()] == [("fn_revenue", "plain\ntext")]


def test_state_after_a_crash(spark):
    log = spark.createDataFrame([("a", 1, "running"), ("a", 2, "done"), ("b", 1, "running")], "k STRING, n INT, status STRING")
    latest = state.latest_state(log, ["k"], ["n"])
    assert {r.k: r.status for r in latest.collect()} == {"a": "done", "b": "pending"}
    assert [r.k for r in state.pending_steps(log.select("k").distinct(), latest, "k").collect()] == ["b"]


def test_readers_and_writers(spark, tmp_path):
    line = {"url": "u", "raw_text": "x", "date": None, "participants": [{"name": "A", "role": None, "affiliation": None}], "scraped_at": "now"}
    (tmp_path / "t.json").write_text(json.dumps(line) + "\nbroken\n")
    got = tables.read_transcripts(spark, str(tmp_path / "t.json")).cache()
    assert got.where("_corrupt_record is null").count() == 1 and got.count() == 2
    (tmp_path / "skill.md").write_text("---\nskill_version: 1.2\n---\nText")
    assert [(r.skill, r.version) for r in tables.read_skills(spark, str(tmp_path / "skill.md")).collect()] == [("skill", "1.2")]
    facts_json = {"entity": "e", "facts": {"us-gaap": {"Revenues": {"units": {"USD": [{"form": "10-K", "fp": "FY", "fy": 2020, "start": "2020-01-01", "end": "2020-12-31", "val": 5, "filed": "2021"}]}}}}}
    (tmp_path / "f.json").write_text(json.dumps(facts_json))
    assert [(r.concept, r.val) for r in tables.read_facts(spark, str(tmp_path / "f.json")).collect()] == [("Revenues", 5.0)]
    lines = spark.createDataFrame([(2, 1, "b"), (1, 1, "a")], "section_no INT, line_no INT, text STRING")
    sinks.write_report(lines, str(tmp_path / "report"))
    assert [r.value for r in spark.read.text(str(tmp_path / "report")).collect()] == ["a", "b"]
    calls = spark.createDataFrame([("x", 1000, 100)], "label STRING, `in` BIGINT, `out` BIGINT")
    sinks.append_usage(calls, str(tmp_path / "usage"))
    sinks.append_usage(calls, str(tmp_path / "usage"))
    assert [round(r.cost, 6) for r in spark.read.json(str(tmp_path / "usage")).collect()] == [0.0045] * 2
    assert sinks.cache_once(calls, str(tmp_path / "c")).count() == sinks.cache_once(calls.limit(0), str(tmp_path / "c")).count() == 1


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(f"2024-01-01 0{h}:10:00", "a", 1000, 100, h) for h in range(4)], "ts STRING, label STRING, n_in BIGINT, n_out BIGINT, event_id INT")
    rows = rows.withColumn("ts", F.to_timestamp("ts")).withColumn("step_key", F.lit("s")).withColumn("status", F.lit("done"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = usage.windowed_cost(stream).writeStream.outputMode("append").format("memory").queryName("cost").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("cost").count() == 3  # the last hour is still open
    q = usage.running_state(stream).writeStream.outputMode("update").format("memory").queryName("steps").option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("steps").count() == 1


def test_input_errors(spark):
    df = spark.createDataFrame([(" msft ", "q1", "2020"), ("BRK.B", "Q1", "2020"), ("A", "Q5", "2020"), ("A", "Q1", "20"), (None, "Q1", "2020")], "a STRING, b STRING, c STRING")
    assert [r[0] for r in df.select(t.input_error(F.col("a"), F.col("b"), F.col("c"))).collect()] == [None, "ticker", "quarter", "year", "ticker"]


RESULT = {
    "forward_guidance": {"hard_guidance": [{"metric": "Revenue|x", "value": "$1B"}], "soft_guidance": [{"area": "大幅", "direction": "up", "detail": "d"}], "implied_signals": ["警訊"]},
    "market_concerns": [{"topic": "Margin", "frequency": 2, "management_response": "ok", "verbatim_response": "a\nb"}],
    "competitive_pressure_signals": [{"severity": "high", "summary_zh": "s", "quote": "q", "market": "m", "vs_prior_quarter": "easing"}],
    "supply_chain_risks": [{"category": "price", "title": "t", "summary": "s"}],
    "purchase_commitments": {"found": True, "total_commitment_description": "x", "commitment_to_revenue_pct": "5%"},
}


def test_rendered_results(spark):
    df = spark.createDataFrame([(1, json.dumps(RESULT)), (2, "{}")], "entity INT, result STRING")
    lines = {(r.entity, r.section_no, r.line_no): r.text for r in layouts.rendered(df, report_layouts.GUIDANCE).collect()}
    assert lines[(1, 0, 1)] == "| Revenue\\|x | $1B | — | — |  |" and lines[(2, 0, 1)] == "（本季無硬性指引）"
    assert lines[(1, 1, 1)] == "- ****（up）：d" and lines[(1, 3, 1)] == "- 需留意" and (2, 1, 0) not in lines
    assert {r.entity: r.text for r in renderers.concerns(df).collect()} == {1: "### Margin（被問 2 次）\n\n**管理層回應**：ok\n\n> a\n> b", 2: renderers.NO_CONCERNS}
    assert [r.text for r in renderers.pressure(df).collect()] == ['- [高] **s** — m（vs 上季：緩解）\n  > "q"']
    assert [r.text for r in renderers.supply_risks(df).collect()] == ["- [價格] t：s"]
    assert [(r.entity, r.text) for r in renderers.commitments(df).collect()] == [(1, "x（佔 Revenue 約 5%）")]
    kept = renderers.declared(spark.createDataFrame([("risk", '{"risks": [1], "x": 2}')], "task_id STRING, result STRING"))
    assert {(r["key"], r["v"]) for r in kept.selectExpr("key", "to_json(value) as v").collect()} == {("risks", "[1]"), ("top_3", None), ("insufficient_data", None)}


def test_transcript_source(spark):
    def fetch(ticker, quarter, year):
        from ledgerloom.sources.scraped import NotFound

        if ticker == "NONE":
            raise NotFound(ticker)
        if ticker == "BAD":
            raise OSError("down")
        return json.dumps({"raw_text": "x" * (2000 if ticker == "GOOD" else 5), "participants": [{"name": "A"}, {"name": ""}]})

    spark.dataSource.register(scraped.transcript_source(fetch))
    got = {r.ticker: (r.error, r.participants) for r in spark.read.format("transcripts").option("wait", "0").option("requests", "good q1 2024, none Q2 2024, bad Q3 2024, thin Q4 2024").load().collect()}
    assert got["GOOD"] == (None, '[{"name": "A"}]') and got["NONE"][0].startswith("not_found") and got["BAD"][0] == "failed: down" and got["THIN"][0] == "short_text"
    with pytest.raises(ValueError, match="quarter"):
        scraped.requests("MSFT Q9 2024")
