"""Readers of facts, filings, documents and transcripts as flat relations with ordinals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ENTRY = "form STRING, fp STRING, fy INT, start STRING, `end` STRING, val DOUBLE, filed STRING"
FACTS_SCHEMA = f"entity STRING, facts STRUCT<`us-gaap`: MAP<STRING, STRUCT<units: MAP<STRING, ARRAY<STRUCT<{_ENTRY.replace(' STRING', ': STRING').replace(' INT', ': INT').replace(' DOUBLE', ': DOUBLE')}>>>>>>"
FILINGS_SCHEMA = "entity STRING, filings STRUCT<recent: STRUCT<form: ARRAY<STRING>, filingDate: ARRAY<STRING>, reportDate: ARRAY<STRING>, accessionNumber: ARRAY<STRING>, primaryDocument: ARRAY<STRING>>>"
_PERSON = "STRUCT<name: STRING, role: STRING, affiliation: STRING>"
SCRAPED_SCHEMA = f"url STRING, raw_text STRING, date STRING, participants ARRAY<{_PERSON}>, scraped_at STRING"


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """Company facts in JSON, flattened (see ``flatten_facts``)."""
    return flatten_facts(spark.read.schema(FACTS_SCHEMA).json(path, multiLine=True))


def flatten_facts(companies: DataFrame) -> DataFrame:
    """One row per fact: entity, concept, unit, entry_pos, form, fp, fy, start_date, end_date, val, filed.

    A missing ``filed`` is '' and a missing or empty date is null."""
    c = companies.select("entity", F.explode(F.col("facts.us-gaap")).alias("concept", "c"))
    u = c.select("entity", "concept", F.explode("c.units").alias("unit", "entries"))
    e = u.select("entity", "concept", "unit", F.posexplode("entries").alias("entry_pos", "e"))
    date = lambda x: F.to_date(F.nullif(F.col(x), F.lit("")))
    return e.select("entity", "concept", "unit", "entry_pos", "e.form", "e.fp", "e.fy", date("e.start").alias("start_date"), date("e.end").alias("end_date"), "e.val", F.coalesce("e.filed", F.lit("")).alias("filed"))


def read_filings(spark: SparkSession, path: str) -> DataFrame:
    """The filing index: parallel arrays to one row per filing, with its place in the source."""
    rows = spark.read.schema(FILINGS_SCHEMA).json(path, multiLine=True)
    return index_filings(rows)


def index_filings(rows: DataFrame) -> DataFrame:
    r = rows.select("entity", "filings.recent.*")
    zipped = F.arrays_zip("form", "filingDate", "reportDate", "accessionNumber", "primaryDocument")
    return r.select("entity", F.posexplode(zipped).alias("pos", "f")).select("entity", "pos", "f.*")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as (path, text)."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Scraped transcripts, one JSON object a line; lines that don't parse have a text in ``_corrupt_record``."""
    return spark.read.schema(SCRAPED_SCHEMA + ", _corrupt_record STRING").option("mode", "PERMISSIVE").json(path)


def read_skills(spark: SparkSession, path: str) -> DataFrame:
    """Prompt files as (skill, version, text); the version stands in the first 200 characters, else 'unknown'."""
    d = read_documents(spark, path)
    version = F.regexp_extract(F.substring("text", 1, 200), r"skill_version:\s*([\d.]+)", 1)
    return d.select(F.regexp_extract("path", r"([^/]+)\.md$", 1).alias("skill"), F.when(version == "", "unknown").otherwise(version).alias("version"), "text")


CONFIG_SCHEMA = "provider STRING, model STRING, api_key STRING, max_tokens INT, max_tokens_by_skill MAP<STRING, INT>, sec_user_agent STRING"


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """The settings of a run, one row typed; what isn't set is null but for the token cap, which is 4096."""
    return spark.read.schema(CONFIG_SCHEMA).json(path, multiLine=True).fillna({"max_tokens": 4096})


def token_cap(config: DataFrame, skill: str) -> int:
    """The skill's own cap on output tokens, or the general one."""
    return config.select(F.coalesce(F.try_element_at("max_tokens_by_skill", F.lit(skill)), "max_tokens")).first()[0]
