"""Transcripts: prepared remarks and Q&A, speaker turns, speakers' identities, data-quality gates."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import stripped
from ..plans import dims

_NAME = r"[^\S\n]*([\w][\w\t .\-']*?)[ \t]*:"


def qa_start(text: Column) -> Column:
    """Place (from 1) of the earliest Q&A marker; one behind the end if there is none."""
    spots = [F.nullif(F.regexp_instr(text, F.lit(f"(?iU){p}")), F.lit(0)) for p in dims.QA_MARKERS]
    return F.coalesce(F.least(*spots), F.char_length(text) + 1)


def halves(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text): prepared remarks, and the Q&A from its marker on."""
    at = qa_start(F.col("text"))
    both = F.array(F.struct(F.lit("prepared").alias("part"), F.substring("text", F.lit(1), at - 1).alias("text")), F.struct(F.lit("qa").alias("part"), F.substring("text", at, F.char_length("text")).alias("text")))
    return docs.select("doc_id", F.explode(both).alias("p")).select("doc_id", "p.part", "p.text")


def turns(parts: DataFrame) -> DataFrame:
    """(doc_id, part, turn, speaker_raw, text): a line 'name: ..' starts a turn; what comes before the first has no name.

    A text is cut in front of such lines inside its row: nothing is shuffled."""
    cut = parts.select("doc_id", "part", F.split("text", rf"(?U)\n(?={_NAME})", -1).alias("u"))
    named = F.get("u", F.lit(0)).rlike(rf"(?U)\A{_NAME}").cast("int")
    rows = cut.select("doc_id", "part", named.alias("named"), F.posexplode("u").alias("pos", "said"))
    name = F.when((F.col("pos") > 0) | (F.col("named") == 1), F.trim(F.regexp_extract("said", rf"(?U)\A{_NAME}", 1)))
    body = F.when(name.isNotNull(), F.regexp_replace("said", F.lit(rf"(?U)\A{_NAME}"), F.lit(""))).otherwise(F.col("said"))
    return rows.select("doc_id", "part", (F.col("pos") + F.col("named")).cast("long").alias("turn"), name.alias("speaker_raw"), stripped(body).alias("text"))


def alias_claims(people: DataFrame) -> DataFrame:
    """(doc_id, alias, name, is_full): full names, and first and last words of names of two or more."""
    words = F.split(F.lower(F.trim("name")), r"\s+")
    full = F.array(F.struct(F.lower(F.trim("name")).alias("alias"), F.lit(True).alias("is_full")))
    short = F.array(F.struct(F.element_at(words, 1).alias("alias"), F.lit(False).alias("is_full")), F.struct(F.element_at(words, -1).alias("alias"), F.lit(False).alias("is_full")))
    claims = F.when(F.size(words) >= 2, F.concat(full, short)).otherwise(full)
    return people.select("doc_id", "pos", "name", F.explode(claims).alias("c")).select("doc_id", "pos", "name", "c.*")


def alias_index(people: DataFrame) -> DataFrame:
    """(doc_id, alias, name): full names, and short ones that one claim alone has; a full name goes before a short one."""
    c = alias_claims(people).groupBy("doc_id", "alias").agg(F.count_if("is_full").alias("full"), F.count(F.lit(1)).alias("n"), F.max_by(F.when(F.col("is_full"), F.col("name")), F.when(F.col("is_full"), F.col("pos"))).alias("by_full"), F.max("name").alias("any"))
    return c.where("full > 0 or n = 1").select("doc_id", "alias", F.coalesce("by_full", "any").alias("name"))


def fuzzy_names(least: float = dims.FUZZY_RATIO):
    """A function (raw, names) -> the name most like it, the first of equals, if alike enough."""

    @F.pandas_udf("string")
    def best(raw: pd.Series, names: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        def one(x, candidates):
            if x is None or candidates is None or not len(candidates):
                return None
            key = x.strip().lower()
            ratios = [SequenceMatcher(None, key, c.lower()).ratio() for c in candidates]
            k = max(range(len(ratios)), key=lambda i: (ratios[i], -i))
            return candidates[k] if ratios[k] >= least else None

        return pd.Series([one(x, c) for x, c in zip(raw, names, strict=True)])

    return best


def speakers(said: DataFrame, people: DataFrame) -> DataFrame:
    """Turns with the speaker's full name (or Unknown): by alias; only the names that no alias has are compared one by one."""
    hit = said.withColumn("alias", F.lower(F.trim("speaker_raw"))).join(alias_index(people).withColumnRenamed("name", "found"), ["doc_id", "alias"], "left")
    names = people.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("p")).select("doc_id", F.col("p.name").alias("names"))
    left = hit.where("found is null and alias is not null").select("doc_id", "alias").distinct().join(names, "doc_id")
    guessed = left.withColumn("guess", fuzzy_names()(F.col("alias"), F.col("names"))).select("doc_id", "alias", "guess")
    out = hit.join(guessed, ["doc_id", "alias"], "left")
    return out.withColumn("speaker", F.coalesce("found", "guess", F.lit("Unknown"))).drop("alias", "found", "guess")


def drop_empty_unknown(said: DataFrame) -> DataFrame:
    return said.where(~((F.col("speaker") == "Unknown") & (F.trim("text") == "")))


def parse_transcripts(docs: DataFrame, people: DataFrame) -> DataFrame:
    """(doc_id, part, turn, speaker, role, affiliation, text) of all turns but empty ones of unknown speakers."""
    said = drop_empty_unknown(speakers(turns(halves(docs)), people))
    who = people.groupBy("doc_id", "name").agg(F.min_by(F.struct("role", "affiliation"), "pos").alias("w")).select("doc_id", F.col("name").alias("speaker"), "w.*")
    return said.join(who, ["doc_id", "speaker"], "left").select("doc_id", "part", "turn", "speaker", "role", "affiliation", "text")


def input_error(ticker: Column, quarter: Column, year: Column) -> Column:
    """What is wrong with a request, or null."""
    bad = lambda c, p: ~F.coalesce(F.trim(c).rlike(p), F.lit(False))
    return F.when(bad(F.upper(ticker), r"^[A-Z]{1,5}$"), "ticker").when(bad(quarter, r"(?i)^Q[1-4]$"), "quarter").when(bad(year, r"^\d{4}$"), "year")


def quality_error(raw_text: Column, n_people: Column, least: int = 1000) -> Column:
    return F.when(F.coalesce(F.char_length(raw_text), F.lit(0)) < least, "short_text").when(n_people == 0, "no_participants")


def failure_kind(message: Column, code: Column) -> Column:
    """ok, auth, not_found (both final) or retry, from an exit code and error output."""
    m = F.lower(F.coalesce(message, F.lit("")))
    return F.when(code == 0, "ok").when(m.contains("auth wall") | m.contains("sign in"), "auth").when(m.contains("transcript not found"), "not_found").otherwise("retry")


def first_anchor(anchors: DataFrame, quarter: str, year: str) -> DataFrame:
    """Per page the first link whose title names the quarter and year."""
    q = quarter.upper().lstrip("Q")
    title = F.regexp_replace(F.upper("title"), F.lit(r"\s+"), F.lit(" "))
    hit = anchors.where(title.rlike(rf"Q{q}[\s-]*(?:FY)?{year}"))
    return hit.groupBy("page_id").agg(F.min("pos").alias("pos"), F.min_by("href", "pos").alias("href"))


def first_fitting(candidates: list[Column], body: Column, least: int, most: int) -> Column:
    """The first candidate text of fitting length, else the body."""
    return F.coalesce(*[F.when(F.char_length(c).between(least, most), c) for c in candidates], body)
