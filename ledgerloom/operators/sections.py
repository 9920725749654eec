"""Sections, notes and tables of contents of long documents.

A document is (doc_id, text). Splitting by headers stays inside the row. Elsewhere lines are exploded once with their
numbers, and every choice (first anchor, earliest pattern) is an aggregate over (doc_id, ..), so it combines before the
shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import strip_md, stripped
from ..plans import dims


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) from 0."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


def _last_line(pattern: str) -> Column:
    """Number of the last line in ``__l`` that the pattern meets, or null."""
    places = F.sequence(F.lit(0), F.size("__l") - 1)
    return F.array_max(F.filter(places, lambda i: F.get("__l", i).rlike(f"(?iU){pattern}")))


def _found(filing_type: str) -> Column:
    """Array of (line_no, rank, section), in order, of the last header line of each section, from the lines in ``__l``.

    Plain-text headers count only in documents with fewer than three sections in Markdown, and there for the sections that
    have none; they aren't looked for elsewhere."""
    pairs = dims.HEADERS[filing_type]
    few = reduce(lambda n, s: n + F.col(f"__{s}").isNotNull().cast("int"), pairs, F.lit(0)) < 3
    line = {s: F.coalesce(f"__{s}", F.when(few, _last_line(plain))) for s, (_, plain) in pairs.items()}
    found = [F.when(line[s].isNotNull(), F.struct(line[s].alias("line_no"), F.lit(k).alias("rank"), F.lit(s).alias("section"))) for k, s in enumerate(pairs)]
    return F.array_sort(F.array_compact(F.array(*found)))


def _with_headers(docs: DataFrame, filing_type: str) -> DataFrame:
    """(doc_id, __l: lines, __h: headers): all inside the row, without a shuffle."""
    rows = docs.select("doc_id", F.split("text", "\n", -1).alias("__l"))
    md = {f"__{s}": _last_line(p) for s, (p, _) in dims.HEADERS[filing_type].items()}
    return rows.withColumns(md).select("doc_id", "__l", _found(filing_type).alias("__h"))


def last_headers(docs: DataFrame, filing_type: str = "10-K") -> DataFrame:
    """(doc_id, section, line_no): the last header line of each section."""
    return _with_headers(docs, filing_type).select("doc_id", F.explode("__h").alias("h")).select("doc_id", "h.section", "h.line_no")


def slices(docs: DataFrame, starts: DataFrame, order: list[str] | None = None) -> DataFrame:
    """(doc_id, section, start_line, end_line, text): from each start to the next start of the document or its end.

    Of starts on one line the one that is first in ``order`` is empty. Texts are trimmed."""
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("section")) if order else F.col("section")
    w = Window.partitionBy("doc_id").orderBy("line_no", rank)
    parts = starts.withColumn("end_line", F.lead("line_no").over(w))
    rows = parts.join(docs.select("doc_id", F.split("text", "\n", -1).alias("__l")), "doc_id")
    end = F.coalesce("end_line", F.size("__l"))
    text = F.array_join(F.slice("__l", F.col("line_no") + 1, end - F.col("line_no")), "\n")
    return rows.select("doc_id", "section", F.col("line_no").alias("start_line"), end.alias("end_line"), stripped(text).alias("text"))


def split_sections(docs: DataFrame, filing_type: str = "10-K") -> DataFrame:
    """(doc_id, section, start_line, end_line, text) of the target sections by headers: from each header to the next of any
    kind or the end. Of two on one line the first in order is empty. A projection: texts aren't shuffled."""
    rows = _with_headers(docs, filing_type)

    def part(h: Column, i: Column) -> Column:
        end = F.coalesce(F.get("__h", i + 1)["line_no"], F.size("__l"))
        text = F.array_join(F.slice("__l", h["line_no"] + 1, end - h["line_no"]), "\n")
        return F.struct(h["section"].alias("section"), h["line_no"].alias("start_line"), end.alias("end_line"), stripped(text).alias("text"))

    out = rows.select("doc_id", F.explode(F.transform("__h", part)).alias("p")).select("doc_id", "p.*")
    return out.where(F.col("section").isin(dims.TARGETS[filing_type]))


def valid_splits(sections: DataFrame, filing_type: str = "10-K") -> DataFrame:
    """(doc_id, n_sections, valid)."""
    n, how, wanted, critical, least = dims.VALIDITY[filing_type]
    has = [F.coalesce(F.bool_or(F.col("section") == s), F.lit(False)) for s in wanted]
    present = reduce(lambda a, b: a & b if how == "all" else a | b, has)
    long_enough = F.coalesce(F.bool_and(F.when(F.col("section").isin(critical), F.char_length("text") >= least)), F.lit(True))
    return sections.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_sections"), ((F.count(F.lit(1)) >= n) & present & long_enough).alias("valid"))


def section_warnings(docs: DataFrame, sections: DataFrame, filing_type: str = "10-K") -> DataFrame:
    """(doc_id, section, n_chars, expected) of sections that are missing (0 characters) or shorter than expected."""
    limits = F.explode(F.map_from_arrays(F.array(*[F.lit(k) for k in dims.MIN_CHARS[filing_type]]), F.array(*[F.lit(v) for v in dims.MIN_CHARS[filing_type].values()])))
    wanted = docs.select("doc_id", limits.alias("section", "expected"))
    found = wanted.join(sections.select("doc_id", "section", F.char_length("text").alias("n")), ["doc_id", "section"], "left")
    return found.select("doc_id", "section", F.coalesce("n", F.lit(0)).alias("n_chars"), "expected").where("n_chars < expected")


def toc_end(docs: DataFrame, most_lines: int = 300, gap: int = 10) -> DataFrame:
    """(doc_id, toc_end): three lines after the last of the first dense run of item lines; 130 or all lines without any."""
    item = lines(docs).where((F.col("line_no") < most_lines) & F.col("line").rlike(r"(?iU)item\s+\d+[abc]?\b"))
    w = Window.partitionBy("doc_id").orderBy("line_no")
    item = item.withColumn("far", (F.col("line_no") - F.lag("line_no").over(w) > gap).cast("int"))
    item = item.withColumn("island", F.sum(F.coalesce("far", F.lit(0))).over(w)).where("island = 0")
    ends = item.groupBy("doc_id").agg((F.max("line_no") + 3).alias("e"))
    total = F.size(F.split("text", "\n", -1))
    return docs.select("doc_id", F.least(F.lit(130), total).alias("d")).join(ends, "doc_id", "left").select("doc_id", F.coalesce("e", "d").alias("toc_end"))


def title_match(title: Column, filing_type: str = "10-K") -> Column:
    """The first section whose title's first 15 characters are in the text; null if none."""
    hits = [F.when(F.lower(title).contains(t[:15].lower()), F.lit(s)) for s, t in dims.TITLES[filing_type].items()]
    return F.coalesce(*hits)


def toc_rows(docs: DataFrame, filing_type: str = "10-K") -> DataFrame:
    """(doc_id, line_no, is_child, section, anchor, parent): rows of the contents table; children carry their parent's
    section, which a parent row without a known title resets to null."""
    rows = lines(docs).join(toc_end(docs), "doc_id").where((F.col("line_no") < F.col("toc_end")) & F.col("line").contains("|"))
    title = strip_md(F.col("line"))
    rows = rows.withColumn("title", title).where("title <> ''")
    rows = rows.withColumn("is_child", F.col("line").rlike(r"^\|\s*\|"))
    anchor = F.regexp_extract("line", r"\[.*?\]\(#([^)]+)\)", 1)
    rows = rows.withColumn("section", title_match(F.col("title"), filing_type)).withColumn("anchor", F.nullif(anchor, F.lit("")))
    parent = F.last(F.when(~F.col("is_child"), F.struct("section")), ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("line_no"))
    return rows.withColumn("parent", parent["section"]).select("doc_id", "line_no", "is_child", "section", "anchor", "parent")


def toc_anchors(docs: DataFrame, filing_type: str = "10-K") -> DataFrame:
    """(doc_id, section, anchor): each target section's first anchor, its own, its children's or a child's with its title."""
    rows = toc_rows(docs, filing_type).where("anchor is not null")
    claims = F.array_compact(F.array(F.when(F.col("is_child"), F.col("parent")), F.col("section")))
    c = rows.select("doc_id", "line_no", "anchor", F.posexplode(claims).alias("k", "section")).where(F.col("section").isin(dims.TARGETS[filing_type]))
    return c.groupBy("doc_id", "section").agg(F.min_by("anchor", F.struct("line_no", "k")).alias("anchor"))


def anchor_lines(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc_id, section, line_no): the first line with the section's [anchor:id]; lines are keyed by the ids that they hold."""
    marks = F.regexp_extract_all(F.replace("line", F.lit("\\_"), F.lit("_")), F.lit(r"\[anchor:([^\]]*)\]"))
    at = lines(docs).select("doc_id", "line_no", F.explode(marks).alias("anchor")).groupBy("doc_id", "anchor").agg(F.min("line_no").alias("line_no"))
    return anchors.join(at, ["doc_id", "anchor"]).select("doc_id", "section", "line_no")


def prefix_lines(docs: DataFrame, anchors: DataFrame, n: int = 30) -> DataFrame:
    """(doc_id, section, line_no): the first line that holds the first ``n`` characters of the section's anchor text."""
    rows = lines(docs).join(anchors, "doc_id").where(F.lower("line").contains(F.lower(F.substring("anchor", 1, n))))
    return rows.groupBy("doc_id", "section").agg(F.min("line_no").alias("line_no"))


def header_ladder(docs: DataFrame, filing_type: str = "10-K") -> DataFrame:
    """(doc_id, section, pattern, line_no): behind the contents, outside tables, the first line of the strictest pattern
    that any line meets: item and title, item alone, title alone."""
    body = lines(docs).join(toc_end(docs), "doc_id").where((F.col("line_no") >= F.col("toc_end")) & ~F.col("line").contains("|"))
    body = body.withColumn("clean", strip_md(F.col("line")))
    tests = []
    for s in dims.TARGETS[filing_type]:
        number, title = s.replace("item", ""), dims.TITLES[filing_type].get(s, "")[:20]
        for k, p in enumerate((rf"item\s+{number}[.\s]+\Q{title}\E", rf"item\s+{number}\s*\.", rf"\Q{title}\E")):
            tests.append(F.when(F.col("clean").rlike(rf"(?iU)^\s*{p}"), F.struct(F.lit(s).alias("section"), F.lit(k).alias("pattern"))))
    hits = body.select("doc_id", "line_no", F.explode(F.array_compact(F.array(*tests))).alias("h"))
    best = hits.groupBy("doc_id", "h.section").agg(F.min(F.struct("h.pattern", "line_no")).alias("b"))
    return best.select("doc_id", "section", "b.pattern", "b.line_no")


def toc_sections(docs: DataFrame, filing_type: str = "10-K") -> DataFrame:
    """Sections by the contents table: by anchor, else by the header ladder."""
    anchored = anchor_lines(docs, toc_anchors(docs, filing_type))
    ladder = header_ladder(docs, filing_type).select("doc_id", "section", "line_no").join(anchored, ["doc_id", "section"], "left_anti")
    return slices(docs, anchored.unionByName(ladder), dims.TARGETS[filing_type])


def tiered_sections(docs: DataFrame, filing_type: str = "10-K") -> DataFrame:
    """Sections by headers where that split is valid, else by contents, with the tier (1 or 2)."""
    one = split_sections(docs, filing_type)
    good = valid_splits(one, filing_type).where("valid").select("doc_id")
    rest = docs.join(good, "doc_id", "left_anti")
    return one.join(good, "doc_id", "left_semi").withColumn("tier", F.lit(1)).unionByName(toc_sections(rest, filing_type).withColumn("tier", F.lit(2)))


def notes_text(text: Column) -> Column:
    """From the first 'notes to financial statements' on; all if there is none."""
    at = F.regexp_instr(text, F.lit(f"(?iU){dims.NOTES_START}"))
    return F.when(at > 0, F.substring(text, at, F.char_length(text))).otherwise(text)


def statements_text(text: Column) -> Column:
    """What is before the notes; the first 5000 characters if there are none."""
    at = F.regexp_instr(text, F.lit(f"(?iU){dims.NOTES_START}"))
    return F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(F.substring(text, 1, 5000))


def notes(docs: DataFrame) -> DataFrame:
    """(doc_id, section, start_line, end_line, text) with section the note's letter, A to V; the last start of a letter counts."""
    only = docs.select("doc_id", notes_text(F.col("text")).alias("text"))
    letter = F.regexp_extract(F.trim("line"), r"(?U)^([A-V])\.\s+\S", 1)
    starts = lines(only).withColumn("section", letter).where("section <> ''").groupBy("doc_id", "section").agg(F.max("line_no").alias("line_no"))
    return slices(only, starts)


def grouped_notes(docs: DataFrame) -> DataFrame:
    """(doc_id, grp, text): notes joined by group in the group's order, others as fn_other by letter; a document without
    notes is all fn_revenue."""
    rows = [(x, g, i) for g, ls in dims.NOTE_GROUPS.items() for i, x in enumerate(ls)]
    groups = F.broadcast(docs.sparkSession.createDataFrame(rows, "section STRING, grp STRING, pos INT"))  # 22 letters
    n = notes(docs).join(groups, "section", "left")
    n = n.withColumn("grp", F.coalesce("grp", F.lit("fn_other"))).withColumn("pos", F.coalesce("pos", F.ascii("section")))
    joined = n.groupBy("doc_id", "grp").agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("t")).select("doc_id", "grp", F.array_join(F.col("t.text"), "\n\n").alias("text"))
    without = docs.join(n.select("doc_id").distinct(), "doc_id", "left_anti")
    return joined.unionByName(without.select("doc_id", F.lit("fn_revenue").alias("grp"), notes_text(F.col("text")).alias("text")))


def assembled(docs: DataFrame, sections: DataFrame, filing_type: str = "10-K") -> DataFrame:
    """(doc_id, item1_current, item1a_current, item7_current, partiii_current, item8_fs, fn_combined) of documents by their
    sections: what tasks take. A 10-Q has its statements in item1 and its discussion in item2, no business section, no Part
    III, and its notes in one piece."""
    wanted = dims.INPUT_SECTIONS[filing_type]
    statements = "item1" if filing_type == "10-Q" else "item8"
    names = sorted({x for xs in wanted.values() for x in xs} | {statements})
    of = lambda k: F.coalesce(F.max(F.when(F.col("section") == k, F.col("text"))), F.lit("")).alias(k)
    rows = docs.select("doc_id").join(sections.select("doc_id", "section", "text"), "doc_id", "left").groupBy("doc_id").agg(*map(of, names))
    inputs = [F.concat_ws("\n", *[F.col(x) for x in xs]).alias(k) if xs else F.lit("").alias(k) for k, xs in wanted.items()]
    combined = notes_text(F.col(statements)) if filing_type == "10-Q" else F.lit(None).cast("string")
    return rows.select("doc_id", *inputs, statements_text(F.col(statements)).alias("item8_fs"), combined.alias("fn_combined"))


def located_sections(docs: DataFrame, wanted: DataFrame, filing_type: str = "10-K") -> DataFrame:
    """``tiered_sections``, and for documents that neither tier gives anything the sections at the places that ``wanted``
    (doc_id, section, anchor: a line's beginning, as a provider gives it) names, as tier 3."""
    found = tiered_sections(docs, filing_type)
    rest = docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti")
    at = prefix_lines(rest, wanted)
    return found.unionByName(slices(rest, at.select("doc_id", "section", "line_no"), dims.TARGETS[filing_type]).withColumn("tier", F.lit(3)))
