"""Quality rules with thresholds learnt per language and source.

Each text is measured once in vectorised blocks. Four ratios of the documents that pass the fixed base rules go into
mergeable quantile sketches: counts per bucket, a bucket being a value rounded down to its BITS leading bits, so that a
quantile is off by 1/256 of its value at most and sketches of parts, sources or days merge by adding counts. A group's
fence lies beyond an upper quantile of its sketch by a multiple of that quantile's distance from the median (and for word
length below a lower one), so it moves with what is usual in the group. The quantile is as far out as the junk that the
base rules let through allows. A group of under LEAST documents uses its language's merged sketch, and a language of
under LEAST that of all. A few units on top (letters, symbols, lines, words), the same for a text of any length, keep
short texts from failing by one repeated line. The small table of fences is joined back to filter."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ._shared import ASCII_SPACE, blocks, rows_of, split_words, text_array, word_ids, written

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: ratio: (of what, per what, times, upper and lower quantile in %, reach, units on top)
RATIOS = {
    "word_length": ("word_chars", "n_words", 1000, 75, 25, 16, 60),
    "symbols": ("n_symbols", "n_words", 1000, 90, None, 4, 8),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 98, None, 4, 2),
    "repeats": ("n_repeat_words", "n_words", 1000, 98, None, 4, 40),
}
#: A ratio is never held closer than this, in thousandths: 1% is below what a writer minds.
CLOSEST, LEAST, MIN_WORDS, BITS = 10, 200, 50, 9
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))


def _per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[offsets])


def _repeat_words(ids: np.ndarray, n_distinct: int, offsets: np.ndarray) -> np.ndarray:
    """Words in three-word windows found twice or more in their text."""
    row, covered = rows_of(offsets), np.zeros(len(ids), bool)
    if len(ids) >= 3:
        at = np.flatnonzero(row[:-2] == row[2:])
        if (len(offsets) - 1) * float(n_distinct) ** 3 < 2**63:
            code = ((row[at] * n_distinct + ids[at]) * n_distinct + ids[at + 1]) * n_distinct + ids[at + 2]
        else:
            pair = np.unique(row[at] * n_distinct + ids[at], return_inverse=True)[1]
            pair = np.unique(pair * n_distinct + ids[at + 1], return_inverse=True)[1]
            code = pair * n_distinct + ids[at + 2]
        ordered = np.sort(code)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            place = np.minimum(np.searchsorted(twice, code), len(twice) - 1)
            found = at[twice[place] == code]
            covered[found] = covered[found + 1] = covered[found + 2] = True
    return _per_row(covered, offsets)


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """MEASURES of each text of a block (large_string, no nulls)."""
    n = len(texts)
    offsets, flat = split_words(texts)
    ids, words = word_ids(flat)
    letters = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[edges[0] : edges[-1]] if edges[-1] > edges[0] else np.zeros(0, np.uint8)
    split = pc.split_pattern(texts, "\n")
    line_offsets, lines = split.offsets.to_numpy().astype(np.int64), split.flatten()
    line_offsets = line_offsets - line_offsets[0]
    coded, distinct = word_ids(lines)
    worded = pc.binary_length(pc.ascii_trim(distinct, characters=ASCII_SPACE)).to_numpy(zero_copy_only=False)[coded] > 0
    n_lines = _per_row(worded, line_offsets)
    pairs = np.unique((rows_of(line_offsets) * max(len(distinct), 1) + coded)[worded])
    n_distinct = np.bincount(pairs // max(len(distinct), 1), minlength=n)
    return {
        "n_words": np.diff(offsets), "word_chars": _per_row(letters[ids], offsets), "n_symbols": _per_row(_SYMBOL[data], edges - edges[0]),
        "n_dup_lines": n_lines - n_distinct, "n_repeat_words": _repeat_words(ids, len(words), offsets), "n_lines": n_lines,
    }


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_array(batch.column(1))
        for a, b in blocks(texts):
            found = measure(texts.slice(a, b - a))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(found[k].astype(np.int64)) for k in MEASURES)], ["row", *MEASURES])


def measured(rows: DataFrame, text_col: str) -> DataFrame:
    """All columns of ``rows`` as struct ``row``, beside MEASURES of its texts; no shuffle."""
    kind = T.StructType([T.StructField("row", rows.schema), *(T.StructField(k, T.LongType()) for k in MEASURES)])
    sent = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return sent.mapInArrow(_measured, kind)


def base_failed(min_words: int = MIN_WORDS) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _ratio(name: str) -> Column:
    of, per, times = RATIOS[name][:3]
    return F.when(F.col(per) > 0, F.expr(f"({of} * {times}) div {per}")).otherwise(F.lit(0).cast("long"))


def sketches(scored: DataFrame, groups: list[str], min_words: int = MIN_WORDS) -> DataFrame:
    """(groups.., ratio, bucket, n): quantile sketches of the documents that pass the base rules."""
    values = F.array(*[F.struct(F.lit(k).alias("ratio"), _ratio(k).alias("v")) for k in RATIOS])
    rows = scored.where(~base_failed(min_words)).select(*groups, F.explode(values).alias("x")).select(*groups, "x.ratio", "x.v")
    drop = F.greatest(F.length(F.bin("v")) - BITS, F.lit(0))
    bucket = F.expr("shiftleft(shiftright(v, d), d)")
    return rows.withColumn("d", drop).groupBy(*groups, "ratio", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, groups: list[str]) -> DataFrame:
    return sketch.groupBy(*groups, "ratio", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """(groups.., n_docs, and a column of thousandths for each of ``_limits``) from quantiles of the sketches.

    A window runs over the buckets of one sketch, of which there are some thousand at most."""
    by = Window.partitionBy(*groups, "ratio").orderBy("bucket")
    s = sketch.withColumn("below", F.sum("n").over(by)).withColumn("all", F.sum("n").over(Window.partitionBy(*groups, "ratio")))
    q = lambda p: F.min(F.when(F.col("below") * 100 >= F.col("all") * p, F.col("bucket")))
    places = sorted({50, *(p for x in RATIOS.values() for p in x[3:5] if p is not None)})
    s = s.groupBy(*groups, "ratio").agg(F.max("all").alias("n_docs"), *[q(p).alias(f"q{p}") for p in places])
    out = []
    for name, (_, _, _, up, down, reach, _) in RATIOS.items():
        at, mid = F.col("ratio") == name, F.col("q50")
        out.append(F.max(F.when(at, F.col(f"q{up}") + reach * (F.col(f"q{up}") - mid) + CLOSEST)).alias(f"{name}_high"))
        if down is not None:
            out.append(F.max(F.when(at, F.col(f"q{down}") - reach * (mid - F.col(f"q{down}")) - CLOSEST)).alias(f"{name}_low"))
    return s.groupBy(*groups).agg(F.max("n_docs").alias("n_docs"), *out)


def _limits() -> list[str]:
    return [f"{k}_{side}" for k, x in RATIOS.items() for side in (("high", "low") if x[4] is not None else ("high",))]


def thresholds(scored: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Fences per (lang, source), of the language or of all where a group is small; one row per group."""
    own = written(sketches(scored, ["lang", "source"], min_words), "sketch")
    limits = _limits()
    named = lambda df, p: df.select(*[F.col(c).alias(p + c) for c in df.columns])
    by_lang, by_all = named(fences(merged(own, ["lang"]), ["lang"]), "l_"), named(fences(merged(own, []), []), "a_")
    rows = fences(own, ["lang", "source"])
    rows = rows.join(by_lang, rows["lang"].eqNullSafe(F.col("l_lang")), "left").crossJoin(F.broadcast(by_all))  # one row
    pick = lambda c: F.when(F.col("n_docs") >= LEAST, F.col(c)).when(F.col("l_n_docs") >= LEAST, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}"))
    return rows.select("lang", "source", *[pick(c).cast("long").alias(c) for c in limits])


def judged(scored: DataFrame, limits: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` with base_failed and kept. A group all of whose documents fail the base rules has no fences and none kept."""
    own = limits.select(F.col("lang").alias("__l"), F.col("source").alias("__s"), *_limits())
    out = scored.join(own, F.col("lang").eqNullSafe(F.col("__l")) & F.col("source").eqNullSafe(F.col("__s")), "left")
    fine = F.lit(True)
    for name, (of, per, times, _, down, _, units) in RATIOS.items():
        fine = fine & (F.col(of) * times <= F.col(f"{name}_high") * F.col(per) + units * times)
        if down is not None:
            fine = fine & (F.col(of) * times >= F.col(f"{name}_low") * F.col(per) - units * times)
    failed = base_failed(min_words)
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(fine, F.lit(True))).drop("__l", "__s", *_limits())


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, MEASURES, base_failed, kept.

    A null or empty text has no words and fails the base rules. A null language or source is a group of its own.
    Repeated rows keep their rows; an empty table gives none; other columns are ignored."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    texts = F.struct("doc_id", "lang", "source")
    narrow = rows.select(texts.alias("row"), "text").mapInArrow(_measured, T.StructType([T.StructField("row", rows.drop("text").schema), *(T.StructField(k, T.LongType()) for k in MEASURES)]))
    scored = written(narrow.select("row.*", *MEASURES), "measures")
    return judged(scored, thresholds(scored)).select("doc_id", *MEASURES, "base_failed", "kept")


def quality_filter(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` that ``quality_report`` keeps, with all their columns; min_words: of the base rules.

    Nulls, empty texts and repeated rows as there; an empty table gives no rows. Texts are measured twice, once for the sketches and once for the filter, rather than shuffled or written."""
    groups = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    first = groups.select(F.struct("lang", "source").alias("row"), "text").mapInArrow(_measured, T.StructType([T.StructField("row", groups.drop("text").schema), *(T.StructField(k, T.LongType()) for k in MEASURES)]))
    limits = written(thresholds(first.select("row.*", *MEASURES), min_words), "fences")
    scored = measured(docs, text_col).withColumn("lang", F.col(f"row.`{lang_col}`").cast("string")).withColumn("source", F.col(f"row.`{source_col}`").cast("string"))
    return judged(scored, limits, min_words).where("kept").select("row.*")
