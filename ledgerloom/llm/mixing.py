"""Mixing sources to target weights along a curriculum, in DataFrame operations only.

Each source gets a target: its share of all words by weight, never above ``most`` times its own words; what is above
goes to the others by weight. A source's weight over training time t in [0, 1] runs in a straight line from (1 - tilt)
to (1 + tilt) times its mean, so the words it has given by time t are target * (t - tilt * t * (1 - t)). A document
copy whose words begin at c of the target takes the position t at which that demand reaches c. Documents are then
range-sorted by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._shared import WORD_PATTERN, written


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Sources by code point, null last, weigh 1, 2, .., ``cycle``, repeating; and tilt +0.5, 0, -0.5 in turn."""
    w = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(w) - 1
    return sources.withColumn("weight", (1 + place % cycle).cast("double")).withColumn("tilt", (0.5 - 0.5 * (place % 3)).cast("double"))


def targets(sources: DataFrame, most: float = 3.0) -> DataFrame:
    """(source, source_size, weight, ..) with column target: shares of the whole by weight, stopped at most * source_size.

    With sources in order of cap / weight, the first at which the rest's common level stays under its own ratio ends the
    capped ones. It is one row per source: a table of counts, not of documents. Sources of size or weight 0 get 0."""
    cap = F.lit(float(most)) * F.col("source_size")
    live = (F.col("weight") > 0) & (F.col("source_size") > 0)
    s = sources.withColumn("__cap", F.when(live, cap).otherwise(0.0)).withColumn("__w", F.when(live, F.col("weight")).otherwise(0.0))
    s = s.withColumn("__ratio", F.when(live, F.col("__cap") / F.col("__w")).otherwise(-1.0))
    by = Window.orderBy("__ratio", F.col("source").asc_nulls_last())
    before, after, whole = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    total = F.sum("source_size").over(whole)
    s = s.withColumn("__level", (total - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / F.sum("__w").over(after))
    s = s.withColumn("__rest", F.min(F.when((F.col("__ratio") >= 0) & (F.col("__level") <= F.col("__ratio")), F.struct("__ratio", "__level"))).over(whole)["__level"])
    target = F.when(F.col("__w") == 0, 0.0).otherwise(F.least(F.col("__cap"), F.coalesce(F.col("__rest") * F.col("__w"), F.col("__cap"))))
    return s.withColumn("target", target).drop("__cap", "__w", "__ratio", "__level", "__rest")


def _running(rows: DataFrame, sums: DataFrame) -> DataFrame:
    """Column before: words of the source ahead of this row in the order of a hash of the document.

    A source is cut by its hash into ranges that are summed side by side, so none is one task's work; the ranges' own
    sums are a small table (sources x buckets rows at most)."""
    ahead = Window.partitionBy("source").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sums.select(F.col("source").alias("__s"), F.col("__b").alias("__sb"), F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__first"))
    within = Window.partitionBy("source", "__b").orderBy("__h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("__k", F.coalesce(F.sum("size").over(within), F.lit(0)))
    out = out.join(firsts, out["source"].eqNullSafe(F.col("__s")) & (out["__b"] == F.col("__sb")), "left")
    return out.withColumn("before", (F.col("__k") + F.col("__first")).cast("long")).drop("__k", "__first", "__b", "__h", "__s", "__sb")


def _planned(rows: DataFrame, sums: DataFrame, weigh, most: float) -> DataFrame:
    sizes = sums.groupBy("source").agg(F.sum("__sum").cast("long").alias("source_size"))
    rows = _running(rows, sums)
    by_source = targets(weigh(sizes), most).select(F.col("source").alias("__s"), "source_size", "target", "tilt")
    out = rows.join(by_source, rows["source"].eqNullSafe(F.col("__s")), "left").drop("__s")
    whole = F.floor(F.col("target"))
    times = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0)
    left = whole - times * F.col("source_size")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("before")))
    return out.withColumn("taken", (times * F.col("size") + extra).cast("long"))


def _keyed(rows: DataFrame, buckets: int, seed: int) -> DataFrame:
    return rows.withColumn("__h", F.xxhash64(F.lit(seed), "doc_id", "size")).withColumn("__b", F.shiftrightunsigned("__h", 64 - (buckets - 1).bit_length()))


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source", "__b").agg(F.sum("size").alias("__sum"))


def plan_mix(docs: DataFrame, weigh=cyclic_weights, most: float = 3.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", buckets: int = 512, seed: int = 8) -> DataFrame:
    """Per document: doc_id, source, size (words), source_size, target, tilt, before (words ahead of it in its source's
    order) and taken (words the mix takes, repeats counted).

    weigh: gives (source, source_size) its columns weight and tilt. Every document is taken floor(target / source_size)
    times; the rest of the target goes to the first documents of the order, the last of them in part, so that a
    source's taken words are its target rounded down. The order is a hash of id and size: reruns agree. Null texts and
    texts without words have size 0 and give 0 words; a null source is a source of its own, last. Empty table: no rows."""
    size = word_count(F.col(text_col).cast("string"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"))
    rows = _keyed(written(rows, "mix"), buckets, seed)  # ids and sizes only: texts are read once
    return _planned(rows, _sums(rows), weigh, most)


def mix_documents(docs: DataFrame, weigh=cyclic_weights, most: float = 3.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", buckets: int = 512, seed: int = 8) -> DataFrame:
    """The rows of ``docs`` as the plan takes them, in training order: a document taken n times has n rows, and one taken
    in part ends after that many words. Documents of which nothing is taken are left out, and so are null texts and those
    without words. Null sources and ids, ties and repeated rows as in ``plan_mix``; an empty table gives no rows.

    Rows travel with their texts twice: into the source's hash ranges, and into the order of positions."""
    size = word_count(F.col(f"`{text_col}`").cast("string"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), size.alias("size"), whole.alias("row"))
    rows = _keyed(rows, buckets, seed)
    plan = _planned(rows, written(_sums(rows.drop("row")), "mix-sums"), weigh, most)
    copies = _copies(plan).orderBy("position", F.col("doc_id").asc_nulls_first(), "copy")
    text = F.col(f"row.`{text_col}`")
    part = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD_PATTERN), F.lit(0)), 1, F.col("words").cast("int")), "")
    text = F.when(F.col("words") < F.col("size"), part).otherwise(text)
    return copies.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def position(copy: Column) -> Column:
    """Training position in [0, 1) of a document's copy: where its source's demand reaches copy * source_size + before,
    target * (t - tilt * t * (1 - t)) inverted; null for documents of which nothing is taken."""
    d = (copy * F.col("source_size") + F.col("before")) / F.col("target")
    a = F.col("tilt")
    t = F.when(F.abs(a) < 1e-9, d).otherwise((-(1 - a) + F.sqrt((1 - a) * (1 - a) + 4 * a * d)) / (2 * a))
    return F.when(F.col("taken") > 0, t + F.lit(0.0))


def copies_taken() -> Column:
    """Copies of a document that the mix takes, a part of one counted; 0 where nothing is taken."""
    return F.ceil(F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("int")


def positions() -> Column:
    """Training positions of all copies of a document that the mix takes, in order; an empty array where it takes none."""
    n = copies_taken()
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), position)).otherwise(F.array().cast("array<double>"))


def _copies(plan: DataFrame) -> DataFrame:
    copies = plan.where(F.col("taken") > 0).withColumn("copy", F.explode(F.sequence(F.lit(0), copies_taken() - 1)))
    words = F.least(F.col("size"), F.col("taken") - F.col("copy") * F.col("size")).cast("long")
    return copies.withColumn("words", words).withColumn("position", position(F.col("copy")))


def mixed_order(plan: DataFrame) -> DataFrame:
    """One row per copy (doc_id, source, copy, words, position), range-sorted into training order; ties by doc_id, copy.

    A document has at most ``most`` + 1 copies."""
    return _copies(plan).select("doc_id", "source", "copy", "words", "position").orderBy("position", F.col("doc_id").asc_nulls_first(), "copy")
