"""Line deduplication on levelled sorted runs of line hashes.

Documents come in batches by falling ranges of ids, so that the first batch to bring a line holds it in its largest id.
A batch's distinct line hashes are merge-anti-joined with the runs: those that no run has are added as a run of level 0,
with that id; those that a run has, or that the batch itself has more than once, are repeats. When a level has ``fanout``
runs they are compacted into one run of the next level, so n batches leave about fanout * log(n) runs.

A run is a bucketed table, sorted within each bucket. A batch is shuffled once, to the same buckets, and neither joins
with runs nor compaction shuffle a run. Repeats alone are counted after the last batch: a line goes if enough documents
have it. Texts are cut in Arrow batches, in time linear in their lines."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import ASCII_SPACE, CLEANUP, blocks, drop_written, settings, text_array, without_case, written, written_path

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["h1", "h2"]
#: A bucket is always read by one task, and so written as one file; a bucket that is one file is read in its order.
RUN_SETTINGS = {CLEANUP: "true", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}
#: Spark's xxhash64(1, x) hashes x from the seed that 1 gives.
_SEED = xxhash.xxh64_intdigest(struct.pack("<i", 1), 42)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(ASCII_SPACE)), _UPPER, _LOWER)


def _hashes(key: Column) -> Column:
    """128 bits of a key."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def key_hashes(line: bytes) -> bytes:
    """The same 128 bits of a line's key, from its UTF-8 bytes."""
    key = line.strip(b" \t\n\x0b\f\r").lower()
    return struct.pack(">QQ", xxhash.xxh64_intdigest(key, 42), xxhash.xxh64_intdigest(key, _SEED))


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc_id, h1, h2): the keys of at least ``min_chars`` code points, once per row."""
    lines = F.split(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), "\n", -1)
    keys = F.transform(F.array_distinct(F.filter(F.transform(lines, line_key), lambda k: F.char_length(k) >= min_chars)), _hashes)  # distinct strings are hashed, structs compared
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.explode(keys).alias("k")).select("doc_id", "k.h1", "k.h2")


class LineRuns:
    """Levels of sorted runs (h1, h2, last) over disjoint keys; ``last`` is the largest id that holds the line."""

    def __init__(self, spark: SparkSession, fanout: int = 2, buckets: int | None = None):
        self.spark, self.fanout, self.levels = spark, fanout, []
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.repeats: list[DataFrame] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        path = written_path(self.spark, "line-run")
        with settings(self.spark, RUN_SETTINGS):
            rows.write.bucketBy(self.buckets, *_KEY).sortBy(*_KEY).option("path", path).format("parquet").saveAsTable(name)
        out = self.spark.table(name)
        out.written_at, out.name = path, name
        return out

    def forget(self, *tables: DataFrame) -> None:
        for t in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {t.name}")
        drop_written(*tables)

    def joined(self, keys: DataFrame) -> DataFrame:
        """(h1, h2, n, last, held) of a batch's distinct keys: n documents of the batch, the largest id among them, and the id
        that the runs have for the line, or null."""
        out = keys.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last")).withColumn("held", F.lit(None).cast("struct<id:long>"))
        for run in self.runs():
            r = run.select(*_KEY, F.struct(F.col("last").alias("id")).alias("r")).hint("merge")
            out = out.join(r, _KEY, "left").select(*_KEY, "n", "last", F.coalesce("held", "r").alias("held"))
        return out

    def add(self, keys: DataFrame, is_last: bool = False) -> None:
        """Take a batch's (doc_id, h1, h2), of smaller ids than all before."""
        batch = self._bucketed(self.joined(keys))
        again = batch.where("held is not null or n > 1")
        again = again.select(*_KEY, F.when(F.col("held").isNull(), F.col("n") - 1).otherwise(F.col("n")).alias("n"), F.when(F.col("held").isNull(), F.col("last")).otherwise(F.col("held.id")).alias("last"))
        self.repeats.append(written(again, "line-repeats"))
        if is_last:
            self.forget(batch)
            return
        run, level = self._bucketed(batch.where("held is null").select(*_KEY, "last")), 0
        self.forget(batch)
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                return
            full, self.levels[level] = self.levels[level], []
            run, level = self.compacted(full), level + 1
            self.forget(*full)

    def compaction(self, runs: list[DataFrame]) -> DataFrame:
        """The rows of several runs, bucket by bucket: their keys are disjoint, so nothing is left to combine."""
        out = runs[0]
        for run in runs[1:]:
            out = out.unionByName(run)
        return out.groupBy(*_KEY).agg(F.max("last").alias("last"))

    def compacted(self, runs: list[DataFrame]) -> DataFrame:
        return self._bucketed(self.compaction(runs))

    def common(self, min_docs: int) -> DataFrame:
        """(h1, h2, last) of the lines that at least ``min_docs`` documents hold, by the repeats alone."""
        rows = self.repeats[0]
        for more in self.repeats[1:]:
            rows = rows.unionByName(more)
        return rows.groupBy(*_KEY).agg(F.sum("n").alias("n"), F.max("last").alias("last")).where(F.col("n") >= min_docs - 1).select(*_KEY, "last")


def _falling_batch(docs: DataFrame, doc_id: Column, n_batches: int) -> Column:
    """The number of an id's batch: ranges of ids from the largest down, null last, about even in documents."""
    shares = [(n_batches - i) / n_batches for i in range(1, n_batches)]
    edges = docs.agg(F.percentile_approx(doc_id, F.array(*map(F.lit, shares)), 1000)).first()[0] if shares else []
    batch = F.lit(0)
    for edge in edges or []:
        batch = batch + F.when(doc_id > edge, 0).otherwise(1)
    return batch


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines whose key's hash is among the row's go."""
    for batch in batches:
        texts = text_array(batch.column(1))
        for a, b in blocks(texts):
            out, n_lines, n_dropped = [], [], []
            for text, gone in zip(texts.slice(a, b - a).cast(pa.large_binary()).to_pylist(), batch.column(2).slice(a, b - a).to_pylist(), strict=True):
                n, dropped = text.count(b"\n") + 1, 0
                if gone:
                    hashes = {gone[i : i + 16] for i in range(0, len(gone), 16)}
                    stay = [x for x in text.split(b"\n") if key_hashes(x) not in hashes]
                    dropped = n - len(stay)
                    text = b"\n".join(stay)
                out.append(text)
                n_lines.append(n)
                n_dropped.append(dropped)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(out, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], ["row", "text", "n_lines", "n_dropped"])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3, n_batches: int = 4, fanout: int = 2) -> DataFrame:
    """``docs`` with column ``text_col`` cut to the lines that stay, and with n_lines (before) and n_dropped.

    A line whose key has at least ``min_chars`` code points and is in at least ``min_docs`` documents stays only in the
    document with the largest id that holds it; there all its lines stay. A null or empty text is one empty line. Rows
    that repeat an id are one document: it counts once for a line, and all its rows lose or keep the line alike. A null id is
    smaller than all others, each row with it is a document, and they keep a line that only such rows hold. An empty table gives no
    rows. Columns of ``docs`` that are named n_lines or n_dropped, in any case, give way."""
    spark = docs.sparkSession
    others = [c for c in without_case(docs.columns, ("n_lines", "n_dropped")) if c != text_col]
    keys = line_keys(docs, id_col, text_col, min_chars)
    one = F.col(f"`{id_col}`").cast("long").alias("doc_id")
    if not docs.select(one).where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        keys = keys.where("doc_id is not null").distinct().union(keys.where("doc_id is null"))
    keys = written(keys.withColumn("batch", _falling_batch(docs.select(one), F.col("doc_id"), n_batches)), "line-keys", "batch")
    runs = LineRuns(spark, fanout)
    for i in range(n_batches):
        runs.add(keys.where(F.col("batch") == i).drop("batch"), i == n_batches - 1)
    held = written(runs.common(min_docs), "line-held").hint("merge")  # a table of its own: a key that very many lines have can be split
    runs.forget(*runs.runs())
    gone = keys.join(held, _KEY).where(F.col("last").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("last")))
    packed = F.concat(*[F.lpad(F.hex(c), 16, "0") for c in _KEY])
    gone = gone.select("doc_id", packed.alias("k")).groupBy("doc_id").agg(F.array_join(F.collect_set("k"), "").alias("k"))
    gone = gone.select(F.col("doc_id").alias("__id"), F.unhex("k").alias("__gone")).hint("merge")
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    rows = docs.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"), one).join(gone, F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    rows = rows.select("row", "text", "__gone")
    kind = rows.select("row").schema.add("text", "string").add("n_lines", "long").add("n_dropped", "long")
    out = rows.mapInArrow(_cut, kind)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in without_case(docs.columns, ("n_lines", "n_dropped"))], "n_lines", "n_dropped")
