"""Harmonic packing of documents into sequences of fixed capacity.

A length s with capacity // s == k belongs to class k: k such pieces share a bin. What is left of a document after its
whole sequences is cut to the slot sizes capacity // k, largest first, so bins of a class come out full. Each worker (a
hash bucket of pieces) fills its classes' bins with exactly k pieces each, on its own. Pieces of bins that a worker
can't fill go to a sixteenth as many workers, and so on to one; what that one can't fill is bounded by the classes
(below 11,000 pieces, whatever the input) and is packed first-fit by falling length.

Where an order of the documents is given, a worker is a range of it instead of a hash bucket, a coarser worker is a range
of ranges, and sequences are numbered by their ranges: read by sequence_id, the corpus is in that order up to the ranges
that a bin was filled from."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._shared import blocks, split_words, text_array, word_ids, written
from ._tokens import encoder, units_of

#: Pieces that a worker gets, about; and by how much the workers are fewer at each level.
PER_WORKER, FEWER = 20_000, 16
#: First numbers of the sequences of whole pieces, where there is no order, and of the last step.
WHOLE, LAST = 6 << 60, 7 << 60


def cuts(length: int, capacity: int, spare: float = 0.01) -> list[int]:
    """Piece lengths of a document: whole sequences, then slot sizes; a rest within ``spare`` of its slot stays whole."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        slot = capacity // (capacity // rest)  # the smallest slot that holds all of it
        if slot - rest <= spare * slot:
            out.append(rest)
            break
        out.append(capacity // -(-capacity // rest))  # the largest slot that it fills
        rest -= out[-1]
    return out


def token_ids(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a block's texts, each followed by ``end_id``, in one array with offsets."""
    offsets, flat = split_words(texts)
    word, words = word_ids(flat)
    units, head, tail = units_of(words)
    ids, edges = encoder(path).ids(units)
    has = (tail >= 0)[word]
    place = np.arange(len(word)) + np.concatenate([[0], np.cumsum(has)])[:-1] if len(word) else np.zeros(0, np.int64)
    order = np.empty(len(word) + int(has.sum()), np.int64)
    order[place] = head[word]
    order[place[has] + 1] = tail[word][has]
    size = np.diff(edges)[order]
    done = np.concatenate([[0], np.cumsum(size)])
    taken = ids[np.arange(done[-1]) + np.repeat(edges[:-1][order] - done[:-1], size)] if len(order) else ids[:0]
    units_before = np.concatenate([place, [len(order)]])[offsets]
    ends = done[units_before]
    return np.insert(taken, ends[1:], end_id).astype("<u4"), ends + np.arange(len(ends))


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str, order: Column) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, k, worker) of every piece, k being its class; no shuffle."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, list[int]] = {}
        for batch in batches:
            texts = text_array(batch.column(1))
            for a, b in blocks(texts):
                flat, edges = token_ids(texts.slice(a, b - a), tokenizer, end_id)
                data, row, start, length, crc = memoryview(flat).cast("B"), [], [], [], []
                for i, (x, y) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
                    rest = (y - x) % capacity
                    if rest not in known:
                        known[rest] = cuts(rest, capacity)
                    at = x
                    for n in [capacity] * ((y - x) // capacity) + known[rest]:
                        row.append(i)
                        start.append(at - x)
                        length.append(n)
                        crc.append(zlib.crc32(data[4 * at : 4 * (at + n)]))
                        at += n
                own = batch.column(0).slice(a, b - a).take(pa.array(row, pa.int64()))
                size = np.array(length, np.int64)
                total = np.diff(edges)[np.array(row, np.int64)]
                yield pa.RecordBatch.from_arrays([own, pa.array(start, pa.int64()), pa.array(size), pa.array(crc, pa.int64()), pa.array(total), pa.array((capacity // size).astype("i4")), batch.column(2).slice(a, b - a).take(pa.array(row, pa.int64()))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "k", "worker"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), order.cast("long").alias("worker"))
    return rows.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, k int, worker long")


def _first_fit(capacity: int):
    def fit(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        room = np.full(rows.num_rows, capacity, np.int64)
        bins, offsets = [], []
        for n in rows["length"].to_pylist():
            j = int(np.argmax(room >= n))
            bins.append(LAST + j)
            offsets.append(capacity - int(room[j]))
            room[j] -= n
        return rows.append_column("sequence_id", pa.array(bins, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return fit


def file_order(rows_each: int = PER_WORKER // 4) -> Column:
    """A range's number for each row of a table as Spark wrote it in sorted order: by the number of its file and its place there."""
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    return part * (1 << 20) + F.least(F.expr(f"_metadata.row_index div {rows_each}"), F.lit((1 << 20) - 1))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", order: Column | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids end with ``end_id``, so a null or empty text is one piece of length 1 and no document is without
    pieces. Null and repeated ids keep their rows. Sequence ids are unique, not consecutive. An empty table gives no
    rows. Other columns are ignored. order: a range's number (not negative, null last) for each row; sequences are then numbered
    along it."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    numbered = F.coalesce(order, F.lit((1 << 62) - 1)) if order is not None else F.lit(0)
    rows = written(pieces(docs, tokenizer, capacity, end_id, id_col, text_col, numbered), "pieces")
    by_order = ["doc_id", "start", "ids_crc32", "length"]
    if order is None:
        n = rows.count()
        whole = rows.where("k = 1").withColumn("sequence_id", F.lit(WHOLE) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
        out, rest = [whole], rows.where("k > 1").withColumn("__w", F.pmod(F.xxhash64(*by_order), F.lit(1 << 24)))
        steps = [max(1, (1 << 24) // (1 << max(0, (n - 1) // PER_WORKER).bit_length()))]
        most = 1 << 24
    else:
        ranks = written(rows.select("worker").distinct(), "ranges")
        ranks = written(_numbered(ranks), "ranges")
        out, rest = [], rows.join(ranks.hint("merge"), "worker").withColumnRenamed("__n", "__w")
        steps, most = [1], (ranks.agg(F.max("__n")).first()[0] or 0) + 1
    while steps[-1] < most:
        steps.append(steps[-1] * FEWER)
    for level, step in enumerate(steps):
        d = rest.withColumn("__g", F.expr(f"__w div {step}"))
        by = Window.partitionBy("__g", "k")
        d = d.withColumn("__i", F.row_number().over(by.orderBy("__w", *by_order)) - 1).withColumn("__n", F.count(F.lit(1)).over(by))
        d = d.withColumn("__bin", F.expr("__i div k")).withColumn("__full", F.col("__bin") < F.expr("__n div k"))
        if level + 1 < len(steps):
            d = written(d, f"level{level}")
        inside = Window.partitionBy("__g", "k", "__bin").orderBy("__i").rowsBetween(Window.unboundedPreceding, -1)
        # by range first: 26 bits of its beginning, 3 of the level, 12 of the class, 20 of the bin
        name = (F.col("__g") * step) * F.lit(1 << 35) + F.lit(level).cast("long") * F.lit(1 << 32) + F.col("k").cast("long") * F.lit(1 << 20) + F.col("__bin")
        out.append(d.where("__full").withColumn("sequence_id", name).withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))))
        rest = d.where("not __full").select(*names, "k", "__w")
    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    out.append(rest.select(*names).groupBy().applyInArrow(_first_fit(capacity), kind))
    done = out[0].select(*names, "sequence_id", "offset")
    for d in out[1:]:
        done = done.unionByName(d.select(*names, "sequence_id", "offset"))
    return done


def _numbered(ranges: DataFrame) -> DataFrame:
    """(worker, __n) of the ranges: their places in order. It is one row for PER_WORKER pieces or a file, so one task's work."""
    return ranges.withColumn("__n", F.row_number().over(Window.orderBy("worker")).cast("long") - 1)
