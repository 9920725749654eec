"""Exact removal of repeated byte strings with suffix arrays by linear grouping.

What is removed: every byte that a ``width``-byte string (window) covers which also starts earlier in the corpus. One
suffix array over a corpus can't be cut into tasks, so equal windows are first brought together:

1. Each window has an anchor, the 32 bytes in it whose hash is smallest (the leftmost of equals). Equal windows have equal
   anchors at equal places, and an anchor serves a run of windows. Anchors' fingerprints are dealt to hash buckets,
   packed; those found once can't have a repeated window and are done with.
2. For anchors found more often, the bytes around them that their windows cover (contexts) are read. Of equal contexts
   all but the earliest are repeats as a whole, and one is looked at further.
3. The different contexts of an anchor meet in one bin. What no two of them can share is trimmed; of what is then equal
   the earliest goes on; and the rest, joined, gets its suffix array by linear grouping (``_gsaca``): windows that are
   equal stand together in it, and all but the earliest are repeats. Bins have about BIN_BYTES of contexts, or those of one
   anchor where it has more, MOST_CONTEXTS of at most 2 * width bytes each.
4. An anchor with still more different contexts is narrowed: its windows are halved by their distance to the anchor. The
   windows of a half have more bytes in common than the anchor, and these bytes with the half are their new anchor. 2 to 4
   go on with the narrower contexts. Halves of one window have all of it in common, so this ends, after 7 times at most
   for windows of 100 bytes.

Tables that a later step doesn't need are dropped, so the disk holds one step's tables and shuffles at a time."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._gsaca import suffix_array
from ._shared import blocks, drop_written, input_bytes, mixed, text_array, written

GRAM = 32
BIN_BYTES, MOST_CONTEXTS, BUCKET_BYTES = 512 << 10, 4_000, 64 << 20
_PIECE = 1 << 20
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """64 bits of the GRAM bytes at each place of ``data`` (uint8) that has so many."""
    v = data.astype(np.uint64)
    for by in (1, 2, 4):
        v = v[:-by] | (v[by:] << np.uint64(8 * by))
    n = len(data) - GRAM + 1
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for j in range(0, GRAM, 8):
            h = (h ^ v[j : j + n]) * _A
            h ^= h >> np.uint64(29)
        h *= _C
        return h ^ (h >> np.uint64(32))


def _anchors_of(data: np.ndarray, edges: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(row, lo, n, off, hash, left, right) of the anchors of the texts data[edges[i]:edges[i + 1]], in order: the run of n
    windows from byte lo of the text has its anchor at byte lo + off. left and right: hashes of the anchor with the GRAM
    bytes before and behind it, 0 where no window of the run needs that side."""
    span = width - GRAM + 1
    empty = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 3
    if len(data) < width:
        return empty
    h = _gram_hashes(data)
    key = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    whole = -(-len(key) // span) * span
    key = np.concatenate([key, np.full(whole - len(key), np.uint64(2**64 - 1))]).reshape(-1, span)
    first = np.minimum.accumulate(key, axis=1).ravel()
    last = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    n_windows = len(data) - width + 1
    at = (np.minimum(last[:n_windows], first[span - 1 : span - 1 + n_windows]) & np.uint64(0xFFFFFF)).astype(np.int64)
    sizes = np.diff(edges)
    row = np.repeat(np.arange(len(sizes)), sizes)
    good = np.flatnonzero(row[:n_windows] == row[width - 1 :])
    if not len(good):
        return empty
    at = at[good]
    cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (good[1:] != good[:-1] + 1)]))
    lo = good[cut]
    own, at = row[lo], at[cut]
    n, off = np.diff(np.concatenate([cut, [len(good)]])), at - lo
    with np.errstate(over="ignore"):
        left = (h[np.maximum(at - GRAM, 0)] * _A + h[at]) * _B | np.uint64(1)
        right = (h[at] * _B + h[np.minimum(at + GRAM, len(h) - 1)]) * _A | np.uint64(1)
    left[off < GRAM] = 0
    right[off - n + 1 >= GRAM] = 0
    return own, lo - edges[own], n, off, h[at], left, right


def anchors(texts: pa.Array, width: int) -> tuple[np.ndarray, ...]:
    """``_anchors_of`` texts, _PIECE bytes at a time: only a text longer than that is cut, so that a text's anchors don't
    depend on its block."""
    n = len(texts)
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[edges[0] : edges[-1]] if buffer is not None else np.zeros(0, np.uint8)
    edges = edges - edges[0]
    found = [_anchors_of(data[:0], np.zeros(1, np.int64), width)]
    for x, y in blocks(texts, _PIECE):
        own, cut = data[edges[x] : edges[y]], edges[x : y + 1] - edges[x]
        for a in range(0, max(len(own), 1), _PIECE):
            piece = own[a : a + _PIECE + width - 1]
            row, lo, *rest = _anchors_of(piece, cut if len(own) <= _PIECE else np.array([0, len(piece)]), width)
            found.append((row + x, lo + a, *rest))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _fingerprints(n_buckets: int, width: int):
    """A row (bucket, payload) for each bucket and block: fingerprints with the text's number and twice the anchor's (and 1
    more for the right side); and a row for the block's texts."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = text_array(batch.column(2))
            for a, b in blocks(texts, most_rows=65_535):
                row, _, _, _, _, left, right = anchors(texts.slice(a, b - a), width)
                block, k = (part << 32) + k, k + 1
                if not len(row):
                    continue
                number = 2 * (np.arange(len(row)) - np.searchsorted(row, row))
                row, number, h = np.concatenate([row, row]), np.concatenate([number, number + 1]), np.concatenate([left, right])
                row, number, h = row[h > 0], number[h > 0], mixed(h[h > 0])
                bucket = (h % np.uint64(n_buckets)).astype(np.int64)
                print32 = (h >> np.uint64(32)).astype("<u4")
                order = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
                rows = []
                for i in np.flatnonzero(np.diff(cut)).tolist():
                    o = order[cut[i] : cut[i + 1]]
                    rows.append((i, print32[o].tobytes() + row[o].astype("<u2").tobytes() + number[o].astype("<u4").tobytes()))
                ids = batch.column(0).slice(a, b - a)
                meta = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype("<i8").tobytes() + batch.column(1).slice(a, b - a).to_numpy(zero_copy_only=False).astype("<i8").tobytes() + ids.is_valid().to_numpy(zero_copy_only=False).astype("u1").tobytes()
                rows.append((block % n_buckets, meta))
                payload = [struct.pack("<q", len(x)) + pa.compress(x, codec="zstd", asbytes=True) for _, x in rows]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()), pa.array([False] * (len(rows) - 1) + [True]), pa.array(payload, pa.binary())], ["bucket", "block", "is_meta", "payload"])

    return deal


def _open(x: bytes) -> bytes:
    return pa.decompress(x[8:], struct.unpack_from("<q", x)[0], codec="zstd", asbytes=True)


def _found_again(table: pa.Table) -> pa.Table:
    """Of a bucket, the (text, anchor) numbers whose fingerprint is there more than once, by block."""
    meta = table.filter(table["is_meta"]).select(["block", "is_meta", "payload"])
    rest = table.filter(pc.invert(table["is_meta"]))
    data = [_open(x) for x in rest["payload"].to_pylist()]
    if not data:
        return meta
    n = np.array([len(x) // 10 for x in data])
    prints = np.concatenate([np.frombuffer(x, "<u4", m) for x, m in zip(data, n.tolist(), strict=True)])
    ordered = np.sort(prints)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    again = twice[np.minimum(np.searchsorted(twice, prints), max(len(twice) - 1, 0))] == prints if len(twice) else np.zeros(len(prints), bool)
    out, at = [], 0
    for x, m in zip(data, n.tolist(), strict=True):
        keep = again[at : at + m]
        at += m
        x = np.frombuffer(x, "<u2", m, 4 * m)[keep].tobytes() + np.frombuffer(x, "<u4", m, 6 * m)[keep].tobytes()
        out.append(struct.pack("<q", len(x)) + pa.compress(x, codec="zstd", asbytes=True) if x else None)
    made = pa.table({"block": rest["block"], "is_meta": pa.array([False] * len(out)), "payload": pa.array(out, pa.binary())})
    return pa.concat_tables([meta, made.filter(pc.is_valid(made["payload"]))])


def _by_text(table: pa.Table) -> pa.Table:
    """A block's texts with the numbers of their anchors that were found again."""
    meta = _open(table.filter(table["is_meta"])["payload"][0].as_py())
    n = len(meta) // 17
    ids, version, valid = np.frombuffer(meta, "<i8", n), np.frombuffer(meta, "<i8", n, 8 * n), np.frombuffer(meta, "u1", n, 16 * n).astype(bool)
    data = [_open(x) for x in table.filter(pc.invert(table["is_meta"]))["payload"].to_pylist()]
    row = np.concatenate([np.zeros(0, "<u2"), *(np.frombuffer(x, "<u2", len(x) // 6) for x in data)]).astype(np.int64)
    number = np.concatenate([np.zeros(0, "<u4"), *(np.frombuffer(x, "<u4", len(x) // 6, len(x) // 6 * 2) for x in data)])
    order = np.lexsort((number, row))
    cut = np.searchsorted(row[order], np.arange(n + 1))
    hits = [number[order[cut[i] : cut[i + 1]]].astype("<u4").tobytes() for i in range(n)]
    some = pa.array(np.diff(cut) > 0)
    return pa.table([pa.array(ids, mask=~valid), pa.array(version), pa.array(hits, pa.binary())], ["doc_id", "version", "hits"]).filter(some)


_CONTEXT = "k1 long, k2 long, h long, doc_id long, version long, lo int, n int, off int, context binary"


def _contexts(width: int):
    """The contexts of a text's anchors that were found again. One that the text has already had isn't sent: context is
    null, and its windows are repeats."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_array(batch.column(2))
            for i in range(len(texts)):
                own = texts.slice(i, 1)
                hits = np.frombuffer(batch.column(3)[i].as_py(), "<u4").astype(np.int64)
                which, first = np.unique(hits // 2, return_index=True)
                _, lo, n, off, h, _, _ = (x[which] for x in anchors(own, width))
                # only windows with their anchor at GRAM or later need the left side, only the others the right one
                both = np.diff(np.append(first, len(hits))) > 1
                is_right = (hits[first] % 2 == 1) & ~both
                is_left = (hits[first] % 2 == 0) & ~both
                skip = np.where(is_right, np.maximum(off - GRAM + 1, 0), 0)
                n = np.where(is_left, np.minimum(n, off - GRAM + 1), n) - skip
                lo, off = lo + skip, off - skip
                data = own[0].as_buffer().to_pybytes()
                seen: set[bytes] = set()
                k1, k2, kept = [], [], []
                for a, m, o, x in zip(lo.tolist(), n.tolist(), off.tolist(), h.tolist(), strict=True):
                    context = data[a : a + m - 1 + width]
                    d = xxhash.xxh3_128_digest(context + struct.pack("<HHQ", m, o, x))
                    k1.append(int.from_bytes(d[:8], "little", signed=True))
                    k2.append(int.from_bytes(d[8:], "little", signed=True))
                    kept.append(None if d in seen else context)
                    seen.add(d)
                many = len(kept)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(h.astype(np.int64)), pa.array([batch.column(0)[i].as_py()] * many, pa.int64()), pa.array([batch.column(1)[i].as_py()] * many, pa.int64()), pa.array(lo.astype("i4")), pa.array(n.astype("i4")), pa.array(off.astype("i4")), pa.array(kept, pa.binary())],
                    ["k1", "k2", "h", "doc_id", "version", "lo", "n", "off", "context"],
                )

    return read


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _reach(parts: list[bytes]) -> list[int]:
    """For each part the longest prefix that it shares with another."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    out = [0] * len(parts)
    for x, y in zip(order, order[1:], strict=False):
        k = _common(parts[x], parts[y])
        out[x], out[y] = max(out[x], k), max(out[y], k)
    return out


def _array_marks(width: int):
    """(doc_id, version, lo, n): runs of windows of a bin's contexts that an earlier place has, by its suffix array."""

    def find(table: pa.Table) -> pa.Table:
        cols = {c: table[c].to_pylist() for c in ("h", "context", "n", "off", "doc_id", "version", "lo")}
        groups: dict[int, list[int]] = {}
        for i, h in enumerate(cols["h"]):
            groups.setdefault(h, []).append(i)
        place = lambda i, at: (cols["doc_id"][i] is not None, cols["doc_id"][i] or 0, cols["version"][i], cols["lo"][i] + at)
        parts, owner, first = [], [], []  # pieces of text, and for each place the context and its window, or -1
        out: list[tuple] = []
        for own in groups.values():
            if len(own) < 2:
                continue
            text = [cols["context"][i] for i in own]
            off = [cols["off"][i] for i in own]
            right, left = _reach([t[o:] for t, o in zip(text, off, strict=True)]), _reach([t[:o][::-1] for t, o in zip(text, off, strict=True)])
            earliest: dict[tuple[int, bytes], tuple] = {}
            for i, t, o, r, f in zip(own, text, off, right, left, strict=True):
                start, stop = o - f, o + r
                if stop - start < width:
                    continue
                # of equal pieces at equal places of the anchor the earliest goes on, the others are repeats as a whole
                windows, key, now = stop - start - width + 1, (f, t[start:stop]), (place(i, start), i, start)
                then = earliest.setdefault(key, now)
                if then is not now:
                    later = max(then, now)
                    earliest[key] = min(then, now)
                    out.append((cols["doc_id"][later[1]], cols["version"][later[1]], cols["lo"][later[1]] + later[2], windows))
            if len(earliest) < 2:
                continue
            for (_, piece), (_, i, start) in earliest.items():
                windows = len(piece) - width + 1
                parts.append(piece + b"\x00")
                owner += [i] * windows + [-1] * width
                first += list(range(start, start + windows)) + [0] * width
        data = b"".join(parts)
        marked: dict[int, list[int]] = {}
        last, same = None, []

        def close() -> None:
            if len(same) > 1:
                places = [place(owner[s], first[s]) for s in same]
                least = min(places)
                for s, at in zip(same, places, strict=True):
                    if at != least:
                        marked.setdefault(owner[s], []).append(first[s])

        for s in suffix_array(data):
            if owner[s] >= 0:
                window = data[s : s + width]
                if window != last:
                    close()
                    last, same = window, []
                same.append(s)
        close()
        for i, starts in marked.items():
            starts.sort()
            a = 0
            for b in range(1, len(starts) + 1):
                if b == len(starts) or starts[b] != starts[b - 1] + 1:
                    out.append((cols["doc_id"][i], cols["version"][i], cols["lo"][i] + starts[a], b - a))
                    a = b
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.table([pa.array([x[j] for x in out], kind) for j, kind in enumerate(kinds)], ["doc_id", "version", "lo", "n"])

    return find


def _removed(width: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_array(batch.column(1))
            for a, b in blocks(texts):
                kept, spans, gone, size = [], [], [], []
                for i in range(a, b):
                    data, marks = texts[i].as_buffer().to_pybytes(), batch.column(2)[i].as_py()
                    runs: list[tuple[int, int]] = []
                    for x in sorted((m["lo"], m["lo"] + m["n"] - 1 + width) for m in marks or []):
                        if runs and x[0] <= runs[-1][1]:
                            runs[-1] = (runs[-1][0], max(runs[-1][1], x[1]))
                        else:
                            runs.append(x)
                    at, some = 0, []
                    for x, y in runs:
                        some.append(data[at:x])
                        at = y
                    kept.append(b"".join(some) + data[at:])
                    spans.append([{"start": x, "stop": y} for x, y in runs])
                    size.append(len(data))
                    gone.append(len(data) - len(kept[-1]))
                kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "removed", "kept"])

    return cut


def _at() -> Column:
    return F.struct("doc_id", "version", "lo")


def _firsts(contexts: DataFrame) -> DataFrame:
    """(k1, k2, h, first, times) of each different context; bytes don't travel."""
    return contexts.where("context is not null").groupBy("k1", "k2").agg(F.min(_at()).alias("first"), F.max("h").alias("h"), F.count(F.lit(1)).alias("times"))


def _equal_contexts(contexts: DataFrame) -> DataFrame:
    """(doc_id, version, lo, n): the windows of contexts that an earlier place has as a whole."""
    firsts = _firsts(contexts).where("times > 1").select("k1", "k2", "first").hint("merge")
    later = contexts.where("context is not null").select("k1", "k2", "doc_id", "version", "lo", "n").join(firsts, ["k1", "k2"]).where(~_at().eqNullSafe(F.col("first")))
    own = contexts.where("context is null")  # the text has had it before
    return own.select("doc_id", "version", "lo", "n").union(later.select("doc_id", "version", "lo", "n"))


def _several(contexts: DataFrame) -> DataFrame:
    """The first places, with bytes, of the contexts of anchors that have several different ones; ``many``: how many."""
    firsts = written(_firsts(contexts).select("k1", "k2", "h", "first"), "firsts")
    many = firsts.groupBy("h").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    few = firsts.join(many.hint("merge"), "h").select("many", F.col("first.doc_id").alias("f_id"), F.col("first.version").alias("f_version"), F.col("first.lo").alias("f_lo"), "k1", "k2").hint("merge")
    sent = contexts.where("context is not null").join(few, ["k1", "k2"]).where(F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("version") == F.col("f_version")) & (F.col("lo") == F.col("f_lo")))
    return sent.select("h", "many", "near", "far", "n", "off", "context", "doc_id", "version", "lo")


def _different_contexts(several: DataFrame, width: int) -> DataFrame:
    """(doc_id, version, lo, n): windows that an earlier, different context of the same anchor has too."""
    total = several.agg(F.sum(F.octet_length("context"))).first()[0] or 0
    binned = several.withColumn("bin", F.pmod(F.xxhash64("h"), F.lit(max(1, -(-total // BIN_BYTES)))))
    return binned.groupBy("bin").applyInArrow(_array_marks(width), "doc_id long, version long, lo int, n int")


def _halves(crowd: DataFrame, width: int) -> DataFrame:
    """The contexts of crowded anchors, each cut in two: windows that start near to far bytes before the anchor have the
    bytes from near before it in common, and these make the new h."""
    halves = F.explode(F.expr("array(struct(near, int((near + far) div 2) as far), struct(int((near + far) div 2) + 1 as near, far))"))
    cut = crowd.select("h", "n", "off", "context", "doc_id", "version", "lo", halves.alias("half")).select("*", "half.near", "half.far")
    cut = cut.withColumn("a", F.expr("greatest(off - far, 0)")).withColumn("m", F.expr("least(off - near, n - 1) - a + 1")).where("m > 0")
    cut = cut.select(
        F.expr(f"xxhash64(h, near, far, substring(context, off - near + 1, {width} - far + near))").alias("h"), "near", "far", "doc_id", "version",
        *(F.expr(x) for x in ("lo + a as lo", "m as n", "off - a as off", f"substring(context, a + 1, m - 1 + {width}) as context")),
    )
    return cut.select(F.unhex(F.md5("context")).alias("k1"), F.xxhash64("h", "off", "n").alias("k2"), "*")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 100, n_buckets: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, removed (array of (start, stop) in UTF-8 bytes), kept (binary).

    A byte is removed if a ``width``-byte string that covers it also starts earlier: in a document with a smaller id, or
    earlier in the same one. A null text counts as empty. Rows that repeat both id and text are one document and are
    treated alike; of rows that repeat an id with other texts the order is that of a hash of the text; a null id comes
    before all others. An empty table gives no rows; other columns are ignored. n_buckets: of fingerprints, by default
    the session's shuffle partitions, or more where BUCKET_BYTES of the input a bucket gives more: a task holds one bucket."""
    spark = docs.sparkSession
    n_buckets = n_buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), input_bytes(docs) // BUCKET_BYTES)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))
    whole = F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))
    ids = rows.select("doc_id", "version", whole.alias("whole"), F.octet_length("text").alias("size"))
    same = ids.groupBy("whole").agg(F.min(F.struct("doc_id", "version")).alias("first"), F.max(F.struct("doc_id", "version")).alias("last")).where(~F.col("first").eqNullSafe(F.col("last")))
    copies = ids.join(same.select("whole", "first"), "whole").where(~F.struct("doc_id", "version").eqNullSafe(F.col("first")) & (F.col("size") >= width))
    copies = written(copies.select("doc_id", "version", F.lit(0).alias("lo"), (F.col("size") - width + 1).alias("n")), "copies")
    dealt = rows.mapInArrow(_fingerprints(n_buckets, width), "bucket int, block long, is_meta boolean, payload binary")
    again = dealt.groupBy("bucket").applyInArrow(_found_again, "block long, is_meta boolean, payload binary")
    hits = again.groupBy("block").applyInArrow(_by_text, "doc_id long, version long, hits binary")
    hits = hits.groupBy("doc_id", "version").agg(F.min("hits").alias("hits"))  # rows that are the same document
    one = lambda a: [F.col("doc_id").eqNullSafe(F.col(f"{a}_id")), F.col("version") == F.col(f"{a}_version")]
    named = lambda df, a: df.withColumnRenamed("doc_id", f"{a}_id").withColumnRenamed("version", f"{a}_version")
    hits = written(hits.join(named(copies.select("doc_id", "version").distinct().hint("merge"), "c"), one("c"), "left_anti"), "hits")
    texts = rows.join(named(hits.hint("merge"), "h"), one("h")).select("doc_id", "version", "text", "hits")
    around = texts.mapInArrow(_contexts(width), _CONTEXT).select("*", F.lit(0).alias("near"), F.lit(width - GRAM).alias("far"))
    contexts = written(around, "contexts")
    drop_written(hits)

    marks, crowded = [copies], (F.col("many") > MOST_CONTEXTS) & (F.col("near") < F.col("far"))
    while contexts is not None:
        marks.append(written(_equal_contexts(contexts), "marks"))
        several = written(_several(contexts), "several")
        drop_written(contexts)
        marks.append(written(_different_contexts(several.where(~crowded), width), "marks"))
        crowd = several.where(crowded)
        contexts = None if crowd.isEmpty() else written(_halves(crowd, width), "contexts")
        drop_written(several)

    found = reduce(DataFrame.union, marks).groupBy("doc_id", "version").agg(F.collect_list(F.struct("lo", "n")).alias("marks"))
    return rows.join(named(found.hint("merge"), "m"), one("m"), "left").select("doc_id", "text", "marks").mapInArrow(_removed(width), "doc_id long, n_bytes long, n_removed long, removed array<struct<start:int,stop:int>>, kept binary")

