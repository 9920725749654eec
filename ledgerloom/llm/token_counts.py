"""Token counts by counting each distinct pre-token once.

Blocks of documents give their distinct pre-tokens, each with a posting list (document's place, frequency). They are
dealt to hash buckets of pre-tokens; a bucket tokenises each of its distinct pre-tokens once, joins these counts to the
blocks' pre-tokens, and sums count x frequency for the documents of each block. A second pass adds up the buckets'
sums of a block. Token ids are never kept.

A block's pre-tokens travel packed, one row for each block and bucket, so a frequent pre-token is one entry per block,
not a row per document. A bucket streams: a task holds one row of a block and the counts of the pre-tokens seen so far,
at most KNOWN of them (what is dropped from that memory is tokenised again if it comes back), whatever the bucket's size.

A block's id is a hash of its documents, and its documents' row says how many rows the block has in all; a block that
doesn't come together (because a lost task was run again over an input in another order) is an error, never a wrong count."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import blocks, input_bytes, rows_of, split_words, text_array, word_ids
from ._tokens import encoder, units_of

_MOST = 65_535  # what a posting's 16 bits hold
#: Pre-tokens whose counts a task remembers; bytes of input for a bucket, about.
KNOWN, BUCKET_BYTES = 2_000_000, 256 << 20


_SUM = np.dtype([("row", "<u2"), ("n", "<u4")])
_ROWS = "bucket int, block long, is_meta boolean, payload binary"


def _postings(unit: np.ndarray, row: np.ndarray, n_rows: int, n_units: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and frequencies (16 bits each) of each unit in turn, and where a unit's begin; larger frequencies take several entries."""
    pairs, n = np.unique(unit * n_rows + row, return_counts=True)
    if len(n) and n.max() > _MOST:
        times = (n + _MOST - 1) // _MOST
        rest = n - _MOST * (times - 1)
        last = np.cumsum(times) - 1
        pairs, n = np.repeat(pairs, times), np.full(int(times.sum()), _MOST)
        n[last] = rest
    return (pairs % n_rows).astype("<u2"), n.astype("<u2"), np.searchsorted(pairs, np.arange(n_units + 1) * n_rows)


def _zip(data: bytes) -> bytes:
    return struct.pack("<q", len(data)) + pa.compress(data, codec="zstd", asbytes=True)


def _unzip(data: bytes) -> bytes:
    return pa.decompress(data[8:], struct.unpack_from("<q", data)[0], codec="zstd", asbytes=True)


def _pack(units: list[bytes], lengths: np.ndarray, rows: np.ndarray, n: np.ndarray) -> bytes:
    return _zip(struct.pack("<qq", len(units), len(rows)) + lengths.astype("<u4").tobytes() + rows.tobytes() + n.tobytes() + b" ".join(units))


def _unpack(data: bytes) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    data = _unzip(data)
    u, e = struct.unpack_from("<qq", data)
    a, b, c = 16 + 4 * u, 16 + 4 * u + 2 * e, 16 + 4 * u + 4 * e
    return data[c:].decode().split(" "), np.frombuffer(data, "<u4", u, 16), np.frombuffer(data, "<u2", e, a), np.frombuffer(data, "<u2", e, b)


def _block_rows(n_buckets: int, block_bytes: int):
    """A row for each bucket that a block's pre-tokens fall in, and one with the block's documents."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = text_array(batch.column(1))
            ids, size = batch.column(0), pc.binary_length(texts).to_numpy(zero_copy_only=False).astype("<i8")
            for a, b in blocks(texts, block_bytes, _MOST):
                own = ids.slice(a, b - a)
                meta = pc.fill_null(own, 0).to_numpy(zero_copy_only=False).astype("<i8").tobytes() + size[a:b].tobytes() + own.is_valid().to_numpy(zero_copy_only=False).astype("u1").tobytes()
                block = (xxhash.xxh64_intdigest(meta + struct.pack("<qq", part, k))) - 2**63
                k += 1
                offsets, flat = split_words(texts.slice(a, b - a))
                word, words = word_ids(flat)
                del flat
                units, head, tail = units_of(words)
                keys = units.cast(pa.large_binary()).to_pylist()
                bucket = (np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys)) % np.uint64(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                row, tails = rows_of(offsets), tail[word]
                has = tails >= 0
                rows, n, edges = _postings(rank[np.concatenate([head[word], tails[has]])], np.concatenate([row, row[has]]), b - a, len(units))
                some, cut = np.unique(bucket[order], return_index=True)
                cut = np.append(cut, len(order))
                found = []
                for i, u, v in zip(some.tolist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                    e = slice(edges[u], edges[v])
                    found.append((i, False, _pack([keys[j] for j in order[u:v].tolist()], np.diff(edges[u : v + 1]), rows[e], n[e])))
                found.append((block % n_buckets, True, struct.pack("<q", len(found)) + meta))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in found], pa.int32()), pa.array([block] * len(found), pa.int64()), pa.array([x[1] for x in found]), pa.array([x[2] for x in found], pa.binary())],
                    ["bucket", "block", "is_meta", "payload"],
                )

    return deal


def _count_bucket(tokenizer: str):
    """Each distinct pre-token of a bucket is tokenised once and joined to its blocks' postings; each block gets sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                payload = batch.column(3)[i].as_py()
                if not batch.column(2)[i].as_py():
                    units, lengths, rows, n = _unpack(payload)
                    if len(known) > KNOWN:
                        known.clear()
                    new = [u for u in units if u not in known]
                    known.update(zip(new, encoder(tokenizer).lengths(pa.array(new, pa.large_string())).tolist(), strict=True))
                    pieces = np.fromiter(map(known.__getitem__, units), np.int64, len(units))
                    total = np.bincount(rows, np.repeat(pieces, lengths) * n).astype(np.int64)  # exact below 2^53
                    entries = []
                    while total.any():
                        some = np.flatnonzero(total)
                        entry = np.empty(len(some), _SUM)
                        entry["row"], entry["n"] = some, np.minimum(total[some], 2**32 - 1)
                        total[some] -= entry["n"]
                        entries.append(struct.pack("<q", len(some)) + entry["row"].tobytes() + entry["n"].tobytes())
                    payload = _zip(b"".join(entries))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, 1), batch.column(2).slice(i, 1), pa.array([payload], pa.binary())], ["block", "is_meta", "payload"])

    return count


def _sum_block(table: pa.Table) -> pa.Table:
    metas, rest = table.filter(table["is_meta"])["payload"], table.filter(pc.invert(table["is_meta"]))["payload"].to_pylist()
    if len(metas) != 1 or struct.unpack_from("<q", metas[0].as_py())[0] != len(rest):
        raise ValueError("a block of documents isn't whole: the input's order changed between two runs of a task; write it as a table first")
    meta = metas[0].as_py()[8:]
    n = len(meta) // 17
    ids, size, valid = np.frombuffer(meta, "<i8", n), np.frombuffer(meta, "<i8", n, 8 * n), np.frombuffer(meta, "u1", n, 16 * n).astype(bool)
    total = np.zeros(n, np.int64)
    for x in rest:
        data, at = _unzip(x), 0
        while at < len(data):
            (m,) = struct.unpack_from("<q", data, at)
            total[np.frombuffer(data, "<u2", m, at + 8)] += np.frombuffer(data, "<u4", m, at + 8 + 2 * m)
            at += 8 + 6 * m
    return pa.table([pa.array(ids, mask=~valid), pa.array(size), pa.array(total)], ["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", n_buckets: int | None = None, block_bytes: int = 12 << 20) -> DataFrame:
    """One row (doc_id, n_bytes, n_tokens) per row of ``docs``.

    tokenizer: path of a ``tokenizers`` file with white space between words dropped, as in word_bpe_49k.json. Special
    strings in a text count as the library's default has it; nothing is added, cut or padded. A null text counts as
    empty: 0 bytes, 0 tokens. Null and repeated ids keep their rows. Other columns of ``docs`` are ignored; an empty
    table gives no rows. Blocks follow the order in which a scan reads rows: give a table, not a shuffled plan.
    n_buckets: of pre-tokens, by default the session's shuffle partitions, or more where BUCKET_BYTES of the input a bucket
    gives more (by the size of its files, which Spark knows without reading them)."""
    n_buckets = n_buckets or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), input_bytes(docs) // BUCKET_BYTES)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dealt = rows.mapInArrow(_block_rows(n_buckets, block_bytes), _ROWS)
    dealt = dealt.repartition(n_buckets, "bucket")
    sums = dealt.mapInArrow(_count_bucket(tokenizer), "block long, is_meta boolean, payload binary")
    return sums.groupBy("block").applyInArrow(_sum_block, "doc_id long, n_bytes long, n_tokens long")
