"""Exact top-k inner products by block-at-a-time pruning.

Vectors are sorted by id and cut into shards of a range of ids, and a shard into blocks. A shard is one row: its vectors as a
forward index (one matrix) and each component's largest and smallest value. A query's bound for a shard or a block is the
sum over its components of the larger product with these two.

Bounds come first, without vectors: each query is scored against its best shard, which gives it a k-th score to start
from, and then only pairs of a query group and a shard that some query's bound lets through get to see the vectors. There
a query takes blocks in falling order of bounds, scores whole blocks, and stops when the next bound is below its k-th
best score, so nothing that could enter is skipped. Shards come in waves, each of four times as many as the one before, and
the k-th scores rise between them: what a wave sends on is some multiple of k rows a query, not of the shards. Tasks hold one group of queries and one shard, or one chunk of shards'
bounds, all of bounded size; each query's bests of the shards are then ranked."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._shared import drop_written, written

#: Shards whose bounds a task holds, and shards of the first wave.
BOUNDS, FIRST_WAVE = 4096, 16


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of integers; shorter vectors end in zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    if isinstance(vectors, pa.ChunkedArray):
        vectors = pa.concat_arrays(vectors.chunks)
    edges, flat = vectors.offsets.to_numpy().astype(np.int64), vectors.values.to_numpy(zero_copy_only=False)
    size = np.diff(edges)
    out = np.zeros((len(size), width), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(edges[-1] - edges[0]) - np.repeat(edges[:-1] - edges[0], size)] = flat[edges[0] : edges[-1]]
    return out


def _exact(queries: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
    """The arrays in a type that no sum of products can leave: doubles below 2^53, as they are fast, then longs, then any."""
    most = int(np.abs(queries.astype(object)).max(initial=0)) * max(int(np.abs(x.astype(object)).max(initial=0)) for x in others) * max(1, queries.shape[1]) if _large(queries, *others) else 0
    kind = float if most < 2**53 else np.int64 if most < 2**62 else object
    return [x.astype(kind) for x in (queries, *others)]


def _large(*arrays: np.ndarray) -> bool:
    """Whether any product of two of them could be near 2^53, judged in doubles."""
    return max((float(np.abs(x.astype(float)).max(initial=0)) for x in arrays), default=0) ** 2 * max(1, arrays[0].shape[1]) >= 2**52


def bounds_of(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The most that each query's score with a vector between low and high can be; one column per pair of these."""
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def search(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, block: int, start: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each query's best k (ids, scores) among the vectors whose id isn't its own, ties to smaller ids; those below its
    score in ``start`` may be left out."""
    queries, vectors = _exact(queries, vectors)
    starts = list(range(0, len(ids), block))
    high = np.array([vectors[a : a + block].max(axis=0) for a in starts]).reshape(len(starts), vectors.shape[1])
    low = np.array([vectors[a : a + block].min(axis=0) for a in starts]).reshape(len(starts), vectors.shape[1])
    bounds = bounds_of(queries, high, low)
    turn = np.argsort(-bounds, axis=1, kind="stable")
    best = [(np.zeros(0, ids.dtype), np.zeros(0, vectors.dtype)) for _ in queries]
    active, kth_of = np.arange(len(queries)), np.full(len(queries), -np.inf, object if vectors.dtype == object else float) if start is None else start.copy()
    for r in range(len(starts)):
        now = turn[active, r]
        keep = np.asarray(bounds[active, now] >= kth_of[active], bool)
        active, now = active[keep], now[keep]
        if not len(active):
            break
        for b in np.unique(now):
            own = active[now == b]
            a = starts[b]
            scores = queries[own] @ vectors[a : a + block].T
            some = np.asarray(scores.max(axis=1) >= kth_of[own], bool)
            for q, s in zip(own[some].tolist(), scores[some], strict=True):
                others = ids[a : a + block] != query_ids[q]
                i, s = np.concatenate([best[q][0], ids[a : a + block][others]]), np.concatenate([best[q][1], s[others]])
                if len(s) > k:
                    least = np.sort(s)[-k]
                    i, s = i[s >= least], s[s >= least]
                top = np.lexsort((i, -s)) if s.dtype != object else np.array(sorted(range(len(s)), key=lambda j, s=s, i=i: (-s[j], i[j])), int)
                top = top[:k]
                best[q] = (i[top], s[top])
                if len(top) == k:
                    kth_of[q] = max(kth_of[q], s[top[-1]])
    return best


_SHARD = "shard long, ids binary, m binary, high binary, low binary"


def _shards(width: int, shard_rows: int):
    """Sorted rows (vec_id, v) as shards of ``shard_rows`` and a last one of fewer."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, ids, m = TaskContext.get().partitionId(), 0, np.zeros(0, np.int64), np.zeros((0, width), np.int64)

        def row(i: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            made = [[part << 32 | k], [i.tobytes()], [x.tobytes()], [x.max(axis=0).tobytes()], [x.min(axis=0).tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(made, (pa.int64(), *(pa.binary(),) * 4), strict=True)], ["shard", "ids", "m", "high", "low"])

        for batch in batches:
            ids, m = np.concatenate([ids, batch.column(0).to_numpy()]), np.concatenate([m, _matrix(batch.column(1), width)])
            while len(ids) >= shard_rows:
                yield row(ids[:shard_rows], m[:shard_rows])
                ids, m, k = ids[shard_rows:], m[shard_rows:], k + 1
        if len(ids):
            yield row(ids, m)

    return cut


def _unpacked(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, np.int64).reshape(-1, width) if width else np.zeros((0, 0), np.int64)


def _starts(kth: list, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores to start from and the ids that hold them, -inf where there is none."""
    out, held = np.full(n, -np.inf, object), np.zeros(n, np.int64)
    for x in kth or []:
        if x["kth"] is not None:
            out[x["i"]], held[x["i"]] = x["kth"], x["held"]
    return out if any(isinstance(x, int) and abs(x) >= 2**53 for x in out.tolist()) else out.astype(float), held


def _bounded(width: int, best_only: bool):
    """Of a query group and a chunk of bounds: each query's best shard, or the shards that a query's bound lets through."""

    def find(groups: pa.Table, shards: pa.Table) -> pa.Table:
        if not groups.num_rows or not shards.num_rows:
            return pa.table({"grp": pa.array([], pa.int32()), "shard": pa.array([], pa.int64()), "i": pa.array([], pa.int32()), "bound": pa.array([], pa.float64())})
        shards = shards.sort_by("shard")  # of equal bounds the smaller ids', as ties go to these
        grp, q = groups["grp"][0].as_py(), _unpacked(groups["m"][0].as_py(), width)
        high, low = (np.concatenate([_unpacked(x, width) for x in shards[c].to_pylist()]) for c in ("high", "low"))
        bounds = bounds_of(*_exact(q, high, low))
        if best_only:
            i, s = np.arange(len(q)), np.array(bounds.argmax(axis=1))
        else:
            start, _ = _starts(groups["kth"][0].as_py(), len(q))
            i, s = np.nonzero(np.asarray(bounds >= start[:, None], bool))
        names = shards["shard"].to_numpy()[s]
        return pa.table({"grp": pa.array([grp] * len(i), pa.int32()), "shard": pa.array(names), "i": pa.array(i, pa.int32()), "bound": pa.array(bounds[i, s].astype(float))})

    return find


def _scored(width: int, k: int, block: int):
    """Of a query group and a shard: the best k of each query that it lists."""

    def score(table: pa.Table) -> pa.Table:
        row = {c: table[c][0].as_py() for c in table.column_names}
        which = np.sort(np.array(row["which"], np.int64))
        ids, q = np.frombuffer(row["q_ids"], np.int64), _unpacked(row["q_m"], width)
        start, held = (x[which] for x in _starts(row["kth"], len(q)))
        found = search(q[which], ids[which], _unpacked(row["m"], width), np.frombuffer(row["ids"], np.int64), k, block, start)
        # what ranks behind the k-th that a query has already can't be among its best
        fit = [(s > start[j]) | ((s == start[j]) & (i <= held[j])) for j, (i, s) in enumerate(found)]
        found = [(i[np.asarray(f, bool)], s[np.asarray(f, bool)]) for (i, s), f in zip(found, fit, strict=True)]
        n = np.array([len(i) for i, _ in found], np.int64)
        scores = [int(x) for _, s in found for x in s.tolist()]
        if any(abs(x) >= 2**63 for x in scores):
            raise ValueError("a score is beyond 64 bits")
        return pa.table({
            "grp": pa.array([row["grp"]] * int(n.sum()), pa.int32()), "i": pa.array(np.repeat(which, n), pa.int32()), "query_id": pa.array(np.repeat(ids[which], n), pa.int64()),
            "vec_id": pa.array(np.concatenate([i for i, _ in found]) if found else [], pa.int64()), "score": pa.array(scores, pa.int64()),
        })

    return score


def _waves(shards: int) -> int:
    """Waves that take ``shards``: FIRST_WAVE of them, then four times as many each."""
    waves = 1
    while FIRST_WAVE * (4**waves - 1) // 3 < shards:
        waves += 1
    return waves


def _wave(shards: int) -> Column:
    """A shard's wave, by a hash of its number."""
    at = F.pmod(F.xxhash64(F.lit(3), "shard"), F.lit(1 << 30))
    edges = [(FIRST_WAVE * (4**w - 1) // 3 << 30) // shards for w in range(1, _waves(shards))]
    return sum((F.when(at >= e, 1).otherwise(0) for e in edges), F.lit(0)).alias("wave")


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = 2048, group_rows: int = 2048, block: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query's floor(scale * x) vector
    with those of all other rows; ties go to the smaller id.

    is_query: a condition (Column) on ``vectors``. Rows with the query's id are its own and no candidates; a row
    repeated under one id stays a candidate of others as often as it is there, and asks once (with the smallest vector). Vectors that are null or hold null or
    non-finite components, and rows without an id, take no part; empty vectors score 0; of vectors of different lengths
    the shorter counts as ending in zeros. Components of 2^62 or more and scores beyond 64 bits are errors. A query with
    fewer than k candidates returns them all; an empty table returns no rows. Other columns are ignored."""
    spark = vectors.sparkSession
    x = F.col(vector_col)
    finite = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    whole = lambda c: F.when(F.abs(c.cast("double") * scale) < 2.0**62, F.floor(c.cast("double") * scale)).otherwise(F.raise_error("a component is beyond 2^62").cast("long"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(finite, F.transform(x, whole)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    n, n_queries, width = rows.agg(F.count(F.lit(1)), F.count_if("q"), F.max(F.size("v"))).first()
    width = max(width or 0, 1)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most_shards = n // shard_rows + parts
    groups, chunks = max(1, -(-n_queries // group_rows)), max(1, -(-most_shards // BOUNDS))
    every = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))

    ordered = rows.select("vec_id", "v").repartitionByRange(parts, "vec_id", F.xxhash64("v")).sortWithinPartitions("vec_id", F.xxhash64("v"))
    shards = ordered.mapInArrow(_shards(width, shard_rows), _SHARD).withColumn("wave", _wave(most_shards))
    shards = written(shards, "shards", "wave")
    asked = rows.where("q").groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("grp", F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(groups)).cast("int"))

    def gather(table: pa.Table) -> pa.Table:
        return pa.table({"grp": table["grp"][:1], "ids": pa.array([table["vec_id"].to_numpy().tobytes()], pa.binary()), "m": pa.array([_matrix(table["v"], width).tobytes()], pa.binary())})

    queries = written(asked.groupBy("grp").applyInArrow(gather, "grp int, ids binary, m binary"), "queries")
    bounds = shards.select("wave", "shard", "high", "low", F.pmod(F.xxhash64("shard"), F.lit(chunks)).cast("int").alias("chunk")).withColumn("grp", every(groups))
    pair = "grp int, shard long, i int, bound double"

    def let_through(queries: DataFrame, best_only: bool, wave=None) -> DataFrame:
        own = bounds if wave is None else bounds.where(F.col("wave") == wave)
        by = queries.withColumn("chunk", every(chunks)).groupBy("grp", "chunk")
        return by.cogroup(own.drop("wave").groupBy("grp", "chunk")).applyInArrow(_bounded(width, best_only), pair)

    def scored(pairs: DataFrame, queries: DataFrame, wave=None) -> DataFrame:
        own = (shards if wave is None else shards.where(F.col("wave") == wave)).select("shard", "ids", "m").hint("merge")
        q = queries.select("grp", F.col("ids").alias("q_ids"), F.col("m").alias("q_m"), "kth").hint("merge")
        both = pairs.groupBy("grp", "shard").agg(F.collect_list("i").alias("which")).join(q, "grp").join(own, "shard")
        return both.groupBy("grp", "shard").applyInArrow(_scored(width, k, block), "grp int, i int, query_id long, vec_id long, score long")

    def kth_of(bests: DataFrame) -> DataFrame:
        last = F.min(F.struct("score", -F.col("vec_id"), "vec_id"))  # of equal scores the largest id is the k-th
        return bests.groupBy("grp", "i").agg(F.when(F.count(F.lit(1)) == k, last).alias("last"))

    none = queries.withColumn("kth", F.lit(None).cast("array<struct<i:int,kth:long,held:long>>"))
    best = let_through(none, True).groupBy("grp", "i").agg(F.max(F.struct("bound", -F.col("shard"), "shard"))["shard"].alias("shard"))
    kth = kth_of(scored(best, none))
    waves, found, ranked = _waves(most_shards), None, Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    for wave in range(waves):
        kth = written(kth, "kth") if waves > 1 else kth
        seeds = kth.groupBy("grp").agg(F.collect_list(F.struct("i", F.col("last.score").alias("kth"), F.col("last.vec_id").alias("held"))).alias("kth"))
        started = written(queries.join(seeds, "grp", "left"), "queries")
        now = scored(let_through(started, False, wave), started, wave)
        now = now if found is None else found.unionByName(now)
        now = now.withColumn("rank", F.row_number().over(ranked).cast("int")).where(F.col("rank") <= k)
        if wave == waves - 1:
            return now.select("query_id", "rank", "vec_id", "score")
        found = written(now.drop("rank"), "bests")
        drop_written(started)
        kth = kth.unionByName(kth_of(found)).groupBy("grp", "i").agg(F.max("last").alias("last"))
