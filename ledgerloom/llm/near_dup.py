"""Near duplicates by DartMinHash signatures, banded joining and exact checks.

A text is a weighted set: its five-word shingles, weighted by how often they are in it. Darts are thrown at the plane of
(weight, rank) of each element, region by region: along a layer of weights the ranks of its darts are the arrivals of a
Poisson process drawn from hashes of (element, layer, count), so every text that holds the element meets the same darts. A
dart counts if its weight is below the element's. It is hashed to one of k coordinates, and the earliest dart of each
coordinate is the signature's value there; two texts agree in a coordinate with the odds of their weighted Jaccard
similarity. Ranks are followed only as far as k ln k + 2k darts are expected, for a text of any length, and doubled for
texts that left a coordinate empty.

A node is a text, named by its 128-bit digest, so copies are one node and versions of an id are nodes apart. Nodes that
agree in a band share a bucket. Every node of a bucket is paired with the bucket's smallest (never all with all); pairs
are checked on their whole shingle sets. Buckets that still hold more than one component are compared in chunks of bounded
rows and bytes, across components only, so a link that doesn't pass through the smallest isn't lost: there all pairs of a
bucket are looked at inside the task, on whole shingle sets, but only the links of a spanning forest leave it. Every pair
that shares a band is checked, however few other coordinates it agrees in, and no link goes unchecked. Components are found by
alternating large and small stars on written tables.

Sides whose size follows the data are joined by sort and merge, never broadcast because they happen to be small."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import WORD_PATTERN, blocks, mixed, rows_of, split_words, text_array, word_ids, written

WORDS, SIMILARITY = 5, 0.8
BANDS, PER_BAND = 24, 5
#: Most nodes, and about as many bytes of text, of a chunk of a bucket.
CHUNK, CHUNK_BYTES = 2048, 8 << 20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


def elements(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, weight) of each text's distinct shingles; a text of fewer words is one shingle, one without words none."""
    offsets, flat = split_words(texts)
    ids, distinct = word_ids(flat)
    if not len(ids):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, distinct.cast(pa.large_binary()).to_pylist()), np.uint64, len(distinct))[ids]
    row, size = rows_of(offsets), np.diff(offsets)
    start = np.flatnonzero(row[: len(row) - words + 1] == row[words - 1 :]) if len(row) >= words else np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(start), np.uint64)
        for j in range(words):
            total += h[start + j] * _ODD[j]
        short = np.flatnonzero((size > 0) & (size < words))
        rest = size[short].astype(np.uint64) * _ODD[5]
        for j in range(words - 1):
            has = size[short] > j
            rest[has] += h[offsets[:-1][short[has]] + j] * _ODD[j]
        row, h = np.concatenate([row[start], short]), mixed(np.concatenate([total, rest]))
        _, first, weight = np.unique(mixed(h + row.astype(np.uint64) * _ODD[6]), return_index=True, return_counts=True)
    return row[first], h[first], weight


def _wait(key: np.ndarray, step: np.ndarray) -> np.ndarray:
    u = ((mixed(key + (step + 1).astype(np.uint64) * _ODD[0]) >> np.uint64(11)).astype(float) + 0.5) / 2**53
    return -np.log(u)


def dart_signatures(row: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, k: int) -> np.ndarray:
    """n x k values (uint32); rows without elements stay 0."""
    out = np.zeros(n * k, np.uint32)
    layers = np.where(weight > 1, 1 + np.ceil(np.log2(np.maximum(weight, 1))), 1).astype(np.int64)
    at = np.repeat(np.arange(len(row)), layers)
    layer = np.arange(len(at)) - np.repeat(np.cumsum(layers) - layers, layers)
    width = np.where(layer > 0, 2.0 ** (layer - 1), 1.0)
    low = np.where(layer > 0, width, 0.0)
    row, weight = row[at], weight[at].astype(float)
    with np.errstate(over="ignore"):
        key = mixed(h[at] ^ (layer.astype(np.uint64) * _ODD[1]))
        total = np.bincount(row, np.where(layer == 0, weight, 0), minlength=n)
        until = np.divide(k * math.log(k) + 2 * k, total, out=np.zeros(n), where=total > 0)
        step, rank = np.zeros(len(at), np.int64), _wait(key, np.zeros(len(at), np.int64)) / width
        best, open_rows = np.full(n * k, np.inf), total > 0
        while open_rows.any():
            live = np.flatnonzero(open_rows[row] & (rank <= until[row]))
            while len(live):
                dart = mixed(key[live] ^ ((step[live] + 1).astype(np.uint64) * _ODD[2]))
                where = low[live] + width[live] * ((dart >> np.uint64(32)).astype(float) / 2**32)
                hit = where < weight[live]
                on, r = live[hit], rank[live][hit]
                spot = row[on] * k + ((dart[hit] & np.uint64(0xFFFFFFFF)) % np.uint64(k)).astype(np.int64)
                value = (mixed(dart[hit] + _ODD[3]) >> np.uint64(32)).astype(np.uint32)
                np.minimum.at(best, spot, r)
                won = best[spot] == r
                out[spot[won]] = value[won]
                step[live] += 1
                rank[live] += _wait(key[live], step[live]) / width[live]
                live = live[rank[live] <= until[row[live]]]
            open_rows &= np.isinf(best.reshape(n, k)).any(axis=1)
            until[open_rows] *= 2
    return out.reshape(n, k)


def _sign(k: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_array(batch.column(2))
            for a, b in blocks(texts):
                row, h, weight = elements(texts.slice(a, b - a))
                has = np.zeros(b - a, bool)
                has[row] = True
                sigs = [x.tobytes() if y else None for x, y in zip(dart_signatures(row, h, weight, b - a, k).astype("<u4"), has.tolist(), strict=True)]
                size = pc.binary_length(texts.slice(a, b - a)).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), size, pa.array(sigs, pa.binary())], ["doc_id", "node", "size", "sig"])

    return sign


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the shingles of two columns of texts, row by row, on whole texts."""
    n = len(left)
    row, h, weight = elements(pa.concat_arrays([left, right]))
    total = np.bincount(row, weight, minlength=2 * n)
    pair = row % max(n, 1)
    order = np.lexsort((row, h, pair))
    p, x, w = pair[order], h[order], weight[order]
    same = np.flatnonzero((p[1:] == p[:-1]) & (x[1:] == x[:-1]))
    both = np.bincount(p[same], np.minimum(w[same], w[same + 1]), minlength=n)
    either = total[:n] + total[n:] - both
    return np.divide(both, either, out=np.zeros(n), where=either > 0)


def _checked(at_least: float):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = text_array(batch.column(2)), text_array(batch.column(3))
            both = pc.add(pc.binary_length(left), pc.binary_length(right))
            for a, b in blocks(left, size=both):
                s = similarities(left.slice(a, b - a), right.slice(a, b - a))
                ok = pa.array(s >= at_least - 1e-12)
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(a, b - a).filter(ok) for i in (0, 1)] + [pa.array(s).filter(ok)], ["a", "b", "similarity"])

    return check


def _grown(df: DataFrame) -> DataFrame:
    """A side that grows with the corpus: no broadcast, at no size."""
    return df.hint("merge")


def _checked_pairs(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts are similar enough."""
    side = lambda x: _grown(texts.select(F.col("node").alias(x), F.col("text").alias(f"t{x}")))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb")
    return written(both.mapInArrow(_checked(similarity), "a binary, b binary, similarity double"), "links")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes that aren't the smallest of theirs, from pairs (a, b).

    Large stars and small stars in turn until nothing changes; each round is a written table. Neighbours are joined to
    their node's minimum, where Spark splits a node with very many of them."""
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "stars")
    state = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = written(large, "stars")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        now = written(small, "stars")
        found = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if found == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = found


def _candidates(table: pa.Table, total: np.ndarray, similarity: float) -> Iterator[tuple[int, np.ndarray]]:
    """For the places of a bucket's chunk i the places in chunk j of other components, less those whose number of shingles
    is too far off for the similarity."""
    component, part = word_ids(table["component"].combine_chunks())[0], table["c"].to_numpy()
    i, j = table["i"][0].as_py(), table["j"][0].as_py()
    cols = np.flatnonzero(part == j)
    for x in np.flatnonzero(part == i).tolist():
        other = cols[component[cols] != component[x]]
        if i == j:
            other = other[other > x]
        other = other[np.minimum(total[other], total[x]) >= (similarity - 1e-9) * np.maximum(total[other], total[x])]
        if len(other):
            yield x, other


def _joined_up(similarity: float):
    """Links between a bucket's components: candidates not yet joined are checked on their texts; a forest is returned."""

    def find(table: pa.Table) -> pa.Table:
        node, root = table["node"].to_pylist(), {c: c for c in table["component"].to_pylist()}
        component = table["component"].to_pylist()

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        row, h, weight = elements(text_array(table["text"]))
        code = np.unique(h, return_inverse=True)[1]
        order = np.argsort(row, kind="stable")
        code, weight = code[order], weight[order]
        edges = np.searchsorted(row[order], np.arange(table.num_rows + 1))
        total = np.add.reduceat(np.append(weight, 0), edges[:-1]) * (np.diff(edges) > 0)
        own = np.zeros(int(code.max(initial=-1)) + 1, np.int64)
        out = []
        for x, other in _candidates(table, total, similarity):
            other = np.array([y for y in other.tolist() if top(component[y]) != top(component[x])], np.int64)
            if not len(other):
                continue
            mine = slice(edges[x], edges[x + 1])
            own[code[mine]] = weight[mine]
            size = edges[other + 1] - edges[other]
            at = np.repeat(edges[other] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            both = np.bincount(np.repeat(np.arange(len(other)), size), np.minimum(own[code[at]], weight[at]), minlength=len(other))
            own[code[mine]] = 0
            for y in other[both >= (similarity - 1e-12) * (total[x] + total[other] - both)].tolist():
                if top(component[y]) != top(component[x]):
                    root[top(component[y])] = top(component[x])
                    out.append((max(node[x], node[y]), min(node[x], node[y])))
        return pa.table([pa.array([a for a, _ in out], pa.binary()), pa.array([b for _, b in out], pa.binary())], ["a", "b"])

    return find


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("node"), text.alias("text"))


def _links(rows: DataFrame, nodes: DataFrame, similarity: float, bands: int, per_band: int) -> DataFrame:
    """(node, component) of the nodes that aren't the smallest of theirs. nodes: (node, first, size, sig)."""
    key = F.array(*[F.xxhash64(F.lit(b), F.substring("sig", 4 * per_band * b + 1, 4 * per_band)) for b in range(bands)])
    banded = nodes.select("node", "size", F.explode(key).alias("key"))
    buckets = written(banded.groupBy("key").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    shared = written(banded.join(_grown(buckets), "key").select("key", "node", "size", "center", "n"), "shared")
    star = shared.where("node <> center").select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    in_bucket = nodes.join(_grown(shared.select("node").distinct()), "node", "left_semi").select("node", F.col("first").alias("doc_id"))
    texts = written(rows.join(_grown(in_bucket), ["node", "doc_id"]).groupBy("node").agg(F.min("text").alias("text")), "bucket-texts")
    links = _checked_pairs(star, texts, similarity).select("a", "b")
    own = components(links)

    several = shared.where("n > 2").join(_grown(own), "node", "left").select("key", "node", "size", F.coalesce("component", "node").alias("component"))
    chunks = F.ceil(F.greatest(F.count(F.lit(1)) / CHUNK, F.sum("size") / CHUNK_BYTES)).cast("int")
    still = several.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), chunks.alias("chunks")).where("lo < hi")
    members = several.join(_grown(still.select("key", "chunks")), "key")
    members = members.withColumn("c", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("i", F.least("c", "other")).withColumn("j", F.greatest("c", "other"))
    members = members.select("key", "i", "j", "c", "node", "component")
    found = members.join(_grown(texts), "node")
    more = written(found.groupBy("key", "i", "j").applyInArrow(_joined_up(similarity), "a binary, b binary"), "links")
    if not more.isEmpty():  # from the stars found so far, so few rounds are left
        own = components(own.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    return own


def _classes(docs: DataFrame, id_col: str, text_col: str, similarity: float, bands: int, per_band: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of the rows, node null without words; and (node, first, component) of each text, first being its smallest id."""
    rows = _rows(docs, id_col, text_col)
    sigs = written(rows.mapInArrow(_sign(bands * per_band), "doc_id long, node binary, size long, sig binary"), "signatures")
    nodes = written(sigs.where("sig is not null and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("first"), F.any_value("size").alias("size"), F.any_value("sig").alias("sig")), "nodes")
    own = _links(rows.where("doc_id is not null"), nodes, similarity, bands, per_band)
    texts = nodes.select("node", "first").join(_grown(own), "node", "left").select("node", "first", F.coalesce("component", "node").alias("component"))
    return sigs.select("doc_id", F.when(F.col("sig").isNotNull(), F.col("node")).alias("node")), written(texts, "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, bands: int = BANDS, per_band: int = PER_BAND) -> DataFrame:
    """One row (doc_id, class_id, class_key) per row of ``docs``; class_id is the smallest id of the row's class, class_key (hex)
    names the class itself.

    A class is a component of the links between texts of similarity ``similarity`` or more (weighted Jaccard of five-word
    shingles; words are split at ASCII white space). At 0.8 a pair shares a band with odds of 0.9999. A null text, and one
    without words, is a class of its own without a key; so is a row with a null id, whose class_id is null. Rows that repeat
    an id are linked only as far as their texts are: versions of one id can be in classes that have the same smallest id,
    and class_key tells these apart. An empty table gives no rows; other columns are ignored."""
    rows, texts = _classes(docs, id_col, text_col, similarity, bands, per_band)
    least = texts.groupBy("component").agg(F.min("first").alias("class_id"))
    texts = texts.join(_grown(least), "component").select("node", "class_id", "component")
    known = F.col("doc_id").isNotNull()
    out = rows.join(_grown(texts), "node", "left")
    return out.select("doc_id", F.when(known, F.coalesce("class_id", "doc_id")).alias("class_id"), F.when(known, F.hex("component")).alias("class_key"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, bands: int = BANDS, per_band: int = PER_BAND) -> DataFrame:
    """One row of each class of ``near_duplicates``: the text with the smallest id, of several under that id the one with the
    smallest digest, of repeated rows the one with the smallest hash.

    Rows with a null id all stay, and so do those without words. An empty table gives no rows."""
    rows, texts = _classes(docs, id_col, text_col, similarity, bands, per_band)
    first = texts.groupBy("component").agg(F.min(F.struct("first", "node")).alias("f")).select(F.col("f.first").alias("doc_id"), F.col("f.node").alias("node"))
    times = rows.where("node is not null").join(_grown(first), ["doc_id", "node"]).groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("times"))
    times = written(times.select(F.col("doc_id").alias("__id"), F.col("node").alias("__node"), "times"), "kept")
    text = F.col(f"`{text_col}`").cast("string")
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("node"), F.coalesce(text.rlike(WORD_PATTERN), F.lit(False)).alias("worded"))
    named = named.join(_grown(times), (F.col("doc_id") == F.col("__id")) & (F.col("node") == F.col("__node")), "left")
    out = named.where("doc_id is null or not worded or times = 1").select("row")
    if not times.where("times > 1").isEmpty():
        again = named.where("worded and times > 1").groupBy("doc_id", "node").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
        out = out.union(again.select("row"))
    return out.select("row.*")
