"""Shards by a hierarchical weighted hash tree, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: One shard: (region, rack, shard, weight).
Leaf = tuple[int, int, int, float]


def even_tree(n_shards: int, racks: int = 2, shards: int = 2) -> list[Leaf]:
    """Shards 0 to n-1 of weight 1, filling racks of ``shards`` and regions of ``racks`` racks in order.

    While the last region is full, one more shard opens a region, and so takes rows only into itself."""
    return [(i // (racks * shards), i // shards, i, 1.0) for i in range(n_shards)]


def _draw(key: Column, level: str, node: int, weight: float) -> Column:
    """An exponential waiting time with rate ``weight``: the earliest child is drawn with odds in its weight."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(f"{level}:{node}"), key), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.ln(u) / F.lit(float(weight))


def _earliest(key: Column, level: str, weights: dict[int, float]) -> Column:
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    return F.least(*[F.struct(_draw(key, level, n, w).alias("t"), F.lit(n).alias("n")) for n, w in weights.items()])["n"]


def _choose(key: Column, tree: Sequence[Leaf]) -> Column:
    """Descend region, rack and shard; a node's weight is the sum of those below."""

    def weights(level: int, leaves: Sequence[Leaf]) -> dict[int, float]:
        out: dict[int, float] = {}
        for leaf in leaves:
            out[leaf[level]] = out.get(leaf[level], 0.0) + leaf[3]
        return out

    def below(level: int, leaves: Sequence[Leaf]) -> Column:
        nodes = weights(level, leaves)
        drawn = _earliest(key, ("region", "rack", "shard")[level], nodes)
        if level == 2 or len({x[2] for x in leaves}) == 1:
            return drawn if level == 2 else F.lit(leaves[0][2])
        out = F.lit(None).cast("int")
        for n in nodes:
            out = F.when(drawn == n, below(level + 1, [x for x in leaves if x[level] == n])).otherwise(out)
        return out

    return below(0, [x for x in tree if x[3] > 0])


def place(docs: DataFrame, tree: Sequence[Leaf], id_col: str = "doc_id", out: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row's key in column ``out`` (int).

    The draw depends on the key and the node alone, so changing a weight moves rows only within the subtrees whose
    weights change. A null key is a key like others; equal keys share a shard. No shuffle."""
    return docs.withColumn(out, _choose(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), tree).cast("int"))


def slots(placed: DataFrame, order: Sequence[str], shard: str = "shard", out: str = "slot", buckets: int = 1024) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, by (hash bucket, ``order``).

    Rows are numbered within (shard, bucket), so no task holds a whole shard; the buckets' first numbers come from a
    running sum over their counts, a table of at most shards x buckets rows."""
    rows = placed.withColumn("__b", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(buckets)))
    counts = rows.groupBy(shard, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(shard).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(shard, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    within = Window.partitionBy(shard, "__b").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    numbered = rows.withColumn("__k", F.row_number().over(within) - 1)
    return numbered.join(firsts, [shard, "__b"]).withColumn(out, (F.col("__first") + F.col("__k")).cast("long")).drop("__b", "__k", "__first")


def shard_documents(docs: DataFrame, tree: Sequence[Leaf], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32, shard and slot of every row.

    A null text counts as empty (size 1, CRC 0). Rows that agree in id, CRC and size take neighbouring slots in any
    order. An empty table gives no rows; other columns are ignored, whatever their names."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return slots(place(rows, tree, "doc_id"), ["doc_id", "text_crc32", "size"])
