"""Written tables in the shared folder, and word splitting on Arrow buffers."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: The white space of the word rule ``[^\x20\x09-\x0D]+``, for Java regular expressions and trim().
ASCII_SPACE = " \t\n\x0b\f\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Only a local session may leave it unset; it then gets a folder of its own, once per session."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_written: list[str] = []
#: Shuffle files of a write go when it is done; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for ``clear_written`` to delete."""
    path = f"{shared_dir(spark)}/ledgerloom/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for a while."""
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: it cuts lineage, and lost executors don't lose it.

    Results are lazy and may still read it, so it stays until ``clear_written``, which also runs when the process ends, or
    until ``drop_written`` where nothing lazy is left that reads it. by: columns of its partitions."""
    spark = df.sparkSession
    path = written_path(spark, name)
    with settings(spark, {CLEANUP: "true"}):
        df.write.partitionBy(*by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_written(*tables: DataFrame) -> None:
    """Delete written tables that nothing lazy reads any more."""
    for df in tables:
        _delete(df.sparkSession, df.written_at)
        _written.remove(df.written_at)


def clear_written(spark: SparkSession, mark: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Delete the tables that this process has written (since there were ``mark`` of them); call it once results are saved."""
    for path in [x for x in _written[mark:] if x not in keep]:
        _delete(spark, path)
        _written.remove(path)


@atexit.register
def _clear_at_exit() -> None:
    spark = SparkSession.getActiveSession() if _written else None
    if spark is not None:
        clear_written(spark)


def text_array(column) -> pa.Array:
    """A batch's string column as one array with nulls as empty texts."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.string())
    return pc.fill_null(arr.cast(pa.large_string()), "")


def blocks(texts: pa.Array, most_bytes: int = 4 << 20, most_rows: int = 20_000, size: pa.Array | None = None):
    """(start, stop) of runs of rows with about ``most_bytes`` of text; a longer text is a block of its own. size: bytes of
    the rows, by default those of ``texts``."""
    size = np.cumsum((pc.binary_length(texts) if size is None else size).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        done = size[start - 1] if start else 0
        stop = int(np.searchsorted(size, done + most_bytes, side="right"))
        stop = min(max(stop, start + 1), start + most_rows, len(texts))
        yield start, stop
        start = stop


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of each text: offsets (len + 1) into one flat array of words."""
    lists = pc.ascii_split_whitespace(texts)
    flat, edges = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    some = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    before = np.concatenate([[0], np.cumsum(some)])
    edges = edges - edges[0]
    return before[edges], flat.filter(pa.array(some))


def word_ids(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """For each word its place among the distinct words, and these."""
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """For each entry of a ragged array the row it belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over uint64 values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def without_case(columns: list[str], names: tuple[str, ...]) -> list[str]:
    """``columns`` less those that are one of ``names``, in any case."""
    return [c for c in columns if c.lower() not in names]


def input_bytes(df: DataFrame) -> int:
    """Bytes that Spark expects ``df`` to read: the size of its files, for a plain table; 0 where nothing is known of it."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 2**60 else 0
