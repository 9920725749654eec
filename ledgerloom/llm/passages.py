"""Repeated passages by hashing normalised units of text.

A text is cut into units of ``min_words`` to twice as many words. Where to cut follows from the words around a place
alone, never from a count since the last cut, so that copies of a passage are cut alike wherever they stand: every word is
ranked by what stands before it (a line break, the end of a sentence, another mark, none of these) and then by a hash of
it and the next word, and in this order becomes a cut unless one was made within ``min_words``. Units go on over line
breaks, and text without marks is cut by the hashes. A unit's digest is that of its words in lower case, so spacing
doesn't matter. Digests are grouped over the corpus; the earliest occurrence by (doc_id, place) stays, the others are
removed, and their offsets in the original text are kept beside the result. At the two ends of a passage pasted into other
text, words that share a unit with the text around them stay. Neighbouring units that repeat make a run, and a run of fewer
than ``min_run`` words stays: a short line found in many places is no passage (``line_dedup`` is for those).

Passages are pasted into the middle of lines, so lines or paragraphs as units would miss them; these are there as
``kind="line"`` and ``kind="paragraph"``.

Units are written once, as a table of digests and places; repeated digests are a small table joined to it, so that Spark
can split the join of a digest that very many documents hold."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import blocks, mixed, text_array, written

_END = re.compile(r"[.!?,;:]+(?=[ \t])")
_LINE = re.compile(r"[^\n]+")
_PARAGRAPH = re.compile(r"(?:[^\n]+(?:\n(?!\n)|$)?)+")
MIN_WORDS, MIN_RUN = 8, 32
#: White space as str.split has it; all code points beyond the table are none.
_SPACE = np.array([chr(c).isspace() for c in range(0x3002)])
#: 1 behind the end of a sentence, 2 behind another mark, 3 behind any other character.
_MARKS = np.array([1 if chr(c) in ".!?" else 2 if chr(c) in ",;:" else 3 for c in range(128)])
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """A word's 64-bit hash, kept for the words seen lately."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


_HASHES = _Hashes()


def cuts(rank: np.ndarray, apart: int) -> list[int]:
    """0, len(rank) and, lowest rank first, each place that is ``apart`` or more from all places taken before it, in order."""
    n = len(rank)
    taken, block = bytearray(n + 2 * apart), b"\1" * (2 * apart - 1)
    found = [0, n]
    for x in found:
        taken[x + 1 : x + 2 * apart] = block
    for x in np.argsort(rank, kind="stable").tolist():
        if not taken[x + apart]:
            taken[x + 1 : x + 2 * apart] = block
            found.append(x)
    return sorted(found)


def _runs(text: str, min_words: int) -> Iterator[tuple[int, int]]:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[np.minimum(codes, len(_SPACE) - 1)], [True]])))
    start, stop = edges[::2], edges[1::2]
    n = len(start)
    if n < min_words:
        return
    h = np.fromiter(map(_HASHES.__getitem__, text.lower().split()), np.uint64, n)
    breaks = np.concatenate([[0], np.cumsum(codes == 10)])
    broken = breaks[start[1:]] > breaks[stop[:-1]]
    after = np.where(broken, 0, _MARKS[np.minimum(codes[stop[:-1] - 1], 127)])
    with np.errstate(over="ignore"):
        rank = mixed(h + np.append(h[1:], np.uint64(0)) * _ODD) >> np.uint64(2)
    rank[1:] |= after.astype(np.uint64) << np.uint64(62)
    places = cuts(rank, min_words)
    for i, j in zip(places, places[1:], strict=False):
        yield int(start[i]), int(start[j] if j < n and not broken[j - 1] else stop[j - 1])


def units(text: str, kind: str, min_words: int = 1) -> Iterator[tuple[int, int]]:
    """(start, end) of the text's units, in code points: lines, paragraphs (lines without an empty one between them), or for
    "run" runs of ``min_words`` words or more that are cut by content. With ``min_words`` 1 these are the parts of lines
    between marks."""
    if kind == "run" and min_words > 1:
        yield from _runs(text, min_words)
        return
    for found in (_PARAGRAPH if kind == "paragraph" else _LINE).finditer(text):
        at, end = found.span()
        if kind == "run":
            for m in _END.finditer(text, at, end):
                yield at, m.end()
                at = m.end()
        if at < end:
            yield at, end


def digest(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))


def _unit_rows(kind: str, min_words: int):
    names = ["doc_id", "version", "digest", "nth", "start", "stop", "words"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_array(batch.column(2))
            for x, y in blocks(texts):
                found, nth, start, stop, count, many = [], [], [], [], [], []
                for text in texts.slice(x, y - x).to_pylist():
                    n = 0
                    for i, (a, b) in enumerate(units(text, kind, min_words)):
                        words = text[a:b].lower().split()
                        if len(words) >= min_words:
                            found.append(digest(words))
                            nth.append(i)
                            start.append(a)
                            stop.append(b)
                            many.append(len(words))
                            n += 1
                    count.append(n)
                place = pa.array(np.repeat(np.arange(x, y), count))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(place), batch.column(1).take(place), pa.array(found, pa.binary()), *(pa.array(v, pa.int32()) for v in (nth, start, stop, many))], names)

    return rows


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kind: str = "run", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, version, nth, start, stop, words) of each unit that an earlier place holds too; version is a hash of the text."""
    found = written(_rows(docs, id_col, text_col).mapInArrow(_unit_rows(kind, min_words), "doc_id long, version long, digest binary, nth int, start int, stop int, words int"), "units")
    at = F.struct("doc_id", "version", "start")
    first = found.groupBy("digest").agg(F.min(at).alias("first"), F.max(at).alias("last")).where(F.col("first") != F.col("last"))
    first = written(first.select("digest", "first"), "repeated").hint("merge")
    return found.join(first, "digest").where(at != F.col("first")).select("doc_id", "version", "nth", "start", "stop", "words")


def _cut(min_run: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            texts = text_array(batch.column("text"))
            for x, y in blocks(texts):
                out, gone = [], []
                for text, spans in zip(texts.slice(x, y - x).to_pylist(), batch.column("spans").slice(x, y - x).to_pylist(), strict=True):
                    runs: list[list] = []
                    for s in spans or []:
                        if runs and runs[-1][-1]["nth"] + 1 == s["nth"]:
                            runs[-1].append(s)
                        else:
                            runs.append([s])
                    kept, at, own = [], 0, []
                    for s in (s for run in runs if sum(s["words"] for s in run) >= min_run for s in run):
                        kept.append(text[at : s["start"]])
                        at = s["stop"]
                        own.append({"start": s["start"], "stop": s["stop"]})
                    out.append("".join(kept) + text[at:])
                    gone.append(own)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(x, y - x), pa.array(out, pa.string()), pa.array(gone, kind)], ["doc_id", "text", "removed"])

    return cut


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kind: str = "run", min_words: int = MIN_WORDS, min_run: int = MIN_RUN) -> DataFrame:
    """One row per row of ``docs``: doc_id, text (what stays), removed (array of (start, stop) in the original's code points).

    kind: "run", "line" or "paragraph". Units of fewer than ``min_words`` words always stay, and so do runs of neighbouring
    units of fewer than ``min_run`` words in all. A null text counts as empty. Rows that repeat both id and text are one
    document and are treated alike; rows that repeat an id with other texts are documents of their own, ranked by a hash of
    the text; a null id is ranked before all others. An empty table gives no rows; other columns are ignored."""
    repeats = repeated_units(docs, id_col, text_col, kind, min_words)
    spans = repeats.groupBy("doc_id", "version").agg(F.array_sort(F.collect_set(F.struct("nth", "start", "stop", "words"))).alias("spans"))
    rows = _rows(docs, id_col, text_col)
    s = spans.select(F.col("doc_id").alias("__id"), F.col("version").alias("__v"), "spans").hint("merge")
    rows = rows.join(s, rows["doc_id"].eqNullSafe(F.col("__id")) & (rows["version"] == F.col("__v")), "left")
    return rows.select("doc_id", "text", "spans").mapInArrow(_cut(min_run), "doc_id long, text string, removed array<struct<start:int,stop:int>>")
