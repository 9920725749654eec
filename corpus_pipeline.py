"""From raw documents to packed training sequences, in five stages over the whole table.

Each stage is given what the one before it kept, as a written table, and returns the columns of documents; the last
returns the pieces of packed sequences. An empty table gives an empty one in every stage; further columns of documents are
carried along as they are, and n_chars is kept up to date where it is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import _shared, line_dedup, mixing, near_dup, packing, quality


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars as the text now has."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words repeat too much, or that lie beyond their group's thresholds, go.

    A clean short text is a clean text, so length alone rejects none but those without a word: null, empty and blank ones.
    Repeated rows are judged alike; a null language or source is a group of its own."""
    return quality.quality_filter(docs, min_words=1)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents stay in the one with the largest id; texts are rewritten, and all documents stay.

    A null text becomes an empty one; rows that repeat an id count once; a null id is smaller than all others."""
    return _counted(line_dedup.dedup_lines(docs).select(*[F.col(f"`{c}`") for c in docs.columns]))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that with the smallest id; rows with a null id and texts without words all do.

    Of repeated rows one stays; an id with several texts keeps each that is no near copy."""
    return near_dup.drop_near_duplicates(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, written in training order; null, empty and blank texts have nothing to take.

    A null source is a source, the last; ties of the order go by a hash and the id; repeated rows are documents each."""
    return _counted(mixing.mix_documents(docs))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens, numbered along the training order in which ``docs`` was written.

    ``docs`` is a table read from its files. Null ids and repeated rows keep their pieces; a null or empty text is one of length 1."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2048, 1, order=packing.file_order())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("MinHash near-dedup", near_deduplication),
    ("mixing", source_mixing),
    ("packing", sequence_packing),
]

#: SQL has no tokenizer and no MinHash; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; each stage's table and what it wrote on the way go when the next one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mark = len(_shared._written)
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        docs = _shared.written(out, f"stage{k}")
        _shared.clear_written(spark, mark, keep=(docs.written_at,))
    return docs
