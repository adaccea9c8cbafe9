"""A corpus pipeline in five stages: rule-based quality, line dedup, near-dedup, mixing, SentencePiece ids.

Each stage takes the rows that its predecessor kept, written as Parquet and read again, so that the plan of a stage never
holds its predecessors' and a lost executor repeats one stage at most.

In all stages a null text counts as empty, texts of any length are taken whole, an empty table gives no rows, and the
columns of ``documents`` come back as they are (but for what the stage itself changes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.llm import line_dedup, mixing, near_text, piece_codec, quality
from cellgrid.llm._shared import shared_dir, stored
from cellgrid.llm.queries import MIX_WEIGHTS, table, tokenizer_file

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Near-duplicates: sets of five-word shingles of at least this Jaccard similarity.
NEAR = {"width": 5, "similarity": 0.8}


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of rows that are not held out, scores 0.3 or more.

    A score depends on the text alone, so repeated rows stay or go together. Without labels (or with null ones alone)
    every score is 0.5 and all stay.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), limit=0.3).select(*COLUMNS)


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds.

    Rows of one id are one document, rows without an id one document after all others. A document that loses all its
    lines stays with an empty text; ``n_chars`` counts what is left.
    """
    out = line_dedup.dedup_lines(docs)
    return out.withColumns({"text": F.col("kept"), "n_chars": F.char_length("kept").cast("bigint")}).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id (rows without one come last).

    Of repeated rows one stays, and one of all texts without words.
    """
    return near_text.keep_one(docs, **NEAR).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them; a null source is a source of its own.

    Documents without words come with each complete epoch of their source. Ties of a key go by id and size.
    """
    return mixing.repeat_documents(docs, MIX_WEIGHTS).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces."""
    model = tokenizer_file("piece_bpe_32k.model")
    out = piece_codec.encode_texts(docs.withColumn("text", F.coalesce("text", F.lit(""))), model)
    return out.select(*COLUMNS, "ids", F.size("ids").cast("bigint").alias("n_pieces"))


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", first_lines),
    ("SimHash near-dedup", one_of_each),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]

#: No SQL can express the classifier, SimHash or the segmentation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), shared_dir(spark))
    return docs
