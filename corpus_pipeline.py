"""Corpus pipeline: stages over documents, each written as Parquet and read again as the next one's input.

Toxic documents go; lines found in ten documents or more stay only where they occur first; one document of each
group of near copies stays; the sources are mixed to their target weights, so a document may come twice or not at
all; the texts are encoded as pieces and decoded again.

Every stage takes documents (doc_id, text, lang, source, n_chars and any other columns, which stay as they are,
whatever their names). Each row is taken for itself: repeated rows and ties never stand for one another, and an empty
table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.llm import lines, mixing, pieces, simhash, toxicity
from docgraph.llm.common import scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier chain flags. A null or empty text is scored as one without words and
    stays; without labels all stay."""
    return toxicity.drop_flagged(docs, toxicity.train_on(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, repeated lines only where they are first; n_chars is counted anew. A null text becomes empty.
    Null ids stand last; rows that repeat an id share its first occurrence."""
    return lines.dedup_lines(docs, keep="first", counted=False).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document by id of each group of near copies, null ids last. Texts without words are one group."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Null sources are one source; a null or empty text has size 0."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, text (decoded from the ids), ids, n_tokens, same (whether the decoded text is the text). A null text has no
    ids and becomes empty."""
    both = pieces.encode(docs, pieces.load(), with_decoded=True)
    return both.select("doc_id", F.col("decoded").alias("text"), "ids", F.size("ids").alias("n_tokens"), "same")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for n, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{n}.parquet"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
