"""From raw documents to token ids: score, line dedup, near-duplicate removal, mixing, encoding.

Every stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents``
and works on all rows that the one before kept. ``run`` writes what each
returns as Parquet in the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import bpe, jaccard, lines, mixing, quality, seeds
from tidewatch.llm.queries import RANKS, pattern, vocabulary
from tidewatch.llm.tables import read, word_count
from tidewatch.session import settle

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A classifier and a hash-seeded mix have no SQL twin; the stages are tested one by one.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier, trained on ``labels``, rejects. Unscored documents stay."""
    scored = quality.classify(docs, read(spark, sf_dir, "labels"))
    return scored.filter("keep").select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated chunks of lines out; a document of which nothing is left goes. Null and empty texts stay."""
    found = lines.dedup(docs.select(*COLUMNS))
    left = found.filter((F.col("lines_removed") == 0) | (F.trim("text") != ""))
    changed = F.when(F.col("lines_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("bigint")
    return left.withColumn("n_chars", changed).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id, null last, stays. Every row without words stays."""
    found = jaccard.join(docs)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "tag")
    lead = found.filter("component IS NOT NULL").groupBy("component").agg(F.min_by(F.struct("doc_id", "tag"), order).alias("at"))
    tagged = seeds.tagged(docs.select(*COLUMNS))
    worded = tagged.filter(word_count(F.col("text")) > 0)
    kept = seeds.on_key(worded, lead.select("at.doc_id", "at.tag"), "left_semi").dropDuplicates(["doc_id", "tag"])
    return kept.unionByName(tagged.filter(word_count(F.col("text")) == 0)).select(*COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice. Rows that repeat count once."""
    tagged = seeds.tagged(docs.select(*COLUMNS))
    sized = tagged.select("doc_id", "tag", "source", word_count(F.col("text")).alias("size")).dropDuplicates(["doc_id", "tag"])
    taken = mixing.mix(sized).filter("copies > 0").select("doc_id", "tag", "copies")
    joined = seeds.on_key(tagged, taken, "inner")
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of every row."""
    return bpe.digests(docs, vocabulary(RANKS), pattern(), with_ids=True)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mixed_sources),
    ("byte-level BPE encoding and decoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
