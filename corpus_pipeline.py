"""The corpus pipeline: documents that the quality classifier keeps, without repeated lines and near-copies, mixed to
target weights and encoded. Each stage's rows are written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import line_dedup, mixing, pieces, quality, simhash
from parley.llm.common import Workspace, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the best grade is likely enough; the ratings are those of the labels table."""
    fitted = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.rate(docs, fitted).filter("kept").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the lines that an earlier one holds taken out of their texts."""
    text = F.col("kept")
    row = F.col("row").withField("text", text).withField("n_chars", F.char_length(text).cast("long"))
    return line_dedup.dedup_lines(docs).select(row.alias("row")).select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-copies: that of the smallest id, null ids last; of rows that repeat an id the one
    of the smallest fingerprint, then hash of the text."""
    work = Workspace(spark, "near-copies")
    rows = work.write(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*docs.columns).alias("row")), "rows")
    groups = simhash.simhash_groups(rows.select("rid", "row.text"), id_col="rid").select(F.col("doc_id").alias("rid"), "fp", "component_id")
    keys = rows.select("rid", F.col("row.doc_id").alias("doc_id"), F.xxhash64("row.text").alias("h")).join(groups, "rid")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "h", "rid")
    first = keys.groupBy("component_id").agg(F.min(order)["rid"].alias("rid")).select("rid")
    return rows.join(first, "rid", "left_semi").select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, and those of smaller domains as often as tempered weights ask, by rates of at least 1."""
    rates = mixing.mix(docs, table(spark, sf_dir, "labels"), least=1.0, keep_total=False)
    rates = rates.groupBy(F.col("doc_id").alias("rated")).agg(F.max("copies").cast("int").alias("copies"))
    both = docs.select(F.struct(*docs.columns).alias("row")).join(rates, F.col("row.doc_id").eqNullSafe(F.col("rated")))
    return both.select("row", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("copies"))))).select("row.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id, n_pieces, ids`: the piece identifiers of every document."""
    found = pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", lines),
    ("simhash near-dedup", near_copies),
    ("source mixing", mixed),
    ("sentencepiece encoding", encoded),
]
#: Stages of fitting, multi-index hashing and piece lattices can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = work.write(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
