"""The text pipeline: documents to packed training sequences, in stages that are written one after the other.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of
documents. A stage's result is Parquet in the shared folder, read again as the next stage's documents, so a lost executor
costs at most a part of one stage. Documents may have any further columns, also of names that the operators use; an empty
table, null and empty texts, missing ids and repeated rows pass through as each stage states.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm import decontamination, jaccard_join, line_dedup, packing, queries, toxicity
from patronlens.llm.common import table
from patronlens.session import materialise

#: Near copies: words of a shingle, and the least percentage of all shingles of two texts that they share.
NEAR_WIDTH, NEAR_PERCENT = 5, 80
#: Columns that stages read; all others are carried.
READ = ("doc_id", "text", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def carrying_any_names(stage: Stage) -> Stage:
    """The stage on documents whose carried columns have plain names, so that none meets a name the stage uses itself."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = docs.toDF(*[c if c in READ else f"carried_{i}" for i, c in enumerate(docs.columns)])
        return stage(spark, plain, sf_dir).toDF(*docs.columns)

    return run_stage


@carrying_any_names
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scorer does not predict as toxic. It learns from the labelled documents of the folder."""
    model, scorer = queries.learned_toxicity(spark, sf_dir)
    return toxicity.score(docs, docs.columns, model, scorer).filter("predicted = 0").select(*docs.columns)


@carrying_any_names
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an equal or near line precedes; n_chars follows the text."""
    kept = line_dedup.dedup(docs, bands=line_dedup.BANDS)
    n_chars = F.when(F.size("removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", n_chars).select(*docs.columns)


@carrying_any_names
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts: the one with the smallest id, of repeated rows one. Texts without words stay."""
    labelled = materialise(jaccard_join.similar(docs, docs.columns, width=NEAR_WIDTH, percent=NEAR_PERCENT).withColumn("row_key", F.monotonically_increasing_id()))
    first = labelled.filter("label IS NOT NULL").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("first"))
    stays = first.select("first.row_key").join(labelled, "row_key")
    return stays.select(*docs.columns).unionByName(labelled.filter("label IS NULL").select(*docs.columns))


@carrying_any_names
def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaks into."""
    return decontamination.scan(docs, table(spark, sf_dir, "benchmark")).filter(F.size("leaks") == 0).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", one_of_each_group),
    ("decontamination", remove_leaks),
    ("packing", pack_sequences),
]

#: No stage but the third can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
