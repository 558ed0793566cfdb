"""A corpus pipeline over the documents table: quality, near duplicates, repeated substrings, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next stage's docs. All but the
last return the columns of documents. Part of the text operators: without them this module can't be imported.

Defined cases, in every stage: a null or empty text is a document like others, an empty table gives an empty table, further columns of any name go along.
Repeated rows are scored alike; they, and rows that share an id, become one at the second stage; rows without id stay. Texts may be of any length.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm import decontaminate, jaccard, packing, quality, suffix_dedup
from sessionloom.llm.common import settle, small_batches, table


def bounded(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage in a session of small batches: an executor runs several Python workers, and each keeps what its largest batch took."""

    @wraps(stage)
    def run_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_


@bounded
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score below 0.5) go; it learns from labelled rows outside the held-out fold."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("score >= 0.5").select("row.*")


@bounded
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest id stays, and of rows that share an id one; rows without id stay."""
    parts = jaccard.jaccard_components(docs)
    gone = parts.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti")
    twice = parts.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id")
    once = kept.join(twice, "doc_id", "left_anti")
    first = kept.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return once.unionByName(first).select(*docs.columns)


#: Bytes that are repeated together to be cut, and the k-grams that find them: about what 50 words have when they are short.
REPEAT = 224
REPEAT_GRAM = 48


@bounded
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes under strings of `REPEAT` bytes that stand twice are cut out of the texts; all documents stay."""
    cut = suffix_dedup.cut_repeats(docs, REPEAT, REPEAT_GRAM)
    text = F.when(F.col("row.text").isNotNull(), F.col("kept_text"))
    out = cut.select("row.*", text.alias("_kept")).withColumn("text", F.col("_kept")).drop("_kept")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@bounded
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter item, go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


@bounded
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, each with its place in a training sequence."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality_classifier", keep_quality),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]
#: Models, suffix arrays and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = settle(docs, name)
    return docs


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
