"""A training corpus from a table of documents, in five stages.

Defined cases are those of the operators: rows with null text or id stay until a
stage's rule drops them (a null text scores as an empty one); rows that repeat id
and text are copies, of which one stays; an empty table gives an empty result;
columns beside those of ``documents`` pass through all stages but the last.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import jaccard_join, packing, pii, quality_model, suffix_dedup
from tessella.llm.common import bound_batches, fresh_path, read_table

#: Rows with their ids are large, so a packer takes fewer of them.
PIECES_PER_PACKER = 100_000


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars follows a changed text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    model = quality_model.train(docs, read_table(spark, sf_dir, "labels"))
    own = "_tessella_score"
    return quality_model.score(docs, model, score_col=own).where(F.col(own) >= 0.5).drop(own)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return jaccard_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return _with_length(suffix_dedup.remove_repeats(docs))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return _with_length(pii.mask(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their ids, each in its place."""
    bound_batches(spark)
    return packing.pack_documents(docs, packing.default_tokenizer(), with_ids=True, pieces_per_packer=PIECES_PER_PACKER)


STAGES = [
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: SQL cannot express the trained classifier or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
