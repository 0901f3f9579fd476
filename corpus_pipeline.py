"""A corpus from raw documents: language, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; stages but the last return
the columns of ``documents``. Stages are joined by Parquet in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.llm import jaccard, language, packing, pii
from galley.llm.common import shared_path, table
from galley.llm.queries import tokenizer_file


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a determined language; learn from those with a label.

    Without any label no language is learned; then only texts without a letter are dropped.
    """
    model = language.fit(docs, F.col("doc_id"))
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    answers = language.identify(docs.withColumn("__llm_copy", F.col("text")), model, [*docs.columns], "__llm_copy")
    return answers.filter(F.col("lang_pred") != language.UNDETERMINED).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that Jaccard links of five-word shingles make."""
    return jaccard.deduplicated(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind of personal data in its place; every document stays."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))).select(
        *docs.columns
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids and places in sequences."""
    return packing.pack(docs, ["doc_id"], tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language", known_language),
    ("near_copies", one_of_near_copies),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: Trained models, pattern graphs and evolved plans are beyond SQL; a test replays the
#: stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
