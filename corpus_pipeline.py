"""The training-data pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``:

1. language ID: texts of no learned language (``und``: null, or without a letter) go;
2. near-duplicates: of each group that SimHash links, the row with the smallest id stays;
3. decontamination: a text that holds a window of a benchmark item goes;
4. mixing: each source's texts are taken as often as its target says, whole and in the order of the schedule, so a row comes up to twice;
5. packing: token ids in binary matrices, a row per matrix.

Null texts, and texts without a letter, go in the first stage, so no later one has any; a null id, language, source or length stays as it is. Repeated rows are
copies, of which the second stage leaves one; ties between them go to the smallest id, and between rows of one id to the smallest row. Very long texts are kept
whole throughout. Further columns pass through all stages but the last, whatever their names. An empty table gives no rows in any stage.

No stage is expressible in SQL as a whole (DuckDB has no XXH64 with a seed for the fingerprints, and no automaton for languages), so ``ORACLE_SQL`` is None and the
tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ligaspark.llm import decontaminate, language, mixing, packing, simhash
from ligaspark.llm.common import discard, materialize, table

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_languages(docs, language.fit(language.train_rows(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_documents(docs)


def token_matrices(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("packing", token_matrices),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        made = materialize(stage(spark, docs, sf_dir))
        discard(docs)  # what the stage before has written; the source table is none of ours and stays
        docs = made
    return docs
