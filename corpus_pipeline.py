"""The text pipeline: from `documents` to the token ids of what is worth training on.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a frame with the
columns of `documents`, the last one also token ids. Stages may be run one by one with a table between
them. Columns that `documents` has besides its own stay as they are.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import bpe, decontaminate, jaccard_join, language, line_dedup
from riskflow.llm.common import bounded_batches, materialize

#: Documents whose words are of their likeliest language with a smaller mean probability are rejected.
MIN_SCORE = 0.3
VOCABULARY = "word_bpe_49k.json"


def _set_aside(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """Renames columns that an operator would replace; also how to name them back."""
    clashing = {c: f"__own_{c}" for c in docs.columns if c in names}
    return docs.withColumnsRenamed(clashing), {v: k for k, v in clashing.items()}


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is told with some certainty. A null text is rejected."""
    bounded_batches(spark)
    rows, back = _set_aside(docs, ("lang_pred", "score"))
    judged = language.identify(rows, language.train(docs))
    kept = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_SCORE)
    return judged.where(kept).select(*rows.columns).withColumnsRenamed(back)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many share. `n_chars` is that of the new text."""
    bounded_batches(spark)
    rows, back = _set_aside(docs, ("n_lines", "n_dropped", "kept"))
    found = line_dedup.dedup_lines(rows).withColumn("text", F.col("kept"))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*rows.columns).withColumnsRenamed(back)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of similar documents, that with the smallest id; rows without id, or with one used twice, count as any."""
    bounded_batches(spark)
    return jaccard_join.one_of_each_class(docs)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of `benchmark`."""
    bounded_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, items)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with `ids`, the token ids of the text, and `n_tokens`."""
    bounded_batches(spark)
    rows = bpe.encode(docs, public_tokenizers.path(VOCABULARY))
    return rows.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language", known_language),
    ("lines", distinct_lines),
    ("near_copies", one_of_each_group),
    ("test_items", without_test_items),
    ("tokens", tokens),
]

#: Neither the language model nor the tokenizer can be written in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
