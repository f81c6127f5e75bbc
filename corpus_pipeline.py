"""From raw documents to tokens: language, near copies, benchmark passages, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; its
result is written as Parquet and read again as the next stage's documents. All stages but the last
return the columns of ``documents``. Empty tables pass through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlayers.llm.bpe import BpeCodec
from orderlayers.llm.common import ship_package, stored, table
from orderlayers.llm.decontaminate import drop_contaminated
from orderlayers.llm.langid import keep_known_languages, train_language_model
from orderlayers.llm.minhash import keep_one_of_each
from orderlayers.llm.pii import redact, train_span_classifier


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the classifier, learned from the labelled ones, accepts."""
    ship_package(spark)
    return keep_known_languages(docs, train_language_model(docs.select("doc_id", "text", "lang")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    ship_package(spark)
    return keep_one_of_each(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship_package(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return redact(docs, train_span_classifier(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digest of the decoded text of every document."""
    ship_package(spark)
    codec = BpeCodec(docs, public_tokenizers.path("word_bpe_49k.json"))
    found = codec.encode(docs)
    return found.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: SQL can express neither a learned classifier nor connected components or BPE merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of ``documents`` after all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
