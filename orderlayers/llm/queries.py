"""Each operator applied to its whole table, with the parameters its result is defined by."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlayers.llm.common import ship_package, stored, table
from orderlayers.llm import langid
from orderlayers.llm.bpe import BpeCodec
from orderlayers.llm.decontaminate import contaminated
from orderlayers.llm.embedding_dedup import embedding_components
from orderlayers.llm.license_scan import license_scan
from orderlayers.llm.maxent_lm import MaxentScorer, in_training
from orderlayers.llm.minhash import minhash_components
from orderlayers.llm.pii import personal_data
from orderlayers.llm.prefix_tokens import budget_answers, prefix_store
from orderlayers.llm.quality import grade_documents, train_grade_model
from orderlayers.llm.spotsigs import compare_edited
from orderlayers.llm.token_alignment import Aligned
from orderlayers.llm.whitening import whiten_embeddings

Query = Callable[[SparkSession, str], DataFrame]


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of embeddings of one label at cosine 0.93 and more, and their components."""
    return embedding_components(table(spark, sf_dir, "embeddings"), least=0.93)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held = langid.held_out()
    model = langid.train_language_model(docs.select("doc_id", "text", "lang").filter(~held))
    found = langid.predict_languages(docs, model)
    kept = (~F.col("rejected")).alias("kept")
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", kept)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, and which."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contaminated(docs, benchmark).drop("row_key")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and passages in every document."""
    return license_scan(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    docs = table(spark, sf_dir, "documents")
    return BpeCodec(docs, public_tokenizers.path("word_bpe_49k.json")).digests(docs)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smoothed counts' and the model's log10 probability of every document."""
    docs = table(spark, sf_dir, "documents")
    found = MaxentScorer(docs.select("doc_id", "text").filter(in_training())).score(docs)
    columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return found.select("doc_id", (~in_training()).alias("held_out"), *columns)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document, fixed patterns and the classifier's."""
    return personal_data(table(spark, sf_dir, "documents"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word shingles, similarity 0.8: components over all documents."""
    return minhash_components(table(spark, sf_dir, "documents"), n=2, percent=80).drop("row_key")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, whether it has more than 4096 tokens, and how far they reach."""
    docs = table(spark, sf_dir, "documents")
    store = stored(prefix_store(docs, public_tokenizers.path("piece_bpe_32k.model")), "prefix-store", "zstd")
    answers = budget_answers(store, 4096)
    return answers.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"), "n_chars", "fitting_chars")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of every document, learned from all ratings."""
    docs = table(spark, sf_dir, "documents")
    return grade_documents(docs, train_grade_model(docs, table(spark, sf_dir, "labels")))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness."""
    return compare_edited(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the sixteen largest components of the covariance, whitened."""
    return whiten_embeddings(table(spark, sf_dir, "embeddings"), components=16)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned in every document."""
    docs = table(spark, sf_dir, "documents")
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return Aligned(docs, *paths).digests(docs)


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    run.__doc__ = query.__doc__
    return run


QUERIES: dict[str, Query] = {
    f.__name__: _ready(f)
    for f in (
        op1_embedding_dedup,
        op2_language_id,
        op3_decontamination,
        op4_license_scan,
        op5_bpe,
        op6_lm_scoring,
        op7_personal_data,
        op8_minhash,
        op9_token_counts,
        op10_quality,
        op11_fingerprints,
        op12_whitening,
        op13_token_alignment,
    )
}


def oracle_sql() -> dict[str, str]:
    return {}
