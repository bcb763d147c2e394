"""A training corpus in five stages: language, quality, near duplicates, source mix, token ids.

Each stage takes the documents that the one before kept and returns them as a DataFrame; all but the
last return the columns of ``documents``. ``run`` applies them in turn, each result stored.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm import bpe, chosen_path, mixing, random_index, unigram_language
from tamiz.llm.base import held_out, keyed_rows, release_driver, ship_package
from tamiz.session import materialize

LEAST_LANGUAGE_SCORE = 0.5
LEAST_QUALITY = 0.5  # below it, a document is likelier of label 0 than of label 1


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; texts without a letter and undecided ones go."""
    ship_package(spark)
    pieces = unigram_language.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = unigram_language.fit(docs, pieces, ~held_out("doc_id", 5, 0))
    named = unigram_language.identify(docs, model, pred="pipeline_lang", score="pipeline_score")
    kept = (F.col("pipeline_lang") != "und") & (F.col("pipeline_score") >= LEAST_LANGUAGE_SCORE)
    return named.filter(kept).select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier good than bad, as ``labels.quality`` marks them."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = random_index.fit(docs, labels, ~held_out("doc_id", 4, 2))
    scored = random_index.classify(docs, model, score="pipeline_score")
    return scored.filter(F.col("pipeline_score") >= LEAST_QUALITY).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that shares most five-word shingles: the one with the smallest id, null last.

    Rows that repeat an id, or have none, are told apart by a number, and are a group's like all others.
    """
    ship_package(spark)
    rows, key = keyed_rows(docs, "doc_id", "pipeline_row")
    judged = chosen_path.near_duplicates(rows, doc_id=key, width=5, similarity=0.8)
    if key == "doc_id":
        dropped = materialize(judged.filter(~F.col("kept")).select(F.col("doc_id").alias("dropped")), "dropped")
        return rows.join(dropped, rows["doc_id"] == dropped["dropped"], "left_anti")
    groups = judged.select(F.col("doc_id").alias(key), "component_id").join(rows.select(key, "doc_id"), key)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", key))
    kept = materialize(groups.groupBy("component_id").agg(first.alias("first")).select(f"first.{key}"), "pipeline-kept")
    return rows.join(kept, key, "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    ship_package(spark)
    return mixing.copies_of(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids_sha256, round_trip``: the ids decode to the text."""
    ship_package(spark)
    vocabulary = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    narrow = docs.select("doc_id", "lang", "source", "text")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    encoded = bpe.encode(narrow, vocabulary, public_tokenizers.PATTERN).select("doc_id", "lang", "source", digest, "ids")
    # Stored between the two, so that a task has one Python worker at a time and not one for each.
    done = bpe.decode(materialize(encoded, "pipeline-ids"), vocabulary)
    return done.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        (F.sha2(F.col("decoded"), 256) == F.col("text_sha256")).alias("round_trip"),
    )


STAGES = [
    ("language", identify_language),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("token_ids", encode_tokens),
]

# Language, quality and near duplicates cannot be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release_driver(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
