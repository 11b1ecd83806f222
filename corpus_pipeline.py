"""A corpus pipeline of five stages; each works on all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.llm import langid, lines, mixing, packing, simhash
from landweave.llm.common import table, written
from landweave.llm.queries import tokenizer

#: Texts less like their nearest language profile than this are no language's.
LEAST_SCORE = 0.2


def _as_documents(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without a letter or unlike all profiles go."""
    profiles = langid.fit_profiles(docs.where(~langid.is_held_out()))
    found = langid.identify(docs, profiles)
    return _as_documents(found.where((F.col("language.lang_pred") != "und") & (F.col("language.score") >= LEAST_SCORE)), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many sources carry."""
    return _as_documents(lines.remove_boilerplate(docs, min_sites=10, site="source", min_words=3), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose shingles of five words are alike to 0.8 or more."""
    return simhash.drop_near_duplicates(docs, width=5, distance=28, least=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as its source's target takes it."""
    return _as_documents(mixing.in_training_order(mixing.mix(docs, whole_documents=True)), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"), size=1024, end_id=0)


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix", mix_sources), ("pack", pack)]

#: Profiles, fingerprints and token ids can't be expressed in SQL; tests hold every stage against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
