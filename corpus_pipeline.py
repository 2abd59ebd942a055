"""Documents to packed batches: five stages, each reading what the one before wrote."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motefield.llm import jaccard, language, lengths, mixing, repeats
from motefield.llm.common import bucket_count
from motefield.staging import staging_dir

LEAST_SCORE = 0.15       # cosine with the nearest language below which a long text is in none of them
REPEATS_ONCE_IN = 400    # letters after which a text has about as much from trigrams met twice as from single ones
READ = ["doc_id", "text", "lang", "source"]     # what operators use; they must leave all else as it is


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those near no language.

    A text of n letters can only be so near to its language: the expected cosine of a draw
    of n trigrams is that of a long text times sqrt(n / (n + c)), where trigrams meet again
    once in c.  The limit falls in this way, so there is no length at which it starts.  Where no
    document is labelled there are no languages, and only documents without a letter go.
    """
    names, profiles = language.prototypes(docs)
    if not names:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    letters = F.regexp_count("text", F.lit(r"\p{L}"))
    enough = F.col("score") >= LEAST_SCORE                      # at any length, so that few letters are counted
    near = enough | (F.col("score") >= LEAST_SCORE * F.sqrt(letters / (letters + REPEATS_ONCE_IN)))
    return _beside(docs, lambda d: language.predict(d, names, profiles).where((F.col("lang_pred") != language.UNKNOWN) & near))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays, the one with the least id."""
    return _beside(docs, jaccard.keep_one)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word runs that an earlier document has are cut out; documents of nothing else go."""
    return _beside(docs, lambda d: repeats.remove_repeats(d).where("n_words = 0 or n_removed < n_words"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture in its order; sources that end before the largest start again."""
    return _beside(docs, lambda d: mixing.in_order(mixing.mix(d), bucket_count(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Padded batches from optimal length buckets; in each bucket the documents keep the order of the mixture.

    ``pack_tokens``, ``pack_length``, ``pack_batch`` and ``pack_row`` are added; columns of these names are replaced.
    """
    added = ["pack_tokens", "pack_length", "pack_batch", "pack_row"]
    return _beside(docs.drop(*added), lambda d: lengths.batch(d, keep_order=True), added)


def _beside(docs: DataFrame, work: Callable[[DataFrame], DataFrame], added: list[str] = []) -> DataFrame:
    """``work`` on the columns that operators read, the others carried in one struct, so that no name can clash."""
    rest = [c for c in docs.columns if c not in READ]
    held = "held"
    while held in READ + added or any(c.startswith(held) for c in docs.columns):
        held += "_"
    named = lambda c: F.col(f"`{c}`")
    if not rest:
        return work(docs).select(*docs.columns, *added)
    out = work(docs.select(*[named(c) for c in docs.columns if c in READ], F.struct(*[named(c) for c in rest]).alias(held)))
    return out.select(*[named(c) if c in READ else F.col(held).getField(c).alias(c) for c in docs.columns], *added)


STAGES = [("language id", language_id), ("n-gram Jaccard join", near_duplicates), ("substring dedup", substring_dedup),
          ("mix sources", mix_sources), ("pack by length", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{staging_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
    return docs
