"""Corpus pipeline over ``documents``: quality classifier, exact dedup, MinHash near-dedup, mixing of
sources to target weights, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet and
rereads as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm import queries as q
from gondola.llm.bpe import bpe_round_trip
from gondola.llm.common import table, text_or_empty, written
from gondola.llm.exact_dedup import exact_dedup
from gondola.llm.minhash import near_dedup
from gondola.llm.mixing import mix_sources
from gondola.llm.quality import classify

#: Words of a shingle in the near-dedup stage; op9 has its own rule of four.
MINHASH_SHINGLE = 5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject, as they are."""
    verdicts = classify(docs, q.trusted_labels(spark, sf_dir))
    rejected = verdicts.where("not kept").select(F.col("id").alias("bad_id"), F.col("fp").alias("bad_fp")).distinct()
    at = F.xxhash64(text_or_empty("text"))
    return docs.join(rejected, docs["doc_id"].eqNullSafe(F.col("bad_id")) & (at == F.col("bad_fp")), "left_anti")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    kept = exact_dedup(docs).where("kept")
    return kept.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def minhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates (0.8 of the five-word shingles), the one with the smallest id."""
    dropped = near_dedup(docs, shingle=MINHASH_SHINGLE).where("not kept").select(F.col("id").alias("doc_id"))
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The production mix; a document that is taken for two epochs comes twice."""
    out = mix_sources(docs, q.mix_levels(), F.expr(q.TOKENS), q.MIX_WEIGHTS, q.MIX_FRACTION, q.MIX_EPOCHS, q.MIX_SEED)
    return out.select("row.*")


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the mix, with the source of every row."""
    import public_tokenizers

    out = bpe_round_trip(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.withColumnRenamed("id", "doc_id")


STAGES = [("quality_classifier", quality_classifier), ("exact_dedup", exact), ("minhash_dedup", minhash),
          ("mix_sources", mixing), ("bpe", bpe)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each on the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier's model is no SQL; tests/llm hold the stages against brute force instead.
ORACLE_SQL = None
