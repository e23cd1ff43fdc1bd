"""A corpus made ready for training: five stages, each one operator of ``textmill.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each
stage's rows as Parquet in the shared folder and reads them again as the next one's
``docs``. All but the last return the columns that they got.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import exact_index, language_id, mixing, piece_sampling, simhash_cover
from textmill.llm.common import col
from textmill.session import cut, scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; the dictionaries are fitted on labelled rows of ``docs``.

    Without any labelled text nothing can be judged, so nothing is rejected and all rows pass.
    """
    model = language_id.fit(docs)
    if not model:
        return docs
    scored = language_id.predict(docs, model)
    return scored.where(~F.col("rejected")).select(*[col(c) for c in docs.columns])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, by a digest index that this run starts."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = exact_index.DigestIndex(spark, scratch_path(spark, "digests"), buckets)
    index.admit(docs, "run")
    return index.dedup(docs, "run")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar fingerprints."""
    return simhash_cover.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weight, in the order of virtual finish times; a document may come twice."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source`` and the sampled segmentations of every document."""
    encoded = piece_sampling.encode(docs, piece_sampling.read_vocabulary())
    return encoded.select("doc_id", "lang", "source", "samples")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("encode", encode_pieces),
]

#: Compression and sampled segmentations are beyond SQL: tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
