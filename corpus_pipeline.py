"""A training-data pipeline: documents in, packed token sequences out.

Each stage works on all that the one before kept; ``run`` writes each stage's
result as Parquet in the shared folder and reads it again for the next.
"""

from __future__ import annotations

import posixpath

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmarts.llm import mixing, packing, quality, secrets, simhash
from shopmarts.llm.storage import written
from shopmarts.sources.tables import read_table


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier does not reject."""
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id."""
    groups = simhash.grouped(docs, shingle=4, radius=4)
    return simhash.keep_one_per_group(docs, groups)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    table = secrets.fit_markov(secrets.labelled_samples(docs))
    return secrets.redact(docs, table)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixing.apply_mix(docs, mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their token ids."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality classifier", keep_good_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the trained classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.

    Null ids and texts, empty and very long texts, repeated rows, rows that share an
    id, an empty table and further columns of any name are handled as each
    stage's function says: a row is known by all its columns, never by its id
    alone, and no stage but the classifier and the near-dedup lets a row go.
    A document that the mix takes no copy of is not packed.
    """
    docs = spark.read.parquet(posixpath.join(sf_dir, "documents.parquet"))
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{k}")
    return docs
