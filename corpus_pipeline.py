"""The corpus pipeline: documents in, packed sequences out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. Stages work on all rows of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import line_dedup as lines
from pulsegrid.llm import mixing, packing, simhash, toxicity
from pulsegrid.llm.common import scratch_path
from pulsegrid.llm.queries import learnable, vocabulary
from pulsegrid.sources.tables import read_table


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go."""
    model = toxicity.train(docs, learnable(read_table(spark, sf_dir, "labels")))
    return toxicity.toxicity(docs, model).filter("predicted = 0").select(*[f"`{c}`" for c in docs.columns])


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source go; documents stay."""
    out = lines.line_dedup(docs).select(*[f"`{c}`" for c in docs.columns])
    return _sized(out)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: one row for each document and pass."""
    return _sized(mixing.mixed_documents(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's tokens lie in the sequences."""
    return packing.pack(packing.token_pieces(docs, vocabulary("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# A trained machine, fingerprints and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
