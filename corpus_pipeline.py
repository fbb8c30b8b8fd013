"""Corpus pipeline: toxicity, near duplicates, benchmark decontamination, mixing, sharding.

Every stage takes what the stage before kept, as a table; ``run`` writes each stage's rows to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import decontaminate, near_dup, queries, sharding, toxicity
from driftline.session import fresh_path, scratch, ship_package

SHARDS = 16


def _under_private_names(docs: DataFrame, results: list[str]) -> DataFrame:
    """``docs`` with the columns renamed that a stage would overwrite with results of its own."""
    return docs.withColumnsRenamed({c: f"__own_{i}" for i, c in enumerate(docs.columns) if c in results})


def _own_columns(rows: DataFrame, docs: DataFrame, results: list[str]) -> DataFrame:
    """The columns of ``docs`` as they were."""
    return rows.select(*[F.col(f"__own_{i}" if c in results else c).alias(c) for i, c in enumerate(docs.columns)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, learned from the labelled ones outside the held-out fold, does not call toxic."""
    ship_package(spark)
    model = toxicity.learn(docs, queries.toxic_labels(spark, sf_dir))
    names = toxicity.SCORES.fieldNames()
    kept = toxicity.score(_under_private_names(docs, names), model).filter("predicted = 0")
    return _own_columns(kept, docs, names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): the smallest doc_id."""
    ship_package(spark)
    return near_dup.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in passages of the benchmark."""
    ship_package(spark)
    names = decontaminate.HITS.fieldNames()
    held = _under_private_names(docs, names)
    found = decontaminate.decontaminate(held, queries.table(spark, sf_dir, "benchmark"), carry=tuple(held.columns))
    return _own_columns(found.filter(~F.col("contaminated")), docs, names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards the target weights of sources, languages and topics."""
    ship_package(spark)
    names = ["topic", "tokens", "weight", "prob", "sampled"]
    return _own_columns(queries.mixed(_under_private_names(docs, names)).filter("sampled"), docs, names)


def shard_corpus(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents with their shard and their slot in it."""
    ship_package(spark)
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard_corpus),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each stage's result written and read again; what a stage stored on its way
    is removed with it."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# Training the toxicity model and the signatures have no SQL counterpart; tests hold the stages against brute force.
ORACLE_SQL = None
