"""A corpus pipeline of four operators: toxicity, quality rules, near-duplicate removal, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.llm import quality, toxicity
from quantspark.llm.common import scratch, staged
from quantspark.llm.jaccard import BROADCAST_ROWS, jaccard_components
from quantspark.llm.packing import pack


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7, all columns as they were."""
    model, _ = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return model.filter(docs)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and aren't anomalous, all columns as they were."""
    stats = staged(quality.with_statistics(docs), "statistics")
    return quality.fit(stats, spark.read.parquet(f"{sf_dir}/labels.parquet")).filter(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str, percent: int = 80, k: int = 5) -> DataFrame:
    """One document of each component stays, that with its smallest id; five words and a similarity of 0.8.

    Ids to drop are broadcast only up to ``BROADCAST_ROWS`` of them. Rows without an id stay, as they can't be named;
    rows that repeat the id that stays are that document and stay with it.
    """
    found = jaccard_components(docs, k=k, percent=percent)
    gone = staged(found.filter(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct(), "copies")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, their sequences and offsets."""
    return pack(docs, most=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("packing", pack_documents),
]

#: The classifier, the forest and the tokenizer have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
