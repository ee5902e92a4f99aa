"""The corpus pipeline: each stage works on all that the one before it has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbsight.llm import decontamination, line_dedup, near_dedup, quality, registry
from curbsight.llm.common import ship
from curbsight.session import scratch_dir


def whole(docs: DataFrame) -> DataFrame:
    """Documents with all their columns in one, so that none of them meets a name that an operator uses."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document"), "doc_id", "text")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; it is trained on the labels of this stage's rows."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score(whole(docs), quality.train(docs, labels))
    return scored.where("predicted = 1").select("document.*")


def cut_repeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated runs; ``n_chars`` follows the text."""
    ship(spark)
    cut = line_dedup.dedup_lines(whole(docs))
    changed = {"text": F.col("text"), "n_chars": registry.n_chars("text")}
    return cut.select(*(changed.get(c, F.col(f"document.`{c}`")).alias(c) for c in docs.columns))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    ship(spark)
    return near_dedup.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty is part of a benchmark phrase."""
    ship(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_benchmark(whole(docs), benchmark, keep=["document"])
    return decontamination.contaminated(found).where("not contaminated").select("document.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents with their sequence and place."""
    ship(spark)
    return registry.packed(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", cut_repeated),
    ("near-duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: A classifier is fitted and texts are tokenized, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
