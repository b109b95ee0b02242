"""From raw documents to packed token sequences: five stages, each over all that the one before has kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as Parquet in the shared folder and
reads it again for the next one, so that a lost executor costs one stage at most. All stages but the last return the
columns of ``documents``. As the output of a stage is written before the next one starts, a stage deletes the tables that the
stages before it have worked with.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from rowharbor.llm import classifier, lines, minhash, secrets
from rowharbor.llm.queries import pack
from rowharbor.session import cut_lineage, drop_scratch, scratch_under


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labels outside the held-out third, takes to be good."""
    return classifier.keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand, within two edits, in more than six documents; their first place keeps them."""
    return lines.remove_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return minhash.keep_representatives(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with the values of live-looking secrets replaced; widely copied examples stay."""
    return secrets.redact_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in sequences of 1024 tokens."""
    return pack(docs)


STEPS = {
    "quality classifier": quality,
    "line dedup": line_dedup,
    "minhash near-dedup": near_dedup,
    "secret scan": secret_scan,
    "packing": packing,
}


def _stage(name: str) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A step that starts with the working tables of earlier stages deleted and keeps its own together."""
    place = list(STEPS).index(name)

    @wraps(STEPS[name])
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for earlier in list(STEPS)[:place]:
            drop_scratch(spark, earlier.replace(" ", "-"))
        with scratch_under(name.replace(" ", "-")):
            return STEPS[name](spark, docs, sf_dir)

    return stage


STAGES = [(name, _stage(name)) for name in STEPS]

#: SQL has no expression for the network and the tokens; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
