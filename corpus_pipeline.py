"""Corpus pipeline: language ID, near-duplicate join, repeated passages,
benchmark decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from busframes.llm.byte_cnn import keep_identified
from busframes.llm.ngram_join import keep_one
from busframes.llm.packing import pack_stage
from busframes.llm.string_tiling import drop_contaminated
from busframes.llm.suffix_repeats import drop_repeats
from busframes.session import shared_dir

#: (name, function of (spark, docs, sf_dir)); each works on all that the one
#: before it kept, and all but the last return the columns of documents
STAGES = [
    ("language_id", keep_identified),
    ("near_duplicates", keep_one),
    ("repeated_passages", drop_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_stage),
]

#: Learned models, string tiling and packing are not SQL-expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``, each stage written as
    Parquet in the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
