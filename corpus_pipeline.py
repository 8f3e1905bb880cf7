"""Corpus pipeline: documents to shards, one stored table per stage.

1. language ID: documents without a known language go;
2. n-gram Jaccard join: of each class of near copies one document stays;
3. benchmark decontamination: documents that quote a benchmark window go;
4. mixing sources to target weights: documents are taken as often as the mix says;
5. sharding: every taken row gets a shard and a slot.

The first two stages are beyond SQL, so there is no SQL for the rows of ``run``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatprep.llm.common import read_table, stage
from chatprep.llm.decontamination import decontaminate_stage
from chatprep.llm.jaccard_join import near_duplicate_stage
from chatprep.llm.language_id import language_stage
from chatprep.llm.mixing import mix_stage
from chatprep.llm.sharding import shard_stage

STAGES = [
    ("language ID", language_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("mixing sources to target weights", mix_stage),
    ("sharding", shard_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; every stage's result is stored before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
