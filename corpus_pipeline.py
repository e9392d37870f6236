"""Corpus pipeline: from raw documents to sharded training data, each stage a DataFrame job on what its predecessor kept."""

from pyspark.sql import DataFrame, SparkSession

from marlstone.llm import decontam, kdshard, mixing, ngramjoin, quality
from marlstone.llm.common import materialise, table

#: (name, function of spark, docs and sf_dir), in the order in which they run.
STAGES = [
    ("quality_classifier", quality.keep_stage),
    ("ngram_jaccard_join", ngramjoin.one_of_each_stage),
    ("benchmark_decontamination", decontam.clean_stage),
    ("source_mixing", mixing.mix_stage),
    ("kd_sharding", kdshard.shard_stage),
]

#: No SQL states a trained classifier; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages; each stage but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
