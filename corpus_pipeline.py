"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark decontamination, BPE.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns the
columns of ``documents`` (the last: digests of the ids). ``run`` writes each result to the shared
folder and reads it back, so that a lost executor costs one stage's tasks at most.

Language ID and BPE cannot be said in SQL, so ORACLE_SQL is None; tests compare the stages with
brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import bpe, decontam, langid, line_dedup, simhash_dups
from shelfspark.llm.common import cut

STAGES = [
    ("language_id", langid.stage),
    ("line_dedup", line_dedup.stage),
    ("simhash_near_dedup", simhash_dups.stage),
    ("benchmark_decontamination", decontam.stage),
    ("bpe", bpe.stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
