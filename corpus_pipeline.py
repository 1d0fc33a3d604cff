"""Training-corpus pipeline: documents through stages, each a written table.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``. ``run``
applies them to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.op01_decontamination import without_benchmark
from tessera.llm.op03_mixing import mixed
from tessera.llm.op07_jaccard import keep_one_per_group
from tessera.llm.op08_langid import known_language
from tessera.llm.op09_token_ids import write_tokens
from tessera.llm.shared import written
from tessera.session import ship_package

STAGES = [
    ("language_id", known_language),
    ("near_duplicates", keep_one_per_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_ids", write_tokens),
]

#: language, near-duplicate and token stages cannot be stated in SQL over whole tables;
#: tests/llm/test_corpus_pipeline.py checks the rows against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
