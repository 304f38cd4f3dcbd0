"""A training corpus from raw documents: five stages, each on all that the stage before it kept.

Every stage's rows are written as Parquet and read again by the next, so a lost executor costs
one stage at most. The folder is the one all executors share.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from docquery.llm.common import shared_folder
from docquery.llm.mixing import mix_sources
from docquery.llm.secrets import mask_secrets
from docquery.llm.sentencepiece import tokenise
from docquery.llm.simhash import drop_near_duplicates
from docquery.llm.toxicity import drop_toxic

STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scans", mask_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", tokenise),
]

#: The first stage's trees and the second's fingerprints can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every document that the corpus keeps, once for each time that the mix takes it."""
    home = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{k}-{name}")
        docs = spark.read.parquet(f"{home}/{k}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
