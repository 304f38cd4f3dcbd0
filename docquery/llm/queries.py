"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docquery.llm.langid import op2_language
from docquery.llm.licenses import op4_licenses
from docquery.llm.mixing import op6_mixing
from docquery.llm.quality import op5_quality
from docquery.llm.secrets import op9_secrets
from docquery.llm.sentencepiece import op10_sentencepiece
from docquery.llm.sharding import op7_sharding
from docquery.llm.simhash import op3_simhash
from docquery.llm.topk import op8_topk
from docquery.llm.toxicity import op1_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_toxicity, op2_language, op3_simhash, op4_licenses, op5_quality, op6_mixing, op7_sharding, op8_topk,
            op9_secrets, op10_sentencepiece,
        )
    }


TOP_K_SQL = """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.q) = len(b.q)
), placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5
"""


def expected_sql() -> dict[str, str]:
    """Whole queries only; operators with fitted models or columns of their own are tested against brute force instead."""
    return {"op8_topk": TOP_K_SQL}
