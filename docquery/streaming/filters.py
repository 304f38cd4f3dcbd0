"""Filters on streams. A compiled filter is a plain column, so it runs in a stream without state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquery.plans.lower import lower
from docquery.plans.qbe import parse_query


def filter_stream(content: DataFrame, spec, column: str = "content") -> DataFrame:
    """Rows of a stream whose JSON text meets a filter; rows that are no JSON don't."""
    query = parse_query(spec)
    doc = F.try_parse_json(column)
    return content.withColumn("_doc", doc).filter(F.col("_doc").isNotNull() & lower(query.where, F.col("_doc"))).drop("_doc")
