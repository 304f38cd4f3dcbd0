"""Distinct values, summaries and inferred schemas of documents (key, doc, content)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquery.errors import QueryError
from docquery.functions.values import canonical_text, get, kind, sort_key
from docquery.plans.lower import Root, items_at, opened
from docquery.plans.paths import Subscripts, parse_path

#: Levels of containers that a data guide opens before it looks for more.
STEPS = 8


def _values(docs: DataFrame, path: str, root: Root | None = None) -> DataFrame:
    steps = parse_path(path)
    if any(isinstance(s, Subscripts) for s in steps):
        raise QueryError(2091, "a path of distinct takes no array steps")
    return docs.select(F.explode(opened(items_at(root or F.col("doc"), steps))).alias("item"))


def distinct(docs: DataFrame, path: str, root: Root | None = None) -> DataFrame:
    """(kind, value, n): every value at the path, arrays opened, and how many items have it; containers by their JSON."""
    rows = _values(docs, path, root)
    item = F.col("item")
    value = F.when(kind(item).isin("array", "object", "other"), F.to_json(item)).otherwise(canonical_text(item))
    return rows.select(kind(item).alias("kind"), value.alias("value")).groupBy("kind", "value").agg(F.count("*").alias("n"))


def distinct_strict(docs: DataFrame, path: str, root: Root | None = None) -> DataFrame:
    """(item,): distinct JSON values at the path, equal as the sort order of all types has them."""
    rows = _values(docs, path, root).withColumn("_k", sort_key(F.col("item")))
    return rows.groupBy("_k").agg(F.first(F.to_json("item")).alias("item")).select("item")


def summarize(docs: DataFrame) -> DataFrame:
    """(n, total_bytes) of the documents' contents."""
    return docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("content")), F.lit(0)).cast("long").alias("total_bytes"))


def _children(item: Column) -> Column:
    """The fields of an object under their paths, or the elements of an array under its own."""
    place = lambda path, level, x, field: F.struct(path.alias("path"), level.alias("level"), x.alias("item"), F.lit(field).alias("field"), kind(x).alias("kind"))
    fields = F.transform(F.map_entries(get(item["item"], "map<string,variant>")), lambda e: place(F.concat_ws(".", item["path"], e["key"]), item["level"] + 1, e["value"], True))
    elements = F.transform(get(item["item"], "array<variant>"), lambda x: place(item["path"], item["level"], x, False))
    return F.coalesce(fields, elements)


def data_guide(docs: DataFrame, depth: int | None = None) -> DataFrame:
    """(path, kind, n, max_length) of every field path, or of those down to a depth of fields; arrays of any nesting opened.

    Containers are opened STEPS levels at a time within the rows, until none is left; only a look whether
    any is runs at once.
    """

    def inner(x: Column) -> Column:
        within = x["kind"].isin("array", "object")
        return within if depth is None else within & (x["level"] < depth)

    def fact(x: Column) -> Column:
        length = F.length(F.when(x["kind"] == "string", get(x["item"], "string")))
        return F.struct(x["path"].alias("path"), x["kind"].alias("kind"), length.alias("length"))

    first = F.struct(F.lit("$").alias("path"), F.lit(0).alias("level"), F.col("doc").alias("item"), F.lit(False).alias("field"), kind(F.col("doc")).alias("kind"))
    level = docs.select(F.filter(F.array(first), inner).alias("open"))
    found = None
    while True:
        level = level.withColumn("seen", F.array().cast("array<struct<path:string,kind:string,length:int>>"))
        for _ in range(STEPS):
            level = level.select("seen", F.flatten(F.transform("open", _children)).alias("next"))
            level = level.select(F.concat("seen", F.transform(F.filter("next", lambda x: x["field"]), fact)).alias("seen"), F.filter("next", inner).alias("open"))
        part = level.select(F.explode("seen").alias("fact")).select("fact.*")
        found = part if found is None else found.union(part)
        level = level.filter(F.size("open") > 0).select("open")
        if level.isEmpty():
            return found.groupBy("path", "kind").agg(F.count("*").alias("n"), F.max("length").alias("max_length"))
