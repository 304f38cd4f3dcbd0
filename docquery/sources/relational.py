"""Document collections over relational tables: each row, or group of rows, is a JSON document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def complete(column: Column, kind: T.DataType) -> Column:
    """Whether a value and all within it are there: null members have no place in a document."""
    out = column.isNotNull()
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            out = out & complete(column[f.name], f.dataType)
    elif isinstance(kind, T.ArrayType):
        out = out & F.forall(column, lambda x: complete(x, kind.elementType))
    return out


def is_json(kind: T.DataType) -> bool:
    """Whether JSON text keeps values of the type as they are, as VARIANT does."""
    if isinstance(kind, T.StructType):
        return all(is_json(f.dataType) for f in kind.fields)
    return is_json(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, T.StringType | T.LongType | T.IntegerType | T.DoubleType | T.BooleanType)


def as_variant(value: Column, kind: T.DataType) -> Column:
    """A value as VARIANT, NULL if it is null; by way of its text where something within is null."""
    if not isinstance(kind, T.StructType | T.ArrayType):
        return value.cast("variant")
    return F.when(complete(value, kind), F.to_variant_object(value)).otherwise(F.parse_json(F.to_json(value)))


def as_documents(rows: DataFrame, key: Column, *members: Column) -> DataFrame:
    """(key, content, doc, plain, members): one document per row from its members; null members are left out.

    doc is made from the columns themselves, by way of the text only where something is null;
    content is the text, worked out only if asked for. plain has the members that are strings or
    numbers, for conditions that can reach the scan; members has all of them as items of their
    own, so that a filter makes no more of the document than it looks at.
    """
    rows = rows.select(key.cast("string").alias("key"), F.struct(*members).alias("_members"))
    kind = rows.schema["_members"].dataType
    whole, text = F.col("_members"), F.to_json("_members")
    if not is_json(kind):
        return rows.select("key", text.alias("content"), F.parse_json(text).alias("doc"))
    scalars = [whole[f.name].alias(f.name) for f in kind.fields if not isinstance(f.dataType, T.StructType | T.ArrayType | T.BooleanType)]
    items = F.struct(*(as_variant(whole[f.name], f.dataType).alias(f.name) for f in kind.fields)).alias("members")
    return rows.select("key", text.alias("content"), as_variant(whole, kind).alias("doc"), *([F.struct(*scalars).alias("plain")] if scalars else []), items)


def mapped(rows: DataFrame, key: str) -> DataFrame:
    """A read-only collection over any table or view."""
    return as_documents(rows, F.col(key), *map(F.col, rows.columns))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer and their items: the items are grouped before they are joined."""
    t = lambda name: _table(spark, sf_dir, name)
    item = F.struct(
        F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("partkey"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"), F.col("l_returnflag").alias("returnflag"),
    )
    items = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    rows = t("orders").join(items, "o_orderkey", "left").join(t("customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "left")
    customer = F.struct(F.col("o_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return as_documents(
        rows, F.col("o_orderkey"), F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("orderdate"), F.col("o_orderpriority").alias("priority"), customer.alias("customer"), "items",
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = lambda name: F.col(f"p_{name}").alias(name)
    return as_documents(_table(spark, sf_dir, "part"), F.col("p_partkey"), *map(c, ("partkey", "name", "brand", "type", "size", "retailprice")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events; the text column props is JSON itself and becomes part of the document."""
    members = F.to_json(F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "user_id", F.col("event_type").alias("type"), "value"))
    content = F.concat(F.substring(members, 1, F.length(members) - 1), F.lit(',"props":'), F.coalesce("props", F.lit("null")), F.lit("}"))
    rows = _table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("key"), content.alias("content"))
    return rows.withColumn("doc", F.parse_json("content"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels; many have none, so the member is missing."""
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.struct("quality", "toxic").alias("labels"))
    rows = _table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    return as_documents(rows, F.col("doc_id"), "doc_id", "lang", "source", "n_chars", "text", "labels")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    rows = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns)
    return as_documents(rows, F.col("conv_id"), "conv_id", "turns")
