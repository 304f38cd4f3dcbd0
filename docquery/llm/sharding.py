"""Sharding along a Hilbert curve, so that files can be pruned in several metadata dimensions.

Every document becomes a point: the logarithm of its size, its language and its source, each
quantised to `BITS` bits. Points are ranked by their index on the Hilbert curve (then by the
text's CRC-32 and XXH64 and by doc_id), and the ranking is cut into runs of equal row counts:
neighbours on the curve are near in all dimensions, so a shard covers narrow ranges of each.

Equal texts form a group, and a group is one point: if its rows differ in language or source, all
stand at its least pair of them (nulls last). So the rows of a group are neighbours wherever they
come from. Only groups that differ are joined back, as one narrow row each.

At scale the ranking is a range-sort of narrow rows (no texts) that also splits one hot point,
as doc_id is part of the order; only one count per partition is gathered.

Defined results: a null text has size 1 like an empty one, and CRC-32 zero; null languages and
sources come first in their dimension; repeated rows are rows of their own. `slot` is gapless from
0 in each shard, and shards differ by one row at most. Equal texts have slots that follow each
other, so they share a shard unless a cut falls between them or there are too many for one. doc_id
may be of any type that sorts; very long texts are only measured; other columns are left aside.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.llm.common import column, columns, fresh, numbered, ranked, small_side, stored, table

SHARDS = 8
BITS = 8
#: What tells a text from others, in the order of the ranking.
TEXT = ("text_crc32", "text_hash", "size")


def hilbert_index(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of points (rows, dimensions), coordinates of `bits` bits.

    Skilling's transformation ("Programming the Hilbert curve", 2004), on whole columns.
    """
    x = [c.astype(np.int64) for c in points.T]
    d = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(d):
            turned = (x[i] & q) > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = x[0] ^ np.where(turned, low, swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> level) & 1, (1 << level) - 1, 0)
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for c in x:
            out = out << 1 | ((c ^ flip) >> level) & 1
    return out


def quantised(rows: DataFrame, name: str, bits: int = BITS) -> DataFrame:
    """rows with q_<name>: the rank of the value among the column's distinct values, scaled to `bits` bits; null is 0."""
    values = stored(ranked(rows.filter(F.col(name).isNotNull()).select(name).distinct(), [F.col(name)], "_rank"))
    scale = ((1 << bits) - 1) / max(1, values.count())
    found = values.select(F.col(name).alias("_value"), (1 + F.floor(F.col("_rank") * scale)).cast("int").alias("_q"))
    met = rows.join(found, F.col(name) == F.col("_value"), "left")
    return met.withColumn(f"q_{name}", F.least(F.coalesce("_q", F.lit(0)), F.lit((1 << bits) - 1))).drop("_value", "_q")


def size_of(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def grouped(rows: DataFrame) -> DataFrame:
    """rows with at_lang and at_source: the least (lang, source) among the rows of equal text.

    Counted per group before anything is joined; what is joined is one row per group whose rows
    differ, broadcast up to a checked size.
    """
    pair = F.struct(
        F.col("lang").isNull().alias("no_lang"), F.coalesce("lang", F.lit("")).alias("lang"),
        F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source"),
    )
    groups = rows.groupBy(*TEXT).agg(F.min(pair).alias("low"), F.max(pair).alias("high")).filter("low != high")
    differ = stored(groups.select(*(F.col(c).alias(f"_{c}") for c in TEXT), "low"))
    same = [F.col(c) == F.col(f"_{c}") for c in TEXT]
    met = rows.join(small_side(differ) or differ, same, "left")
    own = lambda name: F.when(F.col("low").isNull(), F.col(name)).when(~F.col("low")[f"no_{name}"], F.col("low")[name]).alias(f"at_{name}")
    return met.select(*rows.columns, own("lang"), own("source"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """(doc_id, size, text_crc32, lang, source, curve, shard, slot) per row of docs (doc_id, text, lang, source)."""
    return shard_rows(docs.select("doc_id", "text", "lang", "source"), shards, bits).drop("text_hash", "at_lang", "at_source")


def shard_rows(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """`shard_documents` with any other columns of docs but the text, and those that place a row."""
    text = F.coalesce("text", F.lit(""))
    rows = stored(docs.withColumns({"size": size_of(), "text_crc32": F.crc32(text.cast("binary")), "text_hash": F.xxhash64(text)}).drop("text"))
    placed = grouped(rows)
    placed = placed.withColumn("q_size", F.least(F.floor(F.log2("size") * ((1 << bits) / 32)), F.lit((1 << bits) - 1)).cast("int"))
    for name in ("at_lang", "at_source"):
        placed = quantised(placed, name, bits)
    curve = F.pandas_udf(lambda *x: pd.Series(hilbert_index(np.stack([c.to_numpy(np.int64) for c in x], axis=1), bits)), "long")
    placed = placed.withColumn("curve", curve("q_size", "q_at_lang", "q_at_source"))
    placed = ranked(placed, [F.col(c) for c in ("curve", *TEXT, "doc_id")])
    n = rows.count()
    shard = F.expr(f"(cast(rank as decimal(38,0)) * {shards}) div {max(n, 1)}").cast("int")
    first = F.expr(f"(cast(shard as decimal(38,0)) * {n} + {shards - 1}) div {shards}").cast("long")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("rank") - first).drop("rank", "q_size", "q_at_lang", "q_at_source")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write docs as Parquet, one folder per shard, rows in slot order, with statistics that prune.

    Rows meet their shard by their place in the input, so repeated ids and rows stay rows of their
    own. The files have docs' columns, of any names but `shard`.
    """
    if "shard" in (c.lower() for c in docs.columns):
        raise ValueError("a column named shard is in the way of the folders' names")
    file, row, slot = fresh(docs, "_file", "_row", "_slot")
    texts = numbered(docs, file, row)
    place = shard_rows(texts.select(column(file).alias("_f"), column(row).alias("_r"), "doc_id", "text", "lang", "source"), shards)
    at = place.select("_f", "_r", "shard", F.col("slot").alias(slot))
    met = texts.join(at, (column(file) == F.col("_f")) & (column(row) == F.col("_r"))).repartitionByRange("shard", column(slot))
    met.sortWithinPartitions("shard", column(slot)).select(*columns(docs), "shard").write.partitionBy("shard").parquet(path)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve", "lang", "source")
