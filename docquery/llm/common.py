"""Helpers that several training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Training and held-out rows are told apart by crc32(doc_id as text) mod FOLDS; rest 0 is held out.
FOLDS = 5
#: Narrow rows (some 64 bytes each) that one side of a join may have to be broadcast; beyond it both sides are shuffled.
MAX_BROADCAST = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(col: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod 5 as int; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int")


def fold_of(doc_id) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS


def column(name: str) -> Column:
    """The column of that very name, dots and backquotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns(df: DataFrame) -> list[Column]:
    """All columns of df by their names, whatever these hold."""
    return [column(c) for c in df.columns]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to be none of df's (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def guarded(df: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """df with every column that `used` doesn't name renamed other_0, other_1 …, and what brings back all names and their order."""
    names = {c: c if c in used else f"other_{k}" for k, c in enumerate(df.columns)}
    renamed = df.select(*(column(c).alias(n) for c, n in names.items()))
    return renamed, lambda out: out.select(*(F.col(n).alias(c) for c, n in names.items()))


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that all executors share: the session's spark.checkpoint.dir.

    Where none is set, a local session (tests, a notebook) makes one; a cluster must set it.
    """
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        at = spark.conf.get("spark.checkpoint.dir", None)
        if not at and not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(at or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return context._jsc.sc().getCheckpointDir().get()


def stored(df: DataFrame) -> DataFrame:
    """df written to the checkpoint folder all executors share, its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def small_side(df: DataFrame, most: int = MAX_BROADCAST) -> DataFrame | None:
    """df, a stored frame of narrow rows, to be broadcast; None if it has more than `most` rows, so that the caller joins it as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else None


def written(df: DataFrame) -> DataFrame:
    """df written as Parquet to the checkpoint folder and read again: unlike `stored`, compressed, and columns are read apart."""
    at = f"{shared_folder(df.sparkSession)}/written-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def numbered(df: DataFrame, file: str, row: str) -> DataFrame:
    """df with two columns that tell every row from any other, the same each time that the rows are read.

    Rows straight from Parquet files have a place there, and nothing is written. Any other
    frame may give its rows another order when it is worked out again, so it is stored.
    """
    if df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        try:
            return df.withColumns({file: F.xxhash64("_metadata.file_path"), row: F.col("_metadata.row_index")})
        except AnalysisException:  # files of another kind
            pass
    return stored(df.withColumns({file: F.lit(0).cast("long"), row: F.monotonically_increasing_id()}))


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """df with a gapless rank from 0 in the given order, without a task that sees all rows.

    Rows are range-partitioned and sorted; monotonically_increasing_id() then holds the
    partition in its upper and the place in the partition in its lower 33 bits. Only one
    count per partition is gathered (and broadcast: as many rows as there are partitions).
    Rows that tie on the whole order get adjacent ranks in no particular order.
    """
    low = (1 << 33) - 1
    rows = stored(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        rows.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit(low)))
        .drop("_part", "_at", "_before")
    )


def sampled(df: DataFrame, bound: int, key: str = "doc_id", seed: int = 7) -> DataFrame:
    """About `bound` rows of df at most, chosen by a hash of the key: reruns agree.

    Rows that tie on the key are kept or left out together, so the caller's bound is on
    distinct keys.
    """
    n = df.count()
    if n <= bound:
        return df
    share = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return df.filter(share < bound / n)


def held(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labels (one narrow row per doc_id) whose doc_id is in docs, as it is there. Ids alone are shuffled, no texts."""
    own = F.col("doc_id").try_cast(docs.schema["doc_id"].dataType)
    return labels.withColumn("doc_id", own).filter("doc_id is not null").join(docs.select("doc_id").distinct(), "doc_id", "left_semi")


def fetched(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """The rows of docs that picked names, with its columns, stored.

    picked comes from `sampled`, so it is small enough to broadcast at any size of docs: one
    scan finds its rows where they lie.
    """
    return stored(docs.join(F.broadcast(picked), "doc_id"))
