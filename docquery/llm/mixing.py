"""Mixing sources to target weights, as a curriculum whose weights change while training runs.

DataFrame functions only. The shares of the sources are filled like connected vessels: each gets
its weight's share of all words, none more than `cap` times what it has, and what is cut off is
dealt again by weight. A source's documents stand in an order fixed by a hash of their id; it is
passed through as often as its target asks, and in the last, partial pass a document is taken if
the target reaches its middle. Within a source the weight rises or falls linearly over training
time; the integral of that schedule, inverted at a document's share of the source's demand, is
the document's training position, and positions are range-sorted.

At scale: texts are read once, for their size; all else is narrow rows. The running sums within
a source are taken in two steps, over about sqrt(rows) buckets of about sqrt(rows) rows by hash,
so a source with a third of all rows is no single task. Sources are ranked by a range-sort.

Defined results: null and empty texts have size 0 and are never taken; a null source is a source
of its own and comes last; a row with a null doc_id is hashed by its text; repeated rows are rows of
their own, however many. With no words at all, every target is 0. Very long texts are counted whole;
doc_id may be of any type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docquery.llm.common import column, fresh, guarded, numbered, ranked, stored, table

WEIGHTS = (5, 2, 1)
CAP = 3
#: How far a source's weight moves from its mean until the end of training, by rank; between -1 and 1.
SLOPES = (-0.5, 0.0, 0.5)
#: Sources, at some 100 bytes each, up to which they are broadcast.
MAX_BROADCAST_SOURCES = 20_000
#: Rows of a file among which repeated rows are numbered at once.
STRETCH = 8_192


def words_in(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_key(col: str = "source") -> Column:
    """A key that is never null: two sources are equal if it is."""
    return F.coalesce(F.concat(F.lit("s"), col), F.lit("n"))


def id_hash() -> Column:
    """The hash that orders documents: of doc_id, or of the text where that is null."""
    return F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), "text"), F.lit("")).cast("binary"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(skey, source_size, n_docs, turn, target) per source of rows (skey, source, size).

    Filling: while some source's share is above its cap, it gets its cap and leaves. Each round
    is one aggregate over the sources; shares only grow, so the rounds end when no source is
    capped anew, and there are no more rounds than sources.
    """
    sums = rows.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by_rank = ranked(sums, [F.col("source").isNull(), F.col("source")], "turn")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("turn") % len(weights) + 1).cast("int")).cast("long")
    sources = stored(by_rank.withColumn("weight", weight))
    wide = lambda col: col.cast("decimal(38,0)")
    over = lambda rest, shares: wide(F.lit(rest)) * wide(F.col("weight")) > wide(F.lit(shares)) * wide(cap * F.col("source_size"))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    capped, held = F.lit(False), -1
    while True:
        got = sources.agg(
            F.sum(F.when(capped, cap * F.col("source_size")).otherwise(0)).alias("given"),
            F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("shares"),
            F.sum(capped.cast("long")).alias("n"),
        ).first()
        rest, shares = total - (got.given or 0), got.shares or 0
        if got.n in (held, None) or not shares:
            break
        held, capped = got.n, over(rest, shares)
    share = F.col("weight") * F.lit(rest) / F.lit(max(shares, 1))
    target = F.when(capped, (cap * F.col("source_size")).cast("double")).otherwise(share.cast("double"))
    return sources.select("skey", "source_size", "n_docs", "turn", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, slopes: tuple[float, ...] = SLOPES) -> DataFrame:
    """`mix_rows` of docs (doc_id, source, text)."""
    file, row = fresh(docs, "_file", "_row")
    rows = numbered(docs, file, row)
    return mix_rows(rows.select(column(file).alias("_file"), column(row).alias("_row"), "doc_id", "source", "text"), weights, cap, slopes)


def mix_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, slopes: tuple[float, ...] = SLOPES) -> DataFrame:
    """Per row of docs (_file, _row, doc_id, source, text): size, source_size, target, taken, passes, place and position.

    taken is passes times size. place is the number of the source's words before the document
    in its fixed order; position is the training position, 0 to 1, of its first pass, null if
    it isn't taken. `positions` gives those of all passes.

    Rows alike in source, hash and size are one group in the running sums, so that repeated rows
    can't make a bucket large; their own places follow from their numbers in the group.
    """
    rows = stored(docs.select("_file", "_row", "doc_id", "source", source_key().alias("skey"), words_in().alias("size"), id_hash().alias("h")))
    sources = targets(rows, weights, cap)
    slope = F.element_at(F.array(*map(F.lit, slopes)), (F.col("turn") % len(slopes) + 1).cast("int"))
    # the upper 32 bits of the hash choose the bucket, in the hash's own order
    unit = F.conv(F.substring("h", 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    # One narrow row per source: broadcast while that is small by count; beyond it, a plain join.
    shared = stored(sources.withColumn("slope", slope))
    few = F.broadcast(shared) if shared.count() <= MAX_BROADCAST_SOURCES else shared
    alike = ["skey", "h", "size"]
    groups = rows.groupBy(*alike).agg(F.count("*").alias("copies")).join(few, "skey").withColumn("bucket", F.floor(unit * F.ceil(F.sqrt("n_docs"))))
    words = F.col("copies") * F.col("size")
    inside = Window.partitionBy("skey", "bucket").orderBy("h", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dealt = groups.withColumn("upto", F.sum(words).over(inside))
    buckets = groups.groupBy("skey", "bucket").agg(F.sum(words).alias("bucket_size"))
    before = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("skey", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("before"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    start = (F.col("before") + F.col("upto") - words).alias("start")
    placed = dealt.join(offsets, ["skey", "bucket"]).select(*alike, "copies", start, "source_size", "target", "slope", whole.alias("whole"))
    met = stored(rows.join(placed, alike))
    again = number_in_group(met.filter("copies > 1"), alike)
    found = met.filter("copies = 1").withColumn("number", F.lit(0).cast("long")).unionByName(again).withColumn("place", F.col("start") + F.col("number") * F.col("size"))
    left = F.col("target") - F.col("whole") * F.col("source_size")
    more = ((F.col("size") > 0) & (2 * F.col("place") + F.col("size") <= 2 * left)).cast("long")
    passes = F.when(F.col("size") > 0, F.col("whole") + more).otherwise(0)
    return (
        found.withColumn("passes", passes)
        .withColumn("taken", F.col("passes") * F.col("size"))
        .withColumn("position", F.when(F.col("passes") > 0, position(F.lit(0))))
        .select("_file", "_row", "doc_id", "source", "size", "source_size", "target", "taken", "passes", "place", "slope", "position")
    )


def number_in_group(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows with their number (from 0) among those of equal keys, by doc_id's place: counted in stretches of STRETCH rows of a file, so no task sees a whole group."""
    cut = rows.withColumn("_stretch", F.floor(F.col("_row") / STRETCH))
    inside = Window.partitionBy(*keys, "_file", "_stretch").orderBy("_row")
    counts = cut.groupBy(*keys, "_file", "_stretch").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_file", "_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_file", "_stretch", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    met = cut.withColumn("_in", F.row_number().over(inside) - 1).join(offsets, [*keys, "_file", "_stretch"])
    return met.withColumn("number", F.col("_before") + F.col("_in")).select(*rows.columns, "number")


def position(turn: Column) -> Column:
    """Training position of a document's pass `turn` (from 0).

    u is the share of the source's demand that comes before the pass. The weight over time is
    1 + slope (2 t - 1), its integral (1 - slope) t + slope t^2; the root of integral = u is
    the position.
    """
    u = F.least(F.lit(1.0), (turn * F.col("source_size") + F.col("place")) / F.col("target"))
    g = F.col("slope")
    root = (g - 1 + F.sqrt((1 - g) * (1 - g) + 4 * g * u)) / (2 * g)
    return F.when(F.abs(g) < 1e-9, u).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), root)))


def positions() -> Column:
    """Array of the training positions of all passes of a row of `mix`."""
    return F.when(F.col("passes") > 0, F.transform(F.sequence(F.lit(0), F.col("passes").cast("int") - 1), position)).otherwise(F.array().cast("array<double>"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "place", "position").orderBy("position", "doc_id")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document once for each pass that the mix takes of it, range-sorted by training position.

    Rows meet their positions by their place in the input, so repeated rows and ids stay apart;
    rows without words go, as the mix takes nothing of them. Very long texts are one row like any
    other. Columns other than doc_id, source and text may have any name.
    """
    file, row = fresh(docs, "_file", "_row")
    texts = numbered(docs, file, row)
    place = [column(file).alias("_file"), column(row).alias("_row")]
    at = mix_rows(texts.select(*place, "doc_id", "source", "text")).select(F.col("_file").alias("_f"), F.col("_row").alias("_r"), F.explode(positions()).alias("_position"))
    plain, back = guarded(docs, "doc_id")
    numbered_plain = texts.select(*place, *(column(c).alias(n) for c, n in zip(docs.columns, plain.columns, strict=True)))
    met = numbered_plain.join(at, (F.col("_file") == F.col("_f")) & (F.col("_row") == F.col("_r")))
    return back(met.repartitionByRange("_position", "doc_id").sortWithinPartitions("_position", "doc_id"))
