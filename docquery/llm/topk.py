"""Exact top-k inner products by three-phase uniform thresholds.

The dimensions are cut into `SLICES` slices; a slice of a block of vectors is a node that knows
partial scores only, as in "Efficient top-k query calculation in distributed networks" (Cao and
Wang, 2004). Vectors are integers, floor(256 x), so all scores are exact.

1. Every node lists its best partial scores for each query. The vectors on a block's lists are
   scored exactly, and the k-th best over all blocks is a safe cutoff t of the query.
2. The cutoffs go back to the nodes. A vector that reaches t has a partial score of t / SLICES at
   least in some slice, so each node names just the entries that reach that.
3. A vector's entries are added up; where a slice is missing, its score is known to be under the
   threshold, which discards most. What may still reach t is scored exactly, and ranked.

The nodes of one block lie in one task, so the entries of phase 2 (a fixed share of all pairs, where
scores are alike) are merged where they arise. Only what reaches the cutoff leaves the task, some k + 1
rows a query.

Equal vectors are folded into one class first, with the k + 1 smallest ids of each, so many copies
cost nothing and ties are cut by id, exactly; equal queries are one query until the end. Queries and
classes meet as blocks of rows (matrix products), never row by row. Blocks of vectors are dealt into
`GROUPS` groups at most, and queries go to each group once, so what is shuffled grows with the table
and not with its square; no set of queries or of vectors is ever broadcast or gathered whole. Stored
vectors are Parquet in the narrowest whole numbers that hold them all.

Defined results: vectors that are null, empty, or hold null or non-finite components take no
part, as queries or candidates; vectors of different lengths never score each other; a null id
takes no part. Rows that repeat an id are queries and candidates of their own; among candidates of
equal score and id either may come first. Fewer than k candidates give fewer rows. Other columns are
left aside, so their names don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docquery.llm.common import table, written

K = 5
SCALE = 256
SLICES = 2
#: Rows of a block of queries, and of vectors.
QUERY_ROWS, VECTOR_ROWS = 256, 8192
#: Groups of blocks of vectors, each of which gets all queries.
GROUPS = 64
SALTS = 32
#: Partial scores of which only the greatest is looked at, unless it is among the best.
RUN = 128


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, q) with q = floor(scale * x) as array of long, of usable rows only, repeated ones included."""
    x = F.transform(vector_col, lambda v: v.cast("double"))
    usable = F.size(vector_col) > 0
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.filter(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & usable & finite)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v * scale)).alias("q"))


def narrowed(rows: DataFrame) -> DataFrame:
    """rows (id, q) with q in the narrowest of short, int and long that holds all values."""
    low, high = rows.agg(F.min(F.array_min("q")), F.max(F.array_max("q"))).first()
    bits = max((x if x >= 0 else -x - 1).bit_length() for x in (low or 0, high or 0))
    kind = "smallint" if bits < 16 else "int" if bits < 32 else "bigint"
    return rows.withColumn("q", F.col("q").cast(f"array<{kind}>"))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(class_id, q, ids): the distinct vectors, numbered, each with its `keep` smallest ids, repeated ones included.

    A vector may have very many rows, so they are cut down in salted groups before they meet.
    """
    salted = rows.select("id", "q", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("_salt"))
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("id"))
    first = salted.withColumn("_n", place("q", "_salt")).filter(F.col("_n") <= keep).drop("_n", "_salt")
    last = first.withColumn("_n", place("q")).filter(F.col("_n") <= keep)
    lists = last.groupBy("q").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return written(lists.select(F.monotonically_increasing_id().alias("class_id"), "q", "ids"))


def blocks(rows: DataFrame, per_block: int) -> tuple[DataFrame, int]:
    """(dim, block, ids, matrix): rows (class_id, q, ids) packed into blocks of about per_block rows, dealt by hash, in the order of their least ids; and the number of blocks."""
    n = max(1, -(-rows.count() // per_block))
    dealt = rows.select(F.size("q").alias("dim"), F.pmod(F.xxhash64("class_id", F.lit(1)), F.lit(n)).cast("int").alias("block"), F.struct(F.element_at("ids", 1).alias("least"), "class_id", "q").alias("row"))
    packed = dealt.groupBy("dim", "block").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return written(packed.select("dim", "block", F.col("rows.class_id").alias("ids"), F.flatten("rows.q").alias("matrix"))), n


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of whole numbers, by floating point where that is exact."""
    most = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * a.shape[1]
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    return a.astype(kind) @ b.astype(kind).T


def best_places(part: np.ndarray, top: int) -> np.ndarray:
    """(rows, top) places of each row's greatest values: they lie in the runs with the greatest maxima, or in the rest behind the last whole run."""
    runs = part.shape[1] // RUN
    if runs <= top:
        return np.argpartition(-part, top - 1, axis=1)[:, :top]
    whole = part[:, : runs * RUN].reshape(len(part), runs, RUN)
    good = np.argpartition(-whole.max(axis=2), top - 1, axis=1)[:, :top]
    at = (good[:, :, None] * RUN + np.arange(RUN)).reshape(len(part), -1)
    at = np.concatenate([at, np.broadcast_to(np.arange(runs * RUN, part.shape[1]), (len(part), part.shape[1] - runs * RUN))], axis=1)
    return np.take_along_axis(at, np.argpartition(-np.take_along_axis(part, at, axis=1), top - 1, axis=1)[:, :top], axis=1)


def listed(parts: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Phase 1 for a block: (query, exact score) of the k best of the vectors on its nodes' lists."""
    top = min(k, parts[0].shape[1])
    at = np.sort(np.concatenate([best_places(p, top) for p in parts], axis=1), axis=1)
    score = sum(np.take_along_axis(p, at, axis=1).astype(np.int64) for p in parts)
    new = np.concatenate([np.ones((len(at), 1), bool), at[:, 1:] != at[:, :-1]], axis=1)  # a vector on several lists counts once
    order = np.lexsort((-score, ~new), axis=1)[:, :top]
    return np.repeat(np.arange(len(at)), top), np.take_along_axis(score, order, axis=1).ravel()


def reaching(parts: list[np.ndarray], t: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phases 2 and 3 for a block: (query, vector, exact score) of the vectors that reach the query's cutoff, its k first of them by score and place."""
    share = -(-t // SLICES)  # a part reaches t / SLICES if it reaches the next whole number
    named = [p >= share[:, None].astype(p.dtype) for p in parts]
    a, b = np.nonzero(np.logical_or.reduce(named))
    held = [m[a, b] for m in named]
    # a part that was not named is under t / SLICES
    known = sum(np.where(m, p[a, b], 0).astype(np.int64) for m, p in zip(held, parts, strict=True))
    missing = len(parts) - sum(m.astype(np.int64) for m in held)
    hopeful = known * SLICES + missing * t[a] >= t[a] * SLICES
    a, b = a[hopeful], b[hopeful]
    score = sum(p[a, b].astype(np.int64) for p in parts)
    reach = score >= t[a]
    a, b, score = a[reach], b[reach], score[reach]
    order = np.lexsort((b, -score, a))
    a, b, score = a[order], b[order], score[order]
    first = np.arange(len(a)) - np.searchsorted(a, a) < k
    return a[first], b[first], score[first]


def node_lists(pairs: DataFrame, k: int, cutoffs: bool) -> DataFrame:
    """What the nodes of each pair of blocks send: without cutoffs (query, score) of phase 1; with them (array column t, null for none) (query, class_id, score) of phase 3."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                q_ids, ids = np.asarray(row.q_ids, np.int64), np.asarray(row.ids, np.int64)
                q, v = np.asarray(row.q_matrix).reshape(len(q_ids), -1), np.asarray(row.matrix).reshape(len(ids), -1)
                cuts = [s * q.shape[1] // SLICES for s in range(SLICES + 1)]
                parts = [product(q[:, x:y], v[:, x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]
                if cutoffs:
                    t = np.array([-(2**62) if x is None or x != x else x for x in row.t], np.int64)
                    a, b, score = reaching(parts, t, k)
                    yield pd.DataFrame({"query": q_ids[a], "class_id": ids[b], "score": score})
                else:
                    a, score = listed(parts, k)
                    yield pd.DataFrame({"query": q_ids[a], "score": score})

    return pairs.mapInPandas(run, "query long, class_id long, score long" if cutoffs else "query long, score long")


def best_classes(classes: DataFrame, asked: DataFrame, wide: int) -> DataFrame:
    """(query, class_id, score): at least the `wide` best classes, by score and then least id, of every class that asked (class_id) names."""
    v, n = blocks(classes, VECTOR_ROWS)
    q, _ = blocks(classes.join(asked, "class_id", "left_semi"), QUERY_ROWS)
    groups = min(n, GROUPS)
    v = v.withColumn("group", F.col("block") % groups).select("dim", "group", "ids", "matrix")
    q = q.select("dim", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"))

    def met(left: DataFrame) -> DataFrame:
        """Every block of queries beside every block of vectors of its length: that is the query set's whole work."""
        return left.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).join(v, ["dim", "group"])

    down = Window.partitionBy("query").orderBy(F.desc("score"))
    scores = node_lists(met(q), wide, False).withColumn("_n", F.row_number().over(down))
    cutoff = written(scores.filter(F.col("_n") <= wide).filter(F.col("_n") == wide).select("query", F.col("score").alias("t")))
    held = q.select("dim", "q_block", F.posexplode("q_ids").alias("at", "query")).join(cutoff, "query", "left")
    told = held.groupBy("dim", "q_block").agg(F.sort_array(F.collect_list(F.struct("at", "t"))).alias("_t")).select("dim", "q_block", F.col("_t.t").alias("t"))
    return node_lists(met(q.join(told, ["dim", "q_block"])), wide, True)


def top_k(rows: DataFrame, asked: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that `asked` names its k best of the other rows, ties to the smaller id.

    rows: (id, q) as `quantised` makes them. A class that holds one of a query's k + 1 best vectors,
    itself among them, is among its k + 1 best classes, by score and then least id: each better class
    holds a better vector. The query itself is one of its class's rows of that id, so where the list
    of k + 1 holds one of these, it is taken out, and else the first k stay.
    """
    wide = k + 1
    rows = narrowed(rows)
    classes = distinct_vectors(rows, wide)
    named = written(rows.filter(asked).join(classes.select("class_id", "q"), "q").select(F.col("id").alias("query_id"), F.col("class_id").alias("query")))
    found = best_classes(classes, named.select(F.col("query").alias("class_id")).distinct(), wide).join(classes.select("class_id", "ids"), "class_id")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.element_at("ids", 1), "class_id")
    winners = found.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= wide)
    each = winners.select("query", "score", (F.col("class_id") == F.col("query")).alias("own"), F.explode("ids").alias("vec_id"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    lists = each.withColumn("_n", place).filter(F.col("_n") <= wide).groupBy("query").agg(F.sort_array(F.collect_list(F.struct("_n", "vec_id", "score", "own"))).alias("list"))
    itself = F.array_position(F.transform("list", lambda x: x["own"] & (x["vec_id"] == F.col("query_id"))), True)
    others = named.join(lists, "query").withColumn("_at", itself).select("query_id", F.slice(F.filter("list", lambda x, i: i + 1 != F.col("_at")), 1, k).alias("list"))
    out = others.select("query_id", F.posexplode("list").alias("_rank", "_row"))
    return out.select("query_id", (F.col("_rank") + 1).alias("rank"), F.col("_row.vec_id").alias("vec_id"), F.col("_row.score").alias("score"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantised(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id", "embedding")
    return top_k(rows, F.col("id") % 50 == 0)
