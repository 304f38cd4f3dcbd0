"""SimHash near-duplicate groups, with Golay-code keys for the candidate search.

Each whole text gets a 64-bit fingerprint of its 3-word shingles. Equal fingerprints are folded
into one row before anything is joined, so large groups of copies cost no pairs. Fingerprints
that differ in at most three bits are found through keys, and linked fingerprints are merged
into components by minimum labels in rounds of joins.

Keys. The fingerprint is cut into A (23 bits), B (23 bits) and C (18 bits). The binary Golay
code [23, 12, 7] is perfect: each 23-bit word has exactly one codeword within three bits. If
two words differ in at most one bit, the nearest codeword of the one is within four bits of the
other; there are one or six codewords within four bits. So the probing side carries its nearest
codeword, the indexed side all within four bits, and they meet. Three differing bits fall, by
the pigeonhole principle, into one of:

* none in C: A or B has at most one -> (C exact, Golay A), (C exact, Golay B);
* one in C, so a half of C is intact: A intact, or B intact, or one in each of A and B
  -> (A, half of C), (B, half of C), (Golay A, half of B, half of C);
* two or three in C: of A and B one is intact and the other has an intact half
  -> (A, half of B), (B, half of A).

Each key has 30 bits at least. Pairs that meet are verified on the fingerprints themselves.

Defined results: null and empty texts have fingerprint zero, which links like any other; rows
are kept one for one; component_id is the smallest doc_id reachable, and null only where all
doc_ids of the group are null. Very long texts are hashed whole, in blocks.

The pipeline's stage has another rule, sets of five-word shingles with a Jaccard similarity of 0.8.
Its first candidates are sets with equal or linked SimHash fingerprints, by the same Golay keys. Two
texts of similarity 0.8 differ in 9.7 of 64 SimHash bits on average (64 acos(8/9) / pi), far beyond
what these reach, so it finds the rest by bands of minima, their pairs by stars and an exact prefix
join. All pairs are checked on the sets themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.llm.common import MAX_BROADCAST, column, columns, fresh, numbered, small_side, stored, table

SHINGLE = 3
SEED = 42
RADIUS = 3
#: The pipeline's stage: words of a shingle, and the Jaccard similarity of shingle sets that makes near copies.
STAGE_SHINGLE, SIMILAR = 5, 0.8
#: Bands of minima that find its pairs: one of similarity 0.8 shares none with a chance of (1 - 0.8 ** ROWS) ** BANDS, 0.0017.
BANDS, ROWS = 16, 5
#: The low bits of a band's key that hold its number.
BAND_BITS = 31
#: Bits that tell unlike sets apart before they are compared.
PARITIES = 256
#: Texts whose sets of shingles a task holds at once.
SLICE = 64
#: Fixed value: the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 of the Golay code.
GENERATOR = 0b101011100011


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """64-bit hashes of the word shingles (repeats included) of one whole text; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)], dtype="<u8")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles (repeats included) of one whole text, as an unsigned int."""
    return simhash_of(shingle_hashes(text, shingle))


def simhash_of(hashes: np.ndarray) -> int:
    """64-bit SimHash of hashes; zero if there are none."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, name: str = "fingerprint") -> DataFrame:
    """docs with the fingerprint as a signed long."""

    @F.pandas_udf(T.LongType())
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn(name, hashed("text"))


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial."""
    left = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        left ^= np.where(left >> bit & 1, GENERATOR << (bit - 11), 0)
    return left


@cache
def error_patterns() -> np.ndarray:
    """(2048, 6) all errors of up to four bits with a given syndrome: the one of up to three first, -1 where there are none.

    A syndrome whose least error has three bits has five more errors of four bits; any other
    has none.
    """
    bits = np.arange(23)
    pairs = [(1 << a) | (1 << b) for a in bits for b in bits[:a]]
    small = [0, *(1 << bits).tolist(), *pairs, *((1 << c) | p for p in pairs for c in bits if p < 1 << c)]
    four = np.unique([p | q for p in pairs for q in pairs if not p & q and p < q])
    out = np.full((2048, 6), -1, np.int64)
    small = np.array(small)
    out[syndrome(small), 0] = small
    at = syndrome(four)
    order = np.argsort(at, kind="stable")
    four, at = four[order], at[order]
    slot = 1 + np.arange(len(at)) - np.searchsorted(at, at)
    out[at, slot] = four
    return out


def codewords(words: np.ndarray) -> np.ndarray:
    """(n, 6) indices (upper 12 bits) of the codewords within four bits of each 23-bit word, the nearest first; -1 fills."""
    errors = error_patterns()[syndrome(words)]
    return np.where(errors >= 0, (words[:, None] ^ errors) >> 11, -1)


def keys(prints: np.ndarray, indexed: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row number, key) of every key of the given fingerprints (uint64).

    The kind of a key is in its upper bits. indexed: with all codewords within four bits, else
    with the nearest alone.
    """
    prints = prints.astype(np.uint64)
    a = (prints >> np.uint64(41)).astype(np.int64)
    b = (prints >> np.uint64(18)).astype(np.int64) & 0x7FFFFF
    c = prints.astype(np.int64) & 0x3FFFF
    half = lambda x, low: (x & ((1 << low) - 1), x >> low)
    (a0, a1), (b0, b1), (c0, c1) = half(a, 12), half(b, 12), half(c, 9)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    everyone = np.arange(len(prints))

    def add(kind: int, row: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        out.append((row, (np.int64(kind) << 48) | (first << 24) | second))

    for kind, (first, second) in enumerate([(a, c0), (a, c1), (b, c0), (b, c1), (a, b0), (a, b1), (b, a0), (b, a1)]):
        add(kind, everyone, first, second)
    near = {"a": codewords(a), "b": codewords(b)}
    for name in near:
        near[name] = near[name] if indexed else near[name][:, :1]
    for kind, (name, second) in enumerate(
        [("a", c), ("b", c), *(("a", h << 10 | g) for h, g in ((b0, c0), (b0, c1), (b1, c0), (b1, c1)))], 8
    ):
        row, at = np.nonzero(near[name] >= 0)
        add(kind, row, near[name][row, at], second[row])
    return np.concatenate([r for r, _ in out]), np.concatenate([k for _, k in out])


def keyed(prints: DataFrame, indexed: bool) -> DataFrame:
    """(key, fp) rows of prints (fp)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy(np.int64)
            row, key = keys(fp.view(np.uint64), indexed)
            yield pd.DataFrame({"key": key, "fp": fp[row]})

    return prints.select("fp").mapInPandas(run, "key long, fp long")


def links(prints: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a < b, of the distinct fingerprints in prints (fp) at RADIUS or fewer bits."""
    probe = keyed(prints, False).withColumnRenamed("fp", "a")
    index = keyed(prints, True).withColumnRenamed("fp", "b")
    met = probe.join(index, (probe.key == index.key) & (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS))
    return met.select("a", "b").distinct()


def components(edges: DataFrame, most: int = MAX_BROADCAST) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node reachable. A frame of `most` rows or fewer, to be broadcast.

    Rounds of two steps on star-shaped edges: all larger neighbours of a node are hung on its
    least neighbour, then the smaller ones. The number of edges never grows and the rounds
    needed grow with the logarithm of the longest chain. Every round is written to the
    checkpoint folder. Each begins with the least neighbour of every node; where all edges are
    stars around their smallest node, these are the roots. Edges are shuffled for every join
    only if there are more than `most` nodes.
    """
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    few = None
    while True:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(edges.select(F.col("b").alias("node"), F.col("a").alias("near")))
        low, down, up = F.least(F.min("near"), F.col("node")).alias("low"), F.count_if(F.col("near") < F.col("node")).alias("down"), F.count_if(F.col("near") > F.col("node")).alias("up")
        nodes = stored(both.groupBy("node").agg(low, down, up))
        few = small_side(nodes, most) is not None if few is None else few  # later rounds have no other nodes
        side = F.broadcast if few else lambda df: df
        if nodes.filter("down > 1 or down = 1 and up > 0").isEmpty():
            return side(nodes.select("node", F.col("low").alias("root")))
        hung = edges.join(side(nodes.select(F.col("node").alias("a"), "low")), "a").select(F.col("low").alias("a"), "b")
        least = hung.groupBy("b").agg(F.min("a").alias("low"))
        pair = lambda x: F.struct(F.col("low").alias("a"), F.col(x).alias("b"))
        moved = hung.join(side(least), "b").select(F.explode(F.array(pair("a"), pair("b"))).alias("pair"))
        edges = stored(moved.select("pair.*").filter("a < b").distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint long, component_id) for every row of docs (doc_id, text).

    The rows are dealt only by their fingerprint, after copies have been counted as one; the
    joins back are plain inner joins on narrow rows, which adaptive execution can split.
    """
    rows = stored(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", F.col("fingerprint").alias("fp")))
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low_id")))
    root = components(links(prints)).withColumnRenamed("node", "fp")
    grouped = prints.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lows = grouped.groupBy("root").agg(F.min("low_id").alias("component_id"))
    named = grouped.join(lows, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@cache
def mixers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    draw = lambda: rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
    return draw(), draw() << np.uint64(1) | np.uint64(1)


def bands_of(shingles: np.ndarray) -> np.ndarray:
    """One key (int64) per band of a set of shingle hashes: the hash of the band's minima under as many mixings, the band in its low bits."""
    add, times = mixers()
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 4096):
        mixed = (shingles[i : i + 4096, None] ^ add) * times
        low = np.minimum(low, (mixed ^ (mixed >> np.uint64(32))).min(axis=0))
    hashes = [xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(low.reshape(BANDS, ROWS))]
    return np.array([h & ~BAND_BITS | k for k, h in enumerate(hashes)], np.uint64).view(np.int64)


def set_id(shingles: np.ndarray) -> int:
    """Id of a set of sorted hashes, signed; 0 for the empty set."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), SEED)).view(np.int64)) if len(shingles) else 0


def by_slices(rows: DataFrame, make: Callable[[list[np.ndarray], list[str | None]], dict[str, pa.Array]], schema: T.StructType, shingle: int) -> DataFrame:
    """The columns of rows but text, and those that make returns for the shingle sets of a few texts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = part.column("text").to_pylist()
                sets = [np.unique(shingle_hashes(t, shingle)) for t in texts]
                yield pa.record_batch({n: part.column(n) for n in part.schema.names if n != "text"} | make(sets, texts))

    return rows.mapInArrow(run, schema)


def as_lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    flat = np.concatenate([np.zeros(0, np.int64), *values])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)], dtype=np.int32)), pa.array(flat, kind))


def sketches(rows: DataFrame, shingle: int) -> DataFrame:
    """rows with fp (the id of the text's set of shingles), print (that set's SimHash), blank (a hash of a text without words) and bands instead of text."""

    def make(sets: list[np.ndarray], texts: list[str | None]) -> dict[str, pa.Array]:
        bands = [bands_of(x) if len(x) else np.zeros(0, np.int64) for x in sets]
        blank = [None if len(x) else -1 if t is None else xxhash.xxh64_intdigest(t.encode()) >> 1 for x, t in zip(sets, texts, strict=True)]
        prints = np.array([simhash_of(x) for x in sets], np.uint64).view(np.int64)
        return {"fp": pa.array([set_id(x) for x in sets], pa.int64()), "print": pa.array(prints, pa.int64()), "blank": pa.array(blank, pa.int64()), "bands": as_lists(bands, pa.int64())}

    kept = [f for f in rows.schema if f.name != "text"]
    return by_slices(rows, make, T.StructType([*kept, *T.StructType.fromDDL("fp long, print long, blank long, bands array<long>")]), shingle)


def similar(pairs: DataFrame, members: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sets, members (fp, n, shingles), have a Jaccard similarity of `least` or more, exactly.

    Sizes alone rule out most of the rest before any set is moved.
    """
    sizes = members.select("fp", "n")
    hopeful = pairs.join(sizes.select(F.col("fp").alias("a"), F.col("n").alias("_n")), "a").join(sizes.select(F.col("fp").alias("b"), F.col("n").alias("_m")), "b")
    hopeful = hopeful.filter(F.least("_n", "_m") >= least * F.greatest("_n", "_m") - 1e-6)
    both = hopeful.join(members.select(F.col("fp").alias("b"), F.col("shingles").alias("_b")), "b").join(members.select(F.col("fp").alias("a"), F.col("shingles").alias("_a")), "a")
    common = F.size(F.array_intersect("_a", "_b"))
    return both.filter((1 + least) * common >= least * (F.col("_n") + F.col("_m")) - 1e-6).select("a", "b")


def parities(shingles: np.ndarray) -> np.ndarray:
    """PARITIES bits (as longs): of each, whether an odd number of the shingles fall on it. Two sets differ in at least as many shingles as bits."""
    odd = np.bincount((shingles % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def star_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): each set b of shared (key, fp, n) beside the most central other set a that it shares a bucket with.

    A set is the more central the more sets its buckets hold, so that copies with changes of
    their own meet the text that they were made from.
    """
    scores = shared.groupBy("fp").agg(F.sum("n").alias("score"))
    scored = shared.join(scores, "fp")
    two = F.slice(F.sort_array(F.collect_set("top"), asc=False), 1, 2)
    # two heads a bucket, as a head needs another; each is the best of many partial maxima
    first = scored.groupBy("key").agg(F.max(F.struct("score", "fp")).alias("top"))
    others = scored.join(first, "key").filter(F.col("fp") != F.col("top.fp")).groupBy("key").agg(F.max(F.struct("score", "fp")).alias("top"))
    heads = first.union(others).groupBy("key").agg(two.alias("tops"))
    met = shared.join(heads, "key").select("fp", F.explode("tops").alias("top")).filter(F.col("top.fp") != F.col("fp"))
    return met.groupBy(F.col("fp").alias("b")).agg(F.max("top").alias("top")).select(F.col("top.fp").alias("a"), "b")


def prefix_pairs(members: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """(a, b), a < b: pairs of sets of unlike roots that may reach the similarity, by an exact prefix join.

    Shingles are ordered by how many of the sets hold them, rarest first. Sets that reach it share
    one of the first n - ceil(least n) + 1 of each, and the first that they share is early enough
    in both to leave room for the overlap they need. A copy's own changes are its rarest shingles, so
    unlike copies of one text seldom meet; most that do have too many unlike parity bits. members:
    (fp, n, bits, shingles); roots: (fp, root).
    """
    single = members.join(roots, "fp").select("fp", "n", "root", F.explode("shingles").alias("shingle"))
    counts = single.groupBy("shingle").agg(F.count("*").alias("sets"), F.min("root").alias("low"), F.max("root").alias("high"))
    useful = (F.col("low") != F.col("high")).alias("useful")
    listed = single.join(counts.select("shingle", "sets", useful), "shingle").groupBy("fp", "n", "root").agg(F.sort_array(F.collect_list(F.struct("sets", "shingle", "useful"))).alias("all"))
    width = F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-6).cast("int") + 1
    prefix = listed.select("fp", "n", "root", F.posexplode(F.slice("all", F.lit(1), width)).alias("at", "one")).filter("one.useful")
    prefix = stored(prefix.select("fp", "n", "root", "at", F.col("one.shingle").alias("shingle")).join(members.select("fp", "bits"), "fp"))
    a = prefix.select("shingle", F.col("fp").alias("a"), F.col("n").alias("_n"), F.col("root").alias("_r"), F.col("at").alias("_i"), F.col("bits").alias("_p"))
    b = prefix.select("shingle", F.col("fp").alias("b"), F.col("n").alias("_m"), F.col("root").alias("_s"), F.col("at").alias("_j"), F.col("bits").alias("_q"))
    needed = least / (1 + least) * (F.col("_n") + F.col("_m")) - 1e-6
    room = F.least(F.col("_n") - F.col("_i"), F.col("_m") - F.col("_j"))
    sizes = F.least("_n", "_m") >= least * F.greatest("_n", "_m") - 1e-6
    unlike = sum(F.bit_count(F.col("_p")[k].bitwiseXOR(F.col("_q")[k])) for k in range(PARITIES // 64))
    hopeful = (F.col("a") < F.col("b")) & (F.col("_r") != F.col("_s")) & sizes & (room >= needed) & (unlike <= F.col("_n") + F.col("_m") - 2 * needed)
    return a.join(b, ["shingle"]).filter(hopeful).select("a", "b").distinct()


def simhash_pairs(sets: DataFrame) -> DataFrame:
    """(a, b): sets (fp, print) whose fingerprints are equal or linked. Of sets of one fingerprint the least stands for the others, and each meets it."""
    heads = stored(sets.groupBy("print").agg(F.min("fp").alias("head")))
    same = sets.join(heads, "print").filter("fp != head").select(F.col("head").alias("a"), F.col("fp").alias("b"))
    head = lambda side: heads.select(F.col("print").alias(side), F.col("head").alias(f"_{side}"))
    near = links(heads.select(F.col("print").alias("fp"))).join(head("a"), "a").join(head("b"), "b")
    return stored(same.union(near.select(F.col("_a").alias("a"), F.col("_b").alias("b"))))


def similar_groups(
    rows: DataFrame, texts: DataFrame, at: list[str], shingle: int = STAGE_SHINGLE, least: float = SIMILAR, most: int = MAX_BROADCAST
) -> DataFrame:
    """(fp, root) of every set of shingles in rows that isn't alone: the components of pairs of `least` similarity or more.

    rows: what `sketches` makes, stored; texts: the same rows with their texts; at: the columns
    that name a row in both. Equal sets are one from the start. Sets with fingerprints within RADIUS
    bits are candidates, and so are sets that share a band. Each of these is held against the most central of its buckets, which makes one component
    of most groups of near copies; what is in a bucket with other components then meets by prefixes.
    All pairs are checked exactly.
    """
    keyed = rows.filter("fp != 0").select("fp", "bands").dropDuplicates(["fp"]).select("fp", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = stored(keyed.join(buckets, "key"))
    printed = simhash_pairs(rows.filter("fp != 0").select("fp", "print").dropDuplicates(["fp"]))
    wanted = shared.select("fp").union(printed.select("a")).union(printed.select("b")).distinct()
    one = stored(rows.join(wanted, "fp", "left_semi").groupBy("fp").agg(F.min(F.struct(*at)).alias("_one")).select("fp", "_one.*"))
    met = texts.join(small_side(one, most) or one, at).select("fp", "text")

    def make(sets: list[np.ndarray], _) -> dict[str, pa.Array]:
        n = pa.array([len(x) for x in sets], pa.int32())
        return {"n": n, "bits": as_lists([parities(x) for x in sets], pa.int64()), "shingles": as_lists([x.view(np.int64) for x in sets], pa.int64())}

    members = stored(by_slices(met, make, T.StructType.fromDDL("fp long, n int, bits array<long>, shingles array<long>"), shingle))
    first = similar(printed.union(star_pairs(shared)).distinct(), members, least)
    known = components(first, most).withColumnRenamed("node", "fp")
    placed = stored(shared.select("key", "fp").join(known, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("key")
    roots = stored(placed.join(mixed, "key", "left_semi").select("fp", "root").distinct())
    rest = prefix_pairs(members, small_side(roots, most) or roots, least)
    return components(known.select("root", "fp").toDF("a", "b").union(similar(rest, members, least)), most).withColumnRenamed("node", "fp")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str, most: int = MAX_BROADCAST) -> DataFrame:
    """Pipeline stage: of each component of near copies the row with the smallest doc_id stays, unchanged.

    Near copies have sets of five-word shingles with a Jaccard similarity of 0.8 or more; all
    texts without words (null, empty, white space) are copies of each other, but of rows with
    neither words nor doc_id one stays for each text. Rows are told apart by their place, not by
    doc_id: of rows that repeat the smallest doc_id one stays, a null doc_id comes last, and unlike
    texts under one doc_id are rows of their own. Very long texts are
    held a few at a time. Other columns may have any name.
    """
    file, row = fresh(docs, "_file", "_row")
    texts = numbered(docs, file, row)
    narrow = texts.select(column(file).alias("_file"), column(row).alias("_row"), column("doc_id").alias("doc_id"), column("text").alias("text"))
    rows = stored(sketches(narrow, STAGE_SHINGLE))
    groups = similar_groups(rows, narrow.drop("doc_id"), ["_file", "_row"], most=most)
    alone = F.when(F.col("doc_id").isNull(), F.col("blank")).alias("alone")
    rooted = rows.select("_file", "_row", "doc_id", "fp", alone).join(groups, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_file", "_row")).alias("first")
    kept = rooted.groupBy("root", "alone").agg(first).select(F.col("first._file").alias("_f"), F.col("first._row").alias("_r"))
    same = (column(file) == F.col("_f")) & (column(row) == F.col("_r"))
    gone = stored(rows.select(F.col("_file").alias("_f"), F.col("_row").alias("_r")).join(kept, ["_f", "_r"], "left_anti"))
    few = small_side(gone, most)
    left = texts.join(kept, same, "left_semi") if few is None else texts.join(few, same, "left_anti")
    return left.select(*columns(docs))
