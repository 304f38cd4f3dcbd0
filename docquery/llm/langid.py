"""Language identification by interpolated Kneser-Ney character models.

One pass over all training texts counts packed 4-grams of lower-case letters (anything else is
one space); Spark adds the counts up and takes all of Kneser-Ney's statistics from the full counts:
continuation counts, discounts, totals and back-off weights. Only 4-grams that were seen once are
then left out, their mass going to the order below. The models of all languages (or of as many as
fit a bounded array, in more passes) are laid out as one sorted array of 64-bit hashes per order,
with a row of log probabilities (a column per language) for each hash. A text is scored by hashing all
its positions at once and looking each up in the highest order that has it, with the back-off
weights of the contexts passed; the language with the lowest cross-entropy per character wins.

Defined results: a text that is null, or has no letter, is `und` with score 0 and not accepted;
so is every text if nothing could be learned. Equal cross-entropies go to the language that is
first in code-point order. Repeated rows are scored alike; all rows are kept. Very long texts are
scored whole, in blocks, and texts leave their Arrow batch one at a time; doc_id may be of any type,
and other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.llm.common import fold, fresh, stored, table, written
from docquery.llm.gbt import Isotonic, fit_isotonic

ORDER = 4
#: 4-grams seen less often are left out once all statistics are taken.
LEAST_COUNT = 2
#: Bound of the array cells (4-grams times languages, 4 bytes each) that a task holds at once; more languages are scored in more passes.
MAX_CELLS = 1 << 24
#: The calibration counts all rows by evidence to so many binary digits, and by cross-entropy in steps of one in GRID nats.
DIGITS, GRID = 10, 4096
#: Characters that are packed and looked up at once, and 4-grams that are counted at once.
BLOCK, COUNTED = 1 << 16, 1 << 18
SPACE = 32


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000)


def body_codes(low: str, inside: bool) -> tuple[np.ndarray, bool]:
    """Letter codes of a stretch of lower-case text, and whether it ends inside a word; `inside` says so of what lies before it."""
    raw = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[np.minimum(raw, 0xFFFF)]
    if (high := raw > 0xFFFF).any():
        kinds, at = np.unique(raw[high], return_inverse=True)
        letter[high] = np.array([chr(c).isalpha() for c in kinds])[at]
        raw = np.where(high, (raw & 0xFFFF) | 0xE000, raw)
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[:1] |= inside
    return np.where(letter, raw, SPACE)[kept].astype(np.uint64), bool(letter[-1]) if len(letter) else inside


def codes(text: str | None) -> np.ndarray:
    """The text as 16-bit letter codes with single spaces between words and three before the first.

    Letters above U+FFFF are folded into 16 bits. Empty if the text has no letter.
    """
    body, _ = body_codes((text or "").lower(), False)
    return np.concatenate([np.full(ORDER - 1, SPACE, np.uint64), body]) if len(body) else body


def grams(code: np.ndarray) -> np.ndarray:
    """Packed 4-grams, one for each code that has three before it."""
    return code[:-3] << np.uint64(48) | code[1:-2] << np.uint64(32) | code[2:-1] << np.uint64(16) | code[3:]


def packed(text: str | None) -> Iterator[np.ndarray]:
    """The grams of a whole text, BLOCK characters at a time; none if it has no letter."""
    low = (text or "").lower()
    before, inside = np.full(ORDER - 1, SPACE, np.uint64), False
    for i in range(0, len(low), BLOCK):
        body, inside = body_codes(low[i : i + BLOCK], inside)
        if len(body):
            code = np.concatenate([before, body])
            before = code[1 - ORDER :]
            yield grams(code)


def mixed(key: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix, so that the hash arrays are evenly filled."""
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return key ^ (key >> np.uint64(29))


def suffix(key: np.ndarray, order: int) -> np.ndarray:
    return key & np.uint64((1 << 16 * order) - 1) if order < 4 else key


class Hashed:
    """A sorted array of hashes with a directory over their top bits."""

    def __init__(self, keys: np.ndarray):
        hashes = mixed(keys)
        self.order = np.argsort(hashes)
        self.hashes = np.append(hashes[self.order], np.uint64(0))
        self.bits = max(1, int(np.ceil(np.log2(len(keys) + 1))) + 1)
        self.start = np.searchsorted(hashes[self.order] >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1).astype(np.uint64)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's place in the sorted array, -1 if it isn't there."""
        hashes = mixed(keys)
        top = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.start[top], self.start[top + 1]
        found = np.where((self.hashes[at] == hashes) & (at < end), at, -1)
        left = np.flatnonzero((found < 0) & (at + 1 < end))
        at, end, hashes = at[left] + 1, end[left], hashes[left]
        while len(left):
            hit = self.hashes[at] == hashes
            found[left[hit]] = at[hit]
            more = ~hit & (at + 1 < end)
            left, at, end, hashes = left[more], at[more] + 1, end[more], hashes[more]
        return found


@dataclass
class LanguageModel:
    languages: list[str]
    grams: list[Hashed]  # by order, 1 first
    logp: list[np.ndarray]
    contexts: list[Hashed | None]
    backoff: list[np.ndarray | None]
    unseen: float

    def position_scores(self, keys: np.ndarray) -> np.ndarray:
        """Log probability of each position under each language."""
        out = np.zeros((len(keys), len(self.languages)), np.float32)
        left = np.arange(len(keys))
        for order in range(ORDER, 0, -1):
            sub = suffix(keys[left], order)
            at = self.grams[order - 1].find(sub)
            hit = at >= 0
            out[left[hit]] += self.logp[order - 1][at[hit]]
            left, sub = left[~hit], sub[~hit]
            if order == 1 or not len(left):
                break
            context = self.contexts[order - 1].find(sub >> np.uint64(16))
            seen = context >= 0
            out[left[seen]] += self.backoff[order - 1][context[seen]]
        out[left] += np.float32(self.unseen)
        return out

    def cross_entropy(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages) nats per character, and the number of scored characters."""
        total, n = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        pending: list[tuple[int, np.ndarray]] = []
        waiting = 0

        def flush() -> None:
            nonlocal waiting
            if pending:
                scores = self.position_scores(np.concatenate([g for _, g in pending]))
                starts = np.cumsum([0, *(len(g) for _, g in pending[:-1])])
                np.add.at(total, [k for k, _ in pending], np.add.reduceat(scores, starts, axis=0, dtype=np.float64))
                pending.clear()
                waiting = 0

        for k, text in enumerate(texts):
            for part in packed(text.as_py() if isinstance(text, pa.Scalar) else text):
                n[k] += len(part)
                pending.append((k, part))
                waiting += len(part)
                if waiting >= BLOCK:
                    flush()
        flush()
        return -total / np.maximum(n, 1)[:, None], n


def evidence(entropy: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How far the best language is ahead of the next: the gap per character by the root of the length."""
    if entropy.shape[1] < 2:
        return np.sqrt(n)
    two = np.partition(entropy, 1, axis=1)
    return (two[:, 1] - two[:, 0]) * np.sqrt(n)


def judgements(languages: list[str], calibration: Isotonic | None, limit: dict[str, float] | None, entropy: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """lang, score (calibrated chance that lang is right), accepted, cross_entropy."""
    names = np.array(languages, dtype=object)
    best = entropy.argmin(axis=1)
    low = entropy[np.arange(len(best)), best]
    score = calibration(evidence(entropy, n)) if calibration else np.full(len(best), 0.5)
    limits = np.array([(limit or {}).get(lang, np.inf) for lang in languages])[best]
    none = n == 0
    return {
        "lang": np.where(none, "und", names[best]),
        "score": np.where(none, 0.0, np.clip(score, 0, 1)),
        "accepted": ~none & (low <= limits) & (score >= 0.5),
        "cross_entropy": np.where(none, np.nan, low),
    }


def as_struct(found: dict[str, np.ndarray]) -> pa.StructArray:
    """The columns of `judgements` as Arrow, NaN as null."""
    kinds = {"lang": pa.string(), "score": pa.float64(), "accepted": pa.bool_(), "cross_entropy": pa.float64()}
    return pa.StructArray.from_arrays([pa.array(found[c], kind, from_pandas=True) for c, kind in kinds.items()], list(kinds))


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n, early) over all whole texts of docs (text, lang, fold): all places, and those outside fold 1."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[tuple[str, bool], list[int]] = {}
            for k, (lang, number) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("fold").to_pylist(), strict=True)):
                rows.setdefault((lang, number == 1), []).append(k)
            texts = batch.column("text")
            for (lang, first), own in rows.items():
                waiting: list[np.ndarray] = []
                size = 0
                for part in chain(chain.from_iterable(packed(texts[k].as_py()) for k in own), [None]):
                    if part is not None:
                        waiting.append(part)
                        size += len(part)
                    if waiting and (size >= COUNTED or part is None):
                        gram, n = np.unique(np.concatenate(waiting), return_counts=True)
                        columns = [pa.repeat(pa.scalar(lang, pa.string()), len(n)), pa.array(gram.view(np.int64)), pa.array(n), pa.array(0 * n if first else n)]
                        yield pa.record_batch(columns, ["lang", "gram", "n", "early"])
                        waiting, size = [], 0

    found = docs.select("lang", "text", "fold").mapInArrow(counted, "lang string, gram long, n long, early long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("early").alias("early"))


def gram_tables(counts: DataFrame, least: int = LEAST_COUNT) -> tuple[list[DataFrame], list[DataFrame | None]]:
    """Kneser-Ney's parts by order from 1, from all grams of counts (lang, gram, n): (lang, gram, own) and (lang, context, weight).

    The highest order uses counts; a lower order counts in how many distinct longer grams its
    gram ends. Each order's discount is n1 / (n1 + 2 n2) of its own counts, over all its grams. own
    is (count - discount) / total of the context, weight what the context leaves to the order below.
    Only then are grams of the highest order with a count under `least` left out; what they held
    goes to their context's weight, so probabilities still sum to one. Nothing is bounded: what is
    kept grows with the texts.
    """
    tables, contexts = [], []
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            below = F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1)).alias("gram")
            counts = counts.select("lang", below).groupBy("lang", "gram").agg(F.count("*").alias("n"))
        counts = stored(counts)
        once, twice = (F.sum((F.col("n") == k).cast("long")) for k in (1, 2))
        discount = F.when((once > 0) & (twice > 0), once / (once + 2 * twice)).otherwise(0.75).alias("discount")
        by_lang = counts.groupBy("lang").agg(discount)  # one row a language
        context = F.shiftrightunsigned("gram", 16).alias("context") if order > 1 else F.lit(0).cast("long").alias("context")
        rows = counts.join(F.broadcast(by_lang), "lang").select("lang", "gram", context, "n", "discount")
        keep = F.col("n") >= (least if order == ORDER else 1)
        mass = F.sum(F.when(keep, F.greatest(F.col("n") - F.col("discount"), F.lit(0.0))).otherwise(0.0))
        heads = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), (1 - mass / F.sum("n")).alias("weight"), F.max(keep).alias("kept"))
        own = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")
        tables.insert(0, rows.filter(keep).join(heads, ["lang", "context"]).select("lang", "gram", own.alias("own")))
        contexts.insert(0, heads.filter("kept").select("lang", "context", "weight"))
    return tables, contexts


def build_model(languages: list[str], tables: list[pd.DataFrame], contexts: list[pd.DataFrame]) -> LanguageModel:
    """The models of some languages as sorted hash arrays, from the rows of `gram_tables`."""
    place = {lang: k for k, lang in enumerate(languages)}
    unsigned = lambda values: values.to_numpy(np.int64).view(np.uint64)
    unions = [np.unique(unsigned(t["gram"])) for t in tables]
    wide = max(1, len(unions[0]))
    grams_, logp, held_, backoff = [], [], [], []
    below = None
    for order, (rows, heads, union) in enumerate(zip(tables, contexts, unions, strict=True), 1):
        above = np.unique(union >> np.uint64(16)) if order > 1 else np.zeros(1, np.uint64)
        own = np.searchsorted(above, union >> np.uint64(16)) if order > 1 else np.zeros(len(union), np.int64)
        weight = np.ones((len(above), len(languages)))
        weight[np.searchsorted(above, unsigned(heads["context"])), heads["lang"].map(place).to_numpy(int)] = heads["weight"].to_numpy(float)
        p = np.zeros((len(union), len(languages)))
        p[np.searchsorted(union, unsigned(rows["gram"])), rows["lang"].map(place).to_numpy(int)] = rows["own"].to_numpy(float)
        p += weight[own] * (below[np.searchsorted(unions[order - 2], suffix(union, order - 1))] if order > 1 else 1.0 / (4 * wide))
        below = p
        table_ = Hashed(union)
        grams_.append(table_)
        logp.append(np.log(p[table_.order]).astype(np.float32))
        held = Hashed(above) if order > 1 else None
        held_.append(held)
        backoff.append(np.log(weight[held.order]).astype(np.float32) if held else None)
    return LanguageModel(languages, grams_, logp, held_, backoff, float(np.log(1.0 / (8 * wide))))


def language_parts(sizes: dict[str, int], most_cells: int) -> list[list[str]]:
    """Languages in groups whose arrays, rows times languages, stay within most_cells; a language that is beyond it alone is a group of its own."""
    parts: list[list[str]] = []
    rows = 0
    for lang in sorted(sizes):
        if parts and (rows + sizes[lang]) * (len(parts[-1]) + 1) <= most_cells:
            parts[-1].append(lang)
            rows += sizes[lang]
        else:
            parts.append([lang])
            rows = sizes[lang]
    return parts


def entropy_of(shipped: Broadcast):
    """The cross-entropies of a column of texts under a part of the models."""

    @F.arrow_udf("entropy array<double>, n long")
    def measured(texts: pa.Array) -> pa.Array:
        entropy, n = shipped.value.cross_entropy(texts)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * entropy.shape[1]), pa.array(entropy.ravel()))
        return pa.StructArray.from_arrays([lists, pa.array(n)], ["entropy", "n"])

    return measured


@dataclass
class Identifier:
    """Language models in parts of bounded size, each shipped by itself, and what was calibrated over all of them."""

    counts: DataFrame  # lang, gram, n
    parts: list[list[str]]
    tables: tuple[list[DataFrame], list[DataFrame | None]]
    calibration: Isotonic | None = None
    limit: dict[str, float] | None = None

    @property
    def languages(self) -> list[str]:
        return [lang for part in self.parts for lang in part]

    def part(self, languages: list[str]) -> LanguageModel:
        rows = lambda df: df.filter(F.col("lang").isin(languages)).toPandas()  # noqa: E731  at most the cells of a part
        return build_model(languages, *([rows(df) for df in side] for side in self.tables))

    def entropies(self, docs: DataFrame, name: str) -> DataFrame:
        """docs with a struct column: entropy (nats per character under each of self.languages) and n (characters).

        One part is one pass. With more, the table is written after each, so that a task never
        holds two parts.
        """
        out, columns_ = docs, []
        for k, languages in enumerate(self.parts):
            shipped = docs.sparkSession.sparkContext.broadcast(self.part(languages))
            columns_.append(f"{name}_{k}")
            out = out.withColumn(columns_[-1], entropy_of(shipped)("text"))
            out = stored(out) if len(self.parts) > 1 else out
        both = F.struct(F.concat(*(F.col(c)["entropy"] for c in columns_)).alias("entropy"), F.col(columns_[0])["n"].alias("n"))
        return out.withColumn(name, both).drop(*columns_)

    def judge(self, entropy: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
        return judgements(self.languages, self.calibration, self.limit, entropy, n)


def calibrated(judged: DataFrame, languages: list[str]) -> tuple[Isotonic | None, dict[str, float]]:
    """The map from evidence to the chance of being right, and each language's limit, from all rows of judged (lang, entropy, n).

    Spark counts the rows by evidence, to DIGITS binary digits, and takes the quantiles of
    cross-entropies on a grid. So what reaches the driver is bounded (1,024 rows for each power of
    two of the evidence) while no row is left out.
    """
    two = F.slice(F.array_sort("entropy"), 1, 2)
    gap = (two[1] - two[0] if len(languages) > 1 else F.lit(1.0)) * F.sqrt("n")
    step = F.pow(F.lit(2.0), F.floor(F.log2("gap")) - DIGITS)
    best = F.element_at(F.array(*map(F.lit, languages)), F.array_position("entropy", F.array_min("entropy")).cast("int"))
    rows = judged.select("lang", best.alias("best"), F.array_min("entropy").alias("low"), gap.alias("gap"))
    ahead = F.when(F.col("gap") > 0, F.floor(F.col("gap") / step) * step).otherwise(0.0)
    rows = written(rows.select((F.col("best") == F.col("lang")).alias("right"), "best", (F.ceil(F.col("low") * GRID) / GRID).alias("low"), ahead.alias("ahead")))
    counts = rows.groupBy("ahead").agg(F.count("*").alias("n"), F.sum(F.col("right").cast("long")).alias("ones")).orderBy("ahead").toPandas()
    if not len(counts):
        return None, {}
    limits = rows.filter("right").groupBy("best").agg(F.percentile("low", F.lit(0.999)).alias("most")).collect()
    return fit_isotonic(counts["ahead"].to_numpy(float), counts["ones"].to_numpy(float), counts["n"].to_numpy(float)), {r.best: 1.1 * r.most for r in limits}


def fit_langid(docs: DataFrame, most_cells: int = MAX_CELLS, least: int = LEAST_COUNT) -> Identifier:
    """Fit on rows of docs (doc_id, text, lang) with a language whose fold is not 0.

    All whole texts of folds 1 to 4 are counted. Models of folds 2 to 4 alone judge all rows of
    fold 1, which calibrate: an isotonic map from the evidence to the chance of being
    right, and for each language the cross-entropy that 999 in 1,000 of its texts stay under, with a
    tenth to spare. The models that are kept take all four folds.
    """
    rows = docs.select("doc_id", "text", "lang", fold().alias("fold")).filter("fold != 0 and lang is not null")
    counts = stored(count_grams(rows))

    def identifier(n: str) -> Identifier:
        own = counts.select("lang", "gram", F.col(n).alias("n")).filter("n > 0")
        sizes = {r.lang: r.kept for r in own.groupBy("lang").agg(F.sum((F.col("n") >= least).cast("long")).alias("kept")).collect()}
        return Identifier(own, language_parts(sizes, most_cells), gram_tables(own, least))

    early = identifier("early")
    calibration, limit = None, None
    if early.parts:
        judged = early.entropies(rows.filter("fold = 1").select("lang", "text"), "found")
        calibration, limit = calibrated(judged.select("lang", "found.entropy", "found.n").filter("n > 0"), early.languages)
    model = identifier("n")
    model.calibration, model.limit = calibration, limit
    return model


def identify_languages(docs: DataFrame, model: Identifier, name: str = "language") -> DataFrame:
    """docs with a struct column of that name: lang, score, accepted, cross_entropy.

    accepted is the calibrated rejection: false where the chance of being right is under a
    half or the text is less like its language than nearly all training texts.
    """
    kind = "lang string, score double, accepted boolean, cross_entropy double"
    if not model.parts:
        return docs.withColumn(name, F.from_json(F.lit('{"lang":"und","score":0.0,"accepted":false}'), kind))
    languages, calibration, limit = model.languages, model.calibration, model.limit  # without frames, which can't be shipped
    if len(model.parts) == 1:  # all in one function, so that a task needs one Python worker
        shipped = docs.sparkSession.sparkContext.broadcast(model.part(model.parts[0]))

        @F.arrow_udf(kind)
        def found(texts: pa.Array) -> pa.Array:
            return as_struct(judgements(languages, calibration, limit, *shipped.value.cross_entropy(texts)))

        return docs.withColumn(name, found("text"))
    measured = fresh(docs, "_measured")[0]

    @F.arrow_udf(kind)
    def judged(entropy: pa.Array, n: pa.Array) -> pa.Array:
        rows = entropy.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(languages))
        return as_struct(judgements(languages, calibration, limit, rows, n.to_numpy(zero_copy_only=False)))

    out = model.entropies(docs, measured)
    return out.withColumn(name, judged(F.col(measured)["entropy"], F.col(measured)["n"])).drop(measured)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_langid(docs)
    found = identify_languages(docs.select("doc_id", "text"), model, "found")
    return found.select("doc_id", (fold() == 0).alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score", "found.accepted", "found.cross_entropy")
