"""Toxicity scores: boosted trees over dense text features, calibrated by isotonic regression.

Three models are fitted on labelled rows, each from a bounded sample, and together are a few
hundred kB: a lexicon of words and word beginnings that mark toxic texts, the trees, and the
isotonic map. Whole texts are then scored in one pass with no shuffle.

Defined results: a null text counts as empty; an empty text gets the score that the trees give
to all-zero features; rows are kept one for one, repeated rows included; a label row with a
null doc_id or label is not used; of rows that repeat a labelled doc_id, one is used for the
trees; where the folds for the trees hold one class only, or none, nothing can be told apart,
and every score is the same and under 0.5. Columns of the input other than doc_id and text are
passed through by `score_toxicity` and may have any name except the two that it adds.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.llm.common import columns, fetched, fold, held, sampled, stored, table
from docquery.llm.gbt import Isotonic, Trees, fit_isotonic, fit_trees

#: Insults that count before any label is seen.
INSULTS = frozenset("idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting clown dumb".split())
#: Second-person words of English, German, French and Spanish.
SECOND_PERSON = frozenset("you your yours yourself du dich dir dein deine ihr euch tu toi te ton ta vous votre ti usted tú tus".split())
#: Bound of the labelled rows that one of the three models is fitted on.
MAX_LABELLED = 24_000
#: Bound of the learned lexicon.
MAX_LEXICON = 4_000
#: Words whose marks a task remembers.
MAX_REMEMBERED = 200_000
#: How many words around a lexicon hit a second-person word is looked for.
NEAR = 5

FEATURES = (
    "log_words", "insult_rate", "insult_hits", "lexicon_rate", "lexicon_hits", "lexicon_peak",
    "near_second_person", "second_person_rate", "capital_rate", "shout_rate", "exclamation_rate",
    "punctuation_rate", "obfuscation_rate",
)

WORD = re.compile(r"[^\W_]+")
OBFUSCATED = re.compile(r"[A-Za-z][0-9@$*!|]+[A-Za-z]")
PUNCTUATION = re.compile(r"[^\w\s]")
CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
SHOUTED = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b")


def lexicon_keys(word: str) -> tuple[str, ...]:
    """The lexicon's keys of a word: itself and, for inflected languages, its first 4 to 6 characters."""
    return (word, *(f"{word[:k]}~" for k in (4, 5, 6) if len(word) > k))


class Marks(dict):
    """word -> place in `kinds`, the distinct (lexicon weight, insult, second person) of words; place 0 is of words with none.

    Words are looked up once and remembered, up to MAX_REMEMBERED of them.
    """

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights
        self.kinds = [(0.0, False, False)]
        self.places = {self.kinds[0]: 0}

    def __missing__(self, word: str) -> int:
        if len(self) >= MAX_REMEMBERED:
            self.clear()
        weight = max((self.weights[k] for k in lexicon_keys(word) if k in self.weights), default=0.0)
        kind = (max(weight, 0.0), word in INSULTS, word in SECOND_PERSON)
        place = self.places.get(kind)
        if place is None:
            place = self.places[kind] = len(self.kinds)
            self.kinds.append(kind)
        self[word] = place
        return place


def features(text: str | None, marks: Marks) -> list[float]:
    """FEATURES of one whole text."""
    text = text or ""
    words = WORD.findall(text.lower())
    n, chars = max(len(words), 1), max(len(text), 1)
    places = np.fromiter(map(marks.__getitem__, words), np.int32, len(words))
    at = np.flatnonzero(places)
    kinds = [marks.kinds[p] for p in places[at].tolist()]
    insults = sum(insult for _, insult, _ in kinds)
    hits = [i for i, (weight, _, _) in zip(at.tolist(), kinds, strict=True) if weight > 0]
    peak = max((weight for weight, _, _ in kinds), default=0.0)
    second = np.array([i for i, (_, _, you) in zip(at.tolist(), kinds, strict=True) if you], np.int64)
    close = np.searchsorted(second, np.array(hits, np.int64) + NEAR, "right") > np.searchsorted(second, np.array(hits, np.int64) - NEAR)
    return [
        math.log1p(len(words)), insults / n, float(insults), len(hits) / n, float(len(hits)), peak,
        float(close.sum()), len(second) / n, len(CAPITAL.findall(text)) / chars, len(SHOUTED.findall(text)) / n,
        text.count("!") / chars, len(PUNCTUATION.findall(text)) / chars, len(OBFUSCATED.findall(text)) / n,
    ]


def fit_lexicon(labelled: DataFrame, max_lexicon: int = MAX_LEXICON) -> dict[str, float]:
    """Word and prefix keys with their log odds of standing in a toxic rather than a clean text.

    labelled: text, toxic. Counts are of texts, not of places. The first pass keeps the keys
    of at least 0.5 % of the toxic texts (2 at least), which bounds them however many texts
    there are; the second counts only those in the clean texts. The max_lexicon keys with the
    highest log odds above 2 stay.
    """

    def counted(wanted: frozenset[str] | None):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            counts: Counter[str] = Counter()
            for batch in batches:
                for text in batch["text"]:
                    keys = {k for w in set(WORD.findall((text or "").lower())) for k in lexicon_keys(w)}
                    counts.update(keys if wanted is None else keys & wanted)
                if len(counts) > 200_000:
                    yield pd.DataFrame({"key": list(counts), "n": list(counts.values())})
                    counts.clear()
            yield pd.DataFrame({"key": list(counts), "n": list(counts.values())}).astype({"key": object, "n": "int64"})

        return run

    toxic, clean = (labelled.filter(F.col("toxic") == k).select("text") for k in (1, 0))
    n_toxic, n_clean = toxic.count(), clean.count()
    if not n_toxic or not n_clean:
        return {}
    total = lambda df, wanted: df.mapInPandas(counted(wanted), "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    ones = {r.key: r.n for r in total(toxic, None).filter(F.col("n") >= max(2, math.ceil(0.005 * n_toxic))).collect()}
    zeros = {r.key: r.n for r in total(clean, frozenset(ones)).collect()}
    odds = {k: math.log((n + 0.5) / (n_toxic + 1)) - math.log((zeros.get(k, 0) + 0.5) / (n_clean + 1)) for k, n in ones.items()}
    best = sorted((k for k, v in odds.items() if v > 2.0), key=lambda k: (-odds[k], k))[:max_lexicon]
    return {k: odds[k] for k in best}


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: dict[str, float]
    trees: Trees
    calibration: Isotonic

    def score(self, texts, marks: Marks | None = None) -> np.ndarray:
        """Scores of whole texts; marks: those of self.lexicon, to be used again for the next texts."""
        marks = Marks(self.lexicon) if marks is None else marks
        x = np.array([features(t, marks) for t in texts], dtype=float).reshape(-1, len(FEATURES))
        return np.clip(self.calibration(self.trees.margin(x)), 0.0, 1.0)


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> ToxicityModel:
    """Fit on labelled rows whose fold is not 0, about max_labelled of them for each model.

    The lexicon is learned from folds 1 and 2. The trees for the calibration are fitted on
    fold 3 and judged on fold 4 and the other way round, so the isotonic map sees only rows
    that its trees did not; the final trees take both folds.
    """
    truth = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = stored(held(docs, truth).withColumn("fold", fold()).filter("fold != 0"))
    picked = sampled(known.filter("fold in (1, 2)"), max_labelled).union(sampled(known.filter("fold in (3, 4)"), max_labelled))
    rows = fetched(docs.select("doc_id", "text"), picked)
    lexicon = fit_lexicon(rows.filter("fold in (1, 2)").select("text", "toxic"))

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks = Marks(lexicon)
        for b in batches:
            x = np.array([features(t, marks) for t in b["text"]], dtype=float).reshape(-1, len(FEATURES))
            yield pd.DataFrame({"doc_id": b["doc_id"], "fold": b["fold"], "toxic": b["toxic"], **dict(zip(FEATURES, x.T, strict=True))})

    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("fold int, toxic int, " + ", ".join(f"{f} double" for f in FEATURES))])
    found = rows.filter("fold in (3, 4)").mapInPandas(measured, schema)
    least = F.min(F.struct("fold", "toxic", *FEATURES)).alias("row")
    got = found.groupBy("doc_id").agg(least).select("doc_id", "row.*").toPandas()
    got = got.sort_values(["doc_id", *FEATURES], kind="stable")
    x, y, half = got[list(FEATURES)].to_numpy(float), got["toxic"].to_numpy(float), got["fold"].to_numpy() == 3
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        return ToxicityModel(lexicon, fit_trees(x, y), Isotonic(np.array([0.0]), np.array([0.49 * share])))
    unseen = np.zeros(len(y))
    for fitted, judged in ((half, ~half), (~half, half)):
        unseen[judged] = fit_trees(x[fitted], y[fitted]).margin(x[judged])
    return ToxicityModel(lexicon, fit_trees(x, y), fit_isotonic(unseen, y))


def scorer(model: ToxicityModel):
    """The calibrated score of a column of texts."""

    @F.pandas_udf(T.DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        marks = Marks(model.lexicon)
        for texts in batches:
            yield pd.Series(model.score(texts, marks))

    return scored


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """docs with toxicity double and toxic_predicted int (1 if toxicity >= threshold); columns of these names are replaced."""
    return docs.withColumn("toxicity", scorer(model)("text")).withColumn("toxic_predicted", (F.col("toxicity") >= threshold).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    held_out = (fold() == 0).alias("held_out")
    return score_toxicity(docs, model).select("doc_id", held_out, F.col("toxicity").alias("score"), F.col("toxic_predicted").alias("predicted"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    """Pipeline stage: documents that the calibrated score calls toxic go; all others stay unchanged, repeated rows and null ids included.

    Null and empty texts are scored as texts without words; whole texts are read, however long.
    Columns other than doc_id and text may have any name.
    """
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return docs.filter(scorer(model)("text") < threshold).select(*columns(docs))
