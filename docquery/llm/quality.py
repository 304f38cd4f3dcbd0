"""Quality rules: two hard rules on document statistics, then boosted trees on them.

The statistics are taken from whole texts in one pass. Trees are fitted on a bounded sample of
rows with a quality label; the score may only fall as repetition, symbols or shouting rise, and
that is a constraint of the fit, not a hope. They travel as numpy node arrays and score a batch
of documents level by level.

Defined results: a null text has no words and fails the hard rules, as does an empty one; rows
are kept one for one. If no usable label is there, the trees keep whatever the hard rules keep.
Statistics count code points; capitals are upper-case letters of any script; the number of statistics
per text is fixed, and memory is bounded by one text, read whole however long. doc_id may be of any
type; other columns are left aside, so their names don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.llm.common import fetched, held, sampled, stored, table
from docquery.llm.gbt import Trees, fit_trees

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
#: Bound of the labelled rows that the trees are fitted on.
MAX_LABELLED = 24_000
#: Documents stay unless the trees find bad quality likelier than this.
MAX_BAD = 0.5

#: The symbols that are counted.
SYMBOLS = re.compile(r"[#*$%&|<>]")
ASCII_CAPITALS = bytes(range(65, 91))
#: Characters that are looked up at once.
BLOCK = 1 << 16

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "capital_rate", "digit_rate", "exclamation_rate",
    "distinct_rate", "stop_rate", "line_words", "punctuated_lines", "log_words",
)
#: Signs of the constraints on the chance of good quality.
MONOTONE = {"symbol_rate": -1, "dup_line_rate": -1, "repeat_rate": -1, "capital_rate": -1, "exclamation_rate": -1}


@cache
def _upper() -> np.ndarray:
    """Of each code point under 0x20000, whether it is an upper-case letter; there are none beyond."""
    return np.fromiter((chr(c).isupper() for c in range(0x20000)), bool, 0x20000)


def capitals_of(text: str, raw: bytes) -> int:
    """Upper-case letters of any script in a text, which raw holds as UTF-8."""
    if text.isascii():
        return len(raw) - len(raw.translate(None, ASCII_CAPITALS))
    found = 0
    for i in range(0, len(text), BLOCK):
        code = np.frombuffer(text[i : i + BLOCK].encode("utf-32-le", "surrogatepass"), "<u4")
        found += int(np.count_nonzero(_upper()[np.minimum(code, 0x1FFFF)]))
    return found


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that stand in a window that occurs twice or more in the text, its first place included."""
    n = len(words)
    if n <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == n:
        return 0
    key = ids[: n - window + 1]
    for k in range(1, window):  # number pairs, then pairs with the next word: no key ever overflows
        key = np.unique(key * (len(number) + 1) + ids[k : n - window + 1 + k], return_inverse=True)[1]
    again = np.bincount(key)[key] > 1
    covered = np.zeros(n, bool)
    for k in range(window):
        covered[k : n - window + 1 + k] |= again
    return int(covered.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """COUNTS and FEATURES of one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # on ASCII white space, as bytes
    n = len(words)
    code_points = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    symbols = len(SYMBOLS.findall(text))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    capitals, digits = capitals_of(text, raw), sum(map(text.count, "0123456789"))
    w, c, k = max(n, 1), max(code_points, 1), max(len(lines), 1)
    counts = [n, code_points, symbols, dup_lines, repeats]
    return counts, [
        code_points / w, symbols / c, dup_lines / k, repeats / w, capitals / c, digits / c, text.count("!") / c,
        len(set(words)) / w, sum(len(x) <= 3 for x in words) / w, n / k, sum(x.rstrip()[-1:] in b".!?:;" for x in lines) / k, float(np.log1p(n)),
    ]


def measured(docs: DataFrame, extra: str = "") -> DataFrame:
    """doc_id, the counts and the features of every row; extra: 'name type' of a column to carry."""
    carried = extra.split(" ")[0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [statistics(t) for t in batch["text"]]
            out = pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()})
            counts = np.array([c for c, _ in got], np.int64).reshape(-1, len(COUNTS))
            values = np.array([v for _, v in got], float).reshape(-1, len(FEATURES))
            for name, column in zip((*COUNTS, *FEATURES), (*counts.T, *values.T), strict=True):
                out[name] = column
            if carried:
                out[carried] = batch[carried].to_numpy()
            yield out

    numbers = ", ".join([*(f"{x} long" for x in COUNTS), *(f"{x} double" for x in FEATURES), *([extra] if extra else [])])
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(numbers)])
    return docs.select("doc_id", "text", *([carried] if carried else [])).mapInPandas(run, schema)


def fit_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Trees:
    """Trees for the chance of good quality, from about max_labelled labelled rows."""
    truth = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = fetched(docs.select("doc_id", "text"), sampled(stored(held(docs, truth)), max_labelled))
    least = F.min(F.struct("quality", *FEATURES)).alias("row")
    got = measured(rows, "quality int").groupBy("doc_id").agg(least).select("doc_id", "row.*").toPandas().sort_values(["doc_id", *FEATURES], kind="stable")
    signs = {FEATURES.index(name): sign for name, sign in MONOTONE.items()}
    return fit_trees(got[list(FEATURES)].to_numpy(float), got["quality"].to_numpy(float), trees=80, depth=3, monotone=signs)


def judge_quality(docs: DataFrame, trees: Trees, max_bad: float = MAX_BAD) -> DataFrame:
    """doc_id, the counts, base_failed, kept and quality (chance of good quality) of every row."""
    score = F.pandas_udf(lambda *x: pd.Series(trees.probability(np.stack([c.to_numpy(float) for c in x], axis=1))), "double")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    found = measured(docs).select("doc_id", *COUNTS, base.alias("base_failed"), score(*FEATURES).alias("quality"))
    return found.withColumn("kept", ~F.col("base_failed") & (1 - F.col("quality") <= max_bad))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = fit_quality(docs, table(spark, sf_dir, "labels"))
    return judge_quality(docs, trees).select("doc_id", *COUNTS, "base_failed", "kept", "quality")
