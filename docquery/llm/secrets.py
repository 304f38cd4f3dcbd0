"""Secret scans: three fixed patterns, and a battery of randomness tests for everything else.

DataFrame functions only; regular expressions run in the JVM, and only on texts that a cheap
guard lets through. Offsets are code points of the whole text.

The battery takes runs of 20 or more characters of the base-64 alphabets, infers their encoding
(hex, base 32 and base 36 in either case, letters and digits, base 64) and tests them against a uniform alphabet: the
chi-squared statistic of the symbol counts, the number of runs above and below the middle of
the alphabet, and the correlation of neighbouring symbols. A run that fails one of them at
1 in 1,000 is no secret. For the others the question is turned round: how likely would ordinary
text look that even? Under that hypothesis the statistic is noncentral, with a noncentrality of
length times the excess of text's index of coincidence, so short runs can't get a small p-value.
Benjamini-Hochberg control at `RATE`, in classes of length, over the runs of all documents, picks
the runs that are reported. Its thresholds come from a histogram of p-values with a fixed number
of bins, each counted at its upper edge, so the control is exact or stricter.

Defined results: null and empty texts have no spans; rows are kept one for one. A run that
overlaps a span of the fixed patterns adds nothing. Matches are leftmost and don't overlap within
a kind; the hash of no spans is that of the empty string. Very long texts and texts with very
many matches are searched whole. doc_id may be of any type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docquery.llm.common import guarded, stored, table

KINDS = ("assign", "access", "hex", "random")
#: The three patterns. A match of the first counts if its second group has 12 characters.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
LEAST_ASSIGNED = 12
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
#: What a text must hold for the patterns of long runs to match at all.
GUARD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
KEYWORDS = r"(?i)passw|secret|token|api_?key"

#: False-discovery rate; the level at which a run fails a test of the battery, as a normal deviate.
RATE = 0.01
DEVIATE = 3.29
#: Encoding -> alphabet, and the index of coincidence that text has at least when written in it.
ALPHABETS = {
    "hex": ("0123456789abcdef", 0.125),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.06),
    "lower32": ("abcdefghijklmnopqrstuvwxyz234567", 0.06),
    "base36": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 0.06),
    "lower36": ("abcdefghijklmnopqrstuvwxyz0123456789", 0.06),
    "alnum": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 0.06),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.06),
}
#: Lower ends of the classes of length.
LENGTHS = (20, 32, 64, 128)
#: Bins of a factor of ten of p-values, and how many factors.
BINS, DECADES = 20, 30
MASK = "[secret]"


def step(x: Column, use) -> Column:
    """use of a struct that is worked out once; named columns would be worked out again at each use in a lambda."""
    return F.transform(F.array(x), use)[0]


def total(numbers: Column, first, n) -> Column:
    """Sum of n numbers from place `first` (from 0) on."""
    return F.aggregate(F.slice(numbers, first + 1, n), F.lit(0), lambda s, x: s + x)


def located(text: Column, pattern: str, wanted: Column, groups: tuple[int, ...] = (0,)) -> Column:
    """Array of (start, value of each group) of the pattern's matches, empty unless wanted.

    Splitting at the matches gives the pieces between them; the lengths of pieces and matches
    before one are its start. They are added up in about sqrt(n) stretches of about sqrt(n)
    matches first, so a text with very many matches takes n * sqrt(n) steps, not n * n.
    """
    found = [F.regexp_extract_all(text, F.lit(pattern), g) for g in groups]
    pieces = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    lengths = F.transform(found[0], lambda x: F.length(x))
    with_match = F.zip_with(pieces, lengths, lambda a, b: a + F.coalesce(b, F.lit(0)))
    wide = F.ceil(F.sqrt(F.size(found[0]) + 1)).cast("int")
    out = F.struct(found[0].alias("value"), found[-1].alias("inner"), pieces.alias("pieces"), with_match.alias("steps"), wide.alias("wide"))
    stretches = lambda use, x: F.transform(F.sequence(F.lit(0), x["wide"] - 1), use)
    out = step(out, lambda x: x.withField("sums", stretches(lambda k: total(x["steps"], k * x["wide"], x["wide"]), x)))
    out = step(out, lambda x: x.withField("before", stretches(lambda k: total(x["sums"], F.lit(0), k), x)))

    def placed(x: Column) -> Column:
        def one(pair: Column, i: Column) -> Column:
            k = F.floor(i / x["wide"]).cast("int")
            start = F.get(x["before"], k) + total(x["steps"], k * x["wide"], i - k * x["wide"]) + F.get(x["pieces"], i)
            return F.struct(start.alias("start"), pair["value"].alias("value"), pair["inner"].alias("inner"))

        return F.transform(F.arrays_zip(x["value"].alias("value"), x["inner"].alias("inner")), one)

    return F.when(wanted, step(out, placed)).otherwise(F.array().cast("array<struct<start:int,value:string,inner:string>>"))


def as_spans(rows: Column, kind: str) -> Column:
    """Array of spans that sorts by start, then kind as listed."""
    return F.transform(
        rows, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), (x["start"] + F.length(x["value"])).alias("stop"), F.lit(kind).alias("kind"))
    )


def upper_tail(z: Column) -> Column:
    """P(normal deviate > z), by formula 26.2.17 of Abramowitz and Stegun."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / 2.5066282746310002 * series
    return F.when(z >= 0, tail).otherwise(1 - tail)


def encoding_of(value: Column) -> Column:
    """Name of the narrowest alphabet that holds the value; null for mere numbers, words of one case and nothing at all (a run of = signs)."""
    return (
        F.when(value.rlike(r"^[0-9]*$|^[a-z_/=-]+$|^[A-Z_/=-]+$"), None)
        .when(value.rlike(r"^[0-9a-f]+$|^[0-9A-F]+$"), "hex")
        .when(value.rlike(r"^[A-Z2-7]+$"), "base32")
        .when(value.rlike(r"^[a-z2-7]+$"), "lower32")
        .when(value.rlike(r"^[A-Z0-9]+$"), "base36")
        .when(value.rlike(r"^[a-z0-9]+$"), "lower36")
        .when(value.rlike(r"^[A-Za-z0-9]+$"), "alnum")
        .otherwise("base64")
    )


def battery(run: Column) -> Column:
    """Struct (start, stop, length, random, p) of a run (start, value).

    random: no test of the battery fails. p: chance that text of this length and encoding has a
    chi-squared statistic as small.
    """
    by_encoding = lambda f: F.create_map(*(F.lit(v) for name, spec in ALPHABETS.items() for v in (name, f(*spec))))
    sizes, excesses = by_encoding(lambda alphabet, _: float(len(alphabet))), by_encoding(lambda alphabet, ic: len(alphabet) * ic - 1)
    alphabets = by_encoding(lambda alphabet, _: alphabet)
    without = lambda text, part: F.length(F.replace(text, part, F.lit("")))

    def coded(x: Column) -> Column:
        encoding, value = x["encoding"], F.when(x["encoding"] == "hex", F.lower(x["bare"])).otherwise(x["bare"])
        return F.struct(value.alias("value"), F.length(value).alias("n"), sizes[encoding].alias("size"), excesses[encoding].alias("excess"), alphabets[encoding].alias("alphabet"))

    def split(x: Column) -> Column:
        symbols = F.when(x["size"].isNotNull(), F.split(x["value"], ""))
        numbers = F.transform(symbols, lambda c: F.instr(x["alphabet"], c).cast("double"))
        squares = F.aggregate(F.array_distinct(symbols), F.lit(0.0), lambda s, c: s + F.pow((x["n"] - without(x["value"], c)).cast("double"), 2.0))
        return F.struct(x["n"].alias("n"), x["size"].alias("size"), x["excess"].alias("excess"), squares.alias("squares"), numbers.alias("numbers"))

    def centred(x: Column) -> Column:
        middle = F.aggregate(x["numbers"], F.lit(0.0), lambda s, v: s + v) / x["n"]
        bits = F.array_join(F.transform(x["numbers"], lambda v: F.when(v == 0, " ").when(v <= F.floor(x["size"] / 2), "0").otherwise("1")), "")
        return x.withField("middle", middle).withField("bits", bits)

    def summed(x: Column) -> Column:
        n, middle, bits = x["n"], x["middle"], x["bits"]
        spread = F.aggregate(x["numbers"], F.lit(0.0), lambda s, v: s + (v - middle) * (v - middle))
        beside = F.zip_with(F.slice(x["numbers"], 1, n - 1), F.slice(x["numbers"], 2, n - 1), lambda v, w: (v - middle) * (w - middle))
        ones = n - without(bits, F.lit("1"))
        turns = (n - without(bits, F.lit("01"))) / 2 + (n - without(bits, F.lit("10"))) / 2
        return F.struct(
            n.alias("n"), (x["size"] - 1).alias("free"), (x["size"] / n * x["squares"] - n).alias("chi"), (n * x["excess"]).alias("noncentral"), turns.alias("turns"),
            (2.0 * ones * (n - ones) / n + 1).alias("mean"), spread.alias("spread"), F.aggregate(beside, F.lit(0.0), lambda s, v: s + v).alias("serial"),
        )

    def judged(x: Column) -> Column:
        n, free, chi, mean = x["n"], x["free"], x["chi"], x["mean"]
        z_chi = (F.cbrt(chi / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        z_runs = F.when(mean <= 2, F.lit(99.0)).otherwise((x["turns"] + 1 - mean) / F.sqrt((mean - 1) * (mean - 2) / (n - 1)))
        z_serial = F.when(x["spread"] > 0, x["serial"] / x["spread"] * F.sqrt(n)).otherwise(99.0)
        z_text = (chi - free - x["noncentral"]) / F.sqrt(2 * (free + 2 * x["noncentral"]))
        random = (n >= LENGTHS[0]) & (z_chi <= DEVIATE) & (F.abs(z_runs) <= DEVIATE) & (F.abs(z_serial) <= DEVIATE)
        return F.struct(
            run["start"].alias("start"),
            (run["start"] + F.length(run["value"])).alias("stop"),
            n.alias("length"),
            F.coalesce(random, F.lit(False)).alias("random"),
            F.coalesce(upper_tail(-z_text), F.lit(1.0)).alias("p"),
        )

    out = F.struct(F.rtrim(F.translate(run["value"], "-_=", "+/ ")).alias("bare"))
    for use in (lambda x: F.struct(x["bare"].alias("bare"), encoding_of(x["bare"]).alias("encoding")), coded, split, centred, summed, judged):
        out = step(out, use)
    return out


def with_candidates(docs: DataFrame) -> DataFrame:
    """docs (text and any others) with _secret_base, the fixed patterns' spans in order, and _secret_runs, the tested runs."""
    text = F.coalesce("text", F.lit(""))
    long_run = text.rlike(GUARD)
    docs = docs.withColumn("_secret_long", long_run)
    wanted = F.col("_secret_long")
    docs = docs.withColumns({
        "_secret_assign": located(text, ASSIGN, text.rlike(KEYWORDS), (0, 2)),
        "_secret_access": located(text, ACCESS, wanted & text.contains("AKIA")),
        "_secret_hex": located(text, HEX, wanted),
        "_secret_runs": located(text, RUN, wanted),
    })
    assigned = F.filter("_secret_assign", lambda x: F.length(x["inner"]) >= LEAST_ASSIGNED)
    base = F.array_sort(F.concat(as_spans(assigned, "assign"), as_spans(F.col("_secret_access"), "access"), as_spans(F.col("_secret_hex"), "hex")))
    return docs.withColumn("_secret_base", base).withColumn("_secret_runs", F.transform("_secret_runs", battery)).drop("_secret_long", "_secret_assign", "_secret_access", "_secret_hex")


def stratum(run: Column) -> Column:
    """Class of length of a run."""
    return sum((run["length"] >= low).cast("int") for low in LENGTHS)


def p_bin(run: Column) -> Column:
    """Bin of a run's p-value: 10 ** (-bin / BINS) is its upper edge."""
    return F.floor(F.least(F.lit(float(DECADES)), -F.log10(F.greatest(run["p"], F.lit(10.0**-DECADES)))) * BINS).cast("int")


def thresholds(found: DataFrame, rate: float = RATE) -> dict[int, int]:
    """Class of length -> the least bin that false-discovery control lets through, over all runs of found.

    No more than one count per class and bin is ever gathered.
    """
    runs = found.select(F.explode("_secret_runs").alias("run")).filter("run.random")
    counts = runs.groupBy(stratum(F.col("run")).alias("stratum"), p_bin(F.col("run")).alias("bin")).agg(F.count("*").alias("n"))
    down = Window.partitionBy("stratum").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumn("upto", F.sum("n").over(down)).withColumn("all", F.sum("n").over(Window.partitionBy("stratum")))
    good = placed.filter(F.pow(F.lit(10.0), -F.col("bin") / BINS) <= rate * F.col("upto") / F.col("all"))
    return {r.stratum: r.least for r in good.groupBy("stratum").agg(F.min("bin").alias("least")).collect()}


def all_spans(least: dict[int, int]) -> Column:
    """All spans in order: those of the fixed patterns, and the picked runs beside them."""

    def picked(run: Column) -> Column:
        passed = F.lit(False)
        for length_class, bin_ in least.items():
            passed = passed | ((stratum(run) == length_class) & (p_bin(run) >= bin_))
        apart = ~F.exists("_secret_base", lambda b: (b["start"] < run["stop"]) & (run["start"] < b["stop"]))
        return run["random"] & passed & apart

    runs = F.filter("_secret_runs", picked)
    place = KINDS.index("random")
    spans = F.transform(runs, lambda x: F.struct(x["start"].alias("start"), F.lit(place).alias("place"), x["stop"].alias("stop"), F.lit("random").alias("kind")))
    return F.array_sort(F.concat("_secret_base", spans))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) per row of docs (doc_id, text): arrays of (start, place, stop, kind)."""
    found = stored(with_candidates(docs.select("doc_id", "text")).select("doc_id", "_secret_base", "_secret_runs"))
    return found.select("doc_id", F.col("_secret_base").alias("base"), all_spans(thresholds(found)).alias("spans"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(n, KINDS[:3]), F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, and every stretch of spans that overlap, replaced by MASK."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(state: Column, span: Column) -> Column:
        between = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        fresh = F.struct(span["stop"].alias("at"), F.concat(state["done"], between, F.lit(MASK)).alias("done"))
        longer = F.struct(F.greatest(state["at"], span["stop"]).alias("at"), state["done"].alias("done"))
        return F.when((span["start"] >= state["at"]), fresh).otherwise(longer)

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, lambda s: F.concat(s["done"], F.substring(text, s["at"] + 1, F.length(text))))).otherwise(text)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: secrets are masked in the texts; every row stays, repeated ones too. n_chars, where it is there, follows the text.

    Null and empty texts stay as they are; whole texts are searched, however long. Other columns may have any name.
    """
    plain, back = guarded(docs, "text", "n_chars")
    least = thresholds(stored(with_candidates(plain.select("text")).select("_secret_runs").filter(F.size("_secret_runs") > 0)))
    out = with_candidates(plain).withColumn("_secret_spans", all_spans(least)).withColumn("text", masked(F.col("text"), F.col("_secret_spans")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("_secret_spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return back(out)
