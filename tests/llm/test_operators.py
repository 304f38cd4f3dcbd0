"""The operators as Spark jobs: brute force on small tables, and odd rows of all kinds."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docquery.llm import langid, licenses, mixing, quality, secrets, sentencepiece, sharding, simhash, topk, toxicity
from docquery.llm.gbt import fit_isotonic
from docquery.llm.queries import queries
from tests.llm.test_models import slow_fingerprint

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, key string, rank int"
LONG = "lorem ipsum dolor sit amet " * 9000


def odd_rows():
    """Nulls everywhere, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    r = lambda i, t, la="en", s="src0": (i, t, la, s, None if t is None else len(t), 1, 0.5, "x", 3)
    same = "one two three four five six seven eight nine ten"
    return [
        r(1, same), r(1, same), r(2, same), r(3, same.upper()), r(4, None), r(5, ""), r(None, "no id here"), r(None, "no id here"), r(None, None, None, None),
        r(6, LONG, None, None), r(7, LONG), r(8, "😀 password=abcdefghijkl0 und mehr", "de", None), r(9, " \n\t ", "fr"), r(10, "Released under the MIT License.\nRest", None, "src1"),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Folders with odd and with empty tables."""
    out = {}
    for name, rows in (("odd", odd_rows()), ("none", [])):
        at = out[name] = str(tmp_path_factory.mktemp(name))
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{at}/documents.parquet")
        labels = [(1, 1, 1), (2, 0, 0), (None, 1, 0), (3, None, None), (6, 1, 0), (7, 0, 1)] if rows else []
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
        vectors = [(0, [0.1, 0.2]), (0, [0.1, 0.2]), (50, [0.1, 0.2]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 0.0]), (100, [1.0]), (7, [-0.3, 0.9]), (None, [0.0, 0.0]), (8, [])] if rows else []
        spark.createDataFrame(vectors, "vec_id long, embedding array<double>").write.parquet(f"{at}/embeddings.parquet")
    return out


@pytest.mark.parametrize("name", sorted(queries()))
@pytest.mark.parametrize("kind", ["odd", "none"])
def test_odd_and_empty_tables(spark, tables, name, kind):
    rows = queries()[name](spark, tables[kind]).collect()
    if name != "op8_topk":
        assert len(rows) == (len(odd_rows()) if kind == "odd" else 0)


@pytest.mark.parametrize("kind", ["odd", "none"])
def test_pipeline_on_odd_and_empty_tables(spark, tables, kind):
    rows = corpus_pipeline.run(spark, tables[kind]).collect()
    assert (len(rows) > 0) == (kind == "odd")


def test_toxicity_and_language_on_held_out_rows(spark):
    at = "/root/testdata/sf0.01"
    got = toxicity.op1_toxicity(spark, at).join(spark.read.parquet(f"{at}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.93 and all(0 <= r.score <= 1 for r in got)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got)
    found = langid.op2_language(spark, at).join(spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in found) / len(found) > 0.97


def test_simhash_against_all_pairs(spark, odd):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau".split()
    rng = random.Random(8)
    texts = [" ".join(rng.choices(base, k=400)) for _ in range(12)]
    texts += [t.replace("alpha", "alfa", 1) for t in texts] + texts[:3] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = [slow_fingerprint(t) for t in texts]
    root = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(len(texts)):
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    root[a] = root[b] = min(root[a], root[b])
    assert [got[i].fingerprint % 2**64 for i in range(len(texts))] == prints
    assert [got[i].component_id for i in range(len(texts))] == root


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 102), (102, 101)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 102: 100}


def test_components_take_few_tasks(spark):
    """Every task leaves shuffle files and a record in the event log, so rounds on few edges are not to shuffle them for each join."""
    edges = simhash.stored(spark.createDataFrame([(min(k, 50), max(k, 50)) for k in range(100) if k != 50] + [(200, 201), (201, 202)], "a long, b long"))
    context, roots = spark.sparkContext, {**dict.fromkeys(range(100), 0), 200: 200, 201: 200, 202: 200}
    for most in (simhash.MAX_BROADCAST, 10):
        context.setJobGroup(group := f"components-{most}", group)
        try:
            assert {r.node: r.root for r in simhash.components(edges, most).collect()} == roots
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        jobs = [context.statusTracker().getJobInfo(j) for j in context.statusTracker().getJobIdsForGroup(group)]
        ran = [context.statusTracker().getStageInfo(s) for s in {s for j in jobs for s in j.stageIds}]
        assert most == 10 or sum(s.numCompletedTasks for s in ran if s) <= 30


def test_licenses_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in docs.collect():
        words = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r.text))
        at = {label: [i for i in range(len(words)) if words[i : i + len(p.split())] == p.split()] for p, label in licenses.PHRASES.items()}
        all_at = sorted(i for x in at.values() for i in x)
        g = got[r.doc_id]
        assert (g.n_words, g.n_base, g.first_word, g.last_word) == (len(words), len(all_at), *((all_at[0], all_at[-1]) if all_at else (None, None)))
        assert g.base_labels == ",".join(sorted(k for k, v in at.items() if v)) and set(filter(None, g.base_labels.split(","))) <= set(g.labels.split(","))


def test_quality_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for r in quality.op5_quality(spark, DATA).join(docs.select("doc_id", "text"), "doc_id").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text)
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", r.text)))
        lines = [x for x in r.text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)


def test_mixing_keeps_its_promises(spark, odd):
    rows = mixing.mix(odd).collect()
    assert sorted((r.doc_id or -1, r.size, r.taken) for r in rows) == sorted((r.doc_id or -1, r.size, r.taken) for r in mixing.mix(odd).collect())
    sources = {r.source: (r.source_size, r.target) for r in rows}
    names = sorted(s for s in sources if s is not None) + [None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, capped = sum(n for n, _ in sources.values()), set()
    while True:
        rest = total - sum(3 * sources[s][0] for s in capped)
        share = {s: rest * w / sum(v for x, v in weights.items() if x not in capped) for s, w in weights.items() if s not in capped}
        more = {s for s, v in share.items() if v > 3 * sources[s][0]}
        if not more:
            break
        capped |= more
    for s, (n, target) in sources.items():
        assert target == pytest.approx(3 * n if s in capped else share[s])
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own) / 2 + 1e-6
        assert all(r.taken <= 3 * r.size and (r.taken == 0 or 0 <= r.position <= 1) for r in own)


def test_shards(spark, odd):
    rows = sharding.shard_documents(odd).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[k]) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = sorted((len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in odd_rows())
    assert sorted((r.size, r.text_crc32) for r in rows) == want


def test_equal_texts_follow_each_other(spark):
    """Copies with other languages, sources and ids are neighbours."""
    rng = random.Random(21)
    rows = [(k, " ".join(rng.choices("abcdefgh", k=rng.choice([3, 30, 300]))), f"l{rng.randrange(6)}", f"s{rng.randrange(6)}") for k in range(200)]
    rows += [(rng.randrange(900), rows[k][1], rng.choice([None, "l0", "l5"]), rng.choice([None, "s0", "s5"])) for k in [1, 2, 3, 4] * 10]
    text = {zlib.crc32(t.encode()): t for _, t, _, _ in rows}
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)).collect()
    assert sorted((r.doc_id, text[r.text_crc32], r.lang or "", r.source or "") for r in got) == sorted((i, t, a or "", s or "") for i, t, a, s in rows)
    order = [r.text_crc32 for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert sum(a != b for a, b in zip(order, order[1:])) == len(set(order)) - 1


def test_shards_prune_in_every_dimension(spark):
    """Of 64 shards, one value of a language, a source or a size class lies in half at most; by hash it lies in nearly all."""
    rng = random.Random(22)
    rows = [(k, f"{k:08d}" + "x" * rng.choice([10, 100, 1000, 10_000]), f"l{rng.randrange(4)}", f"s{rng.randrange(4)}") for k in range(3000)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), 64).collect()
    for name in ("lang", "source", "size"):
        values = {r[name] for r in got}
        assert all(len({r.shard for r in got if r[name] == v}) <= 32 < 50 < len({r.doc_id * 7919 % 64 for r in got if r[name] == v}) for v in values)


def test_written_shards(spark, odd, tmp_path):
    """Files hold every row once, under its own columns, in the shard and the order that the ranking gives."""
    docs = odd.withColumn("a.b", F.col("rank")).withColumn("_slot", F.lit("own"))
    sharding.write_shards(docs, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert [c for c in back.columns if c != "shard"] == docs.columns
    plain = lambda df: sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "", r["lang"] or "", r["a.b"], r["_slot"]) for r in df.collect())
    assert plain(back) == plain(docs)
    want = sorted((r.shard, r.size) for r in sharding.shard_documents(odd).collect())
    assert sorted((r.shard, len((r.text or "").encode()) + 1) for r in back.select("shard", "text").collect()) == want
    with pytest.raises(ValueError):
        sharding.write_shards(docs.withColumn("Shard", F.lit(1)), f"{tmp_path}/no")


def test_top_k_against_all_scores(spark):
    """Copies of vectors, and ids that repeat with other vectors."""
    rng = np.random.default_rng(3)
    e = np.round(rng.normal(size=(230, 6)), 1)
    e[100:160] = e[7]
    ids = [*range(220), 0, 50, 50, 3, 3, 100, 100, 7, 7, 7]
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, e, strict=True)], "vec_id long, embedding array<double>")
    q = topk.quantised(frame, "vec_id", "embedding")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(q, F.col("id") % 50 == 0).collect())
    m = np.floor(256 * e).astype(int)
    want = []
    for i in range(230):
        if ids[i] % 50 == 0:
            order = sorted((j for j in range(230) if j != i), key=lambda j: (-int(m[i] @ m[j]), ids[j]))[:5]
            want += [(ids[i], k + 1, ids[j], int(m[i] @ m[j])) for k, j in enumerate(order)]
    assert got == sorted(want)


def test_top_k_sends_little_where_thresholds_prune_little(spark, monkeypatch):
    """With several blocks and groups the results are exact, and of alike scores only what reaches the cutoff leaves a task."""
    monkeypatch.setattr(topk, "VECTOR_ROWS", 150)
    monkeypatch.setattr(topk, "QUERY_ROWS", 5)
    monkeypatch.setattr(topk, "GROUPS", 3)
    monkeypatch.setattr(topk, "RUN", 8)
    e = np.random.default_rng(5).normal(size=(1000, 16))
    e[600:] = e[:400]
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(e)], "vec_id long, embedding array<double>")
    rows = topk.quantised(frame, "vec_id", "embedding")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(rows, F.col("id") % 50 == 0).collect())
    m = np.floor(256 * e).astype(int)
    score = m @ m.T
    want = []
    for i in range(0, 1000, 50):
        order = sorted((j for j in range(1000) if j != i), key=lambda j: (-score[i, j], j))[:5]
        want += [(i, k + 1, j, int(score[i, j])) for k, j in enumerate(order)]
    assert got == sorted(want)
    classes = topk.distinct_vectors(topk.narrowed(rows), 6)
    sent = topk.best_classes(classes, classes.filter(F.element_at("ids", 1) % 50 == 0).select("class_id"), 6)
    assert classes.count() == 600 and sent.count() < 2 * 6 * 12


def test_top_k_of_large_numbers(spark):
    """Components that no float holds exactly are multiplied as whole numbers."""
    rows = spark.createDataFrame([(k, [2**30 + k, -(2**31) + k]) for k in range(9)], "id long, q array<long>")
    got = {(r["rank"], r.vec_id, r.score) for r in topk.top_k(rows, F.col("id") == 0).collect()}
    assert got == {(k, k, 2**30 * (2**30 + k) - 2**31 * (k - 2**31)) for k in range(1, 6)}


def base_spans(text):
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_secrets_against_brute_force(spark):
    rng = random.Random(9)
    pieces = ["token=", "PASSWORD : '", "secret", "AKIAABCDEFGHIJKLMN", "AKIA", "0123456789abcdef", "deadbeef", " ", "é😀", "=", '"', "x" * 13, "\n", "api_key:"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(150)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets.find_secrets(docs).select("doc_id", secrets.written(F.col("base")).alias("base"), secrets.written(F.col("spans")).alias("spans")).collect():
        assert r.base == base_spans(texts[r.doc_id] or "") and set(filter(None, r.base.split(","))) <= set(r.spans.split(","))


def test_random_runs_are_found_and_words_are_not(spark):
    rng = random.Random(10)
    alphabet = secrets.ALPHABETS["alnum"][0]
    texts = ["key " + "".join(rng.choices(alphabet, k=60)) + " end" for _ in range(20)]
    texts += ["InternationalizationConfigurationManagerFactoryBean", "docs/reference/configuration/installation-guide", "00000000000000000000000000000000000Aa", "supercalifragilisticexpialidocious"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = secrets.find_secrets(docs).collect()
    found = {r.doc_id for r in spans if len(r.spans) > len(r.base)}
    touched = {r.doc_id for r in spans if r.spans}  # the zeros are a hex run of the fixed patterns
    assert len(found & set(range(20))) >= 17 and not found & {20, 21, 22, 23}
    masked = secrets.mask_secrets(spark, docs.withColumn("n_chars", F.length("text").cast("long")), "").collect()
    assert all(("[secret]" in r.text) == (r.doc_id in touched) and r.n_chars == len(r.text) for r in masked)


def slow_battery(value):
    """(length, random, p) of a run, by its tests one by one; p is 1 where no encoding fits."""
    bare = value.translate(str.maketrans("-_=", "+/ ")).rstrip(" ")
    if not bare or re.fullmatch(r"[0-9]+|[a-z/]+|[A-Z/]+", bare):
        return len(bare), False, 1.0
    names = ["hex", "base32", "lower32", "base36", "lower36", "alnum"]
    fits = [k for k in names if set(bare) <= set(secrets.ALPHABETS[k][0]) or (k == "hex" and set(bare) <= set("0123456789ABCDEF"))]
    name = fits[0] if fits else "base64"
    alphabet, ic = secrets.ALPHABETS[name]
    text = bare.lower() if name == "hex" else bare
    n, size = len(text), len(alphabet)
    chi = sum(text.count(c) ** 2 for c in set(text)) * size / n - n
    z_chi = (np.cbrt(chi / (size - 1)) - (1 - 2 / (9 * (size - 1)))) / (2 / (9 * (size - 1))) ** 0.5
    at = np.array([alphabet.find(c) + 1 for c in text], float)
    halves = "".join(" " if v == 0 else "01"[int(v > size // 2)] for v in at)
    mean = 2 * halves.count("1") * (n - halves.count("1")) / n + 1
    z_runs = 99 if mean <= 2 else (halves.count("01") + halves.count("10") + 1 - mean) / ((mean - 1) * (mean - 2) / (n - 1)) ** 0.5
    away = at - at.mean()
    z_serial = (away[:-1] * away[1:]).sum() / (away**2).sum() * n**0.5 if (away**2).sum() > 0 else 99
    shift = n * (size * ic - 1)
    z_text = (chi - (size - 1) - shift) / (2 * (size - 1 + 2 * shift)) ** 0.5
    return n, n >= 20 and z_chi <= 3.29 and abs(z_runs) <= 3.29 and abs(z_serial) <= 3.29, 0.5 * math.erfc(-z_text / 2**0.5)


def test_battery_and_discovery_control_by_brute_force(spark):
    """Every run's tests, the step-up rule over all runs of a class of length, and the spans that come of it."""
    rng = random.Random(14)
    sets = ["0123456789abcdef", "0123456789ABCDEF", *(a for a, _ in secrets.ALPHABETS.values()), "abcde=", "etaoin-shrdlu_ETAOIN", "0123456789", "="]
    run = lambda: "".join(rng.choices(rng.choice(sets), k=rng.choice([1, 15, 20, 21, 40, 64, 70, 128, 200])))
    texts = [" ".join(rng.choice([run, lambda: "words " * 3, lambda: "token: " + run()])() for _ in range(rng.randint(1, 5))) for _ in range(250)]
    texts += ["=" * 40, "+" + "=" * 30, "-" * 25, "_" * 30 + "=" * 9, "title\n" + "=" * 20 + "\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    runs = [(k, m.start(), m.end(), *slow_battery(m[0])) for k, t in enumerate(texts) for m in re.finditer(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", t)]
    tested = {(r.doc_id, x["start"]): x for r in secrets.with_candidates(docs).select("doc_id", "_secret_runs").collect() for x in r["_secret_runs"]}
    assert sorted(tested) == sorted((k, a) for k, a, *_ in runs) and sum(r[4] for r in runs) > 100
    for k, a, b, n, fair, p in runs:
        x = tested[k, a]
        assert (x["stop"], x["length"], x["random"]) == (b, n, fair) and x["p"] == pytest.approx(p, rel=2e-3, abs=2e-7)
    by_class = defaultdict(list)
    for k, a, b, n, fair, _ in runs:
        if fair:
            at = math.floor(20 * min(30, -math.log10(max(tested[k, a]["p"], 1e-30))))
            by_class[sum(n >= low for low in (20, 32, 64, 128))].append((at, k, a, b))
    want = {k: [tuple(x.split(":")) for x in base_spans(t).split(",") if x] for k, t in enumerate(texts)}
    more = defaultdict(list)
    for own in by_class.values():
        least = min((at for at, *_ in own if 10 ** (-at / 20) <= 0.01 * sum(o[0] >= at for o in own) / len(own)), default=10**9)
        for at, k, a, b in own:
            if at >= least and not any(int(x) < b and a < int(y) for _, x, y in want[k]):
                more[k].append(("random", str(a), str(b)))
    kinds = ("assign", "access", "hex", "random")
    for r in secrets.find_secrets(docs).select("doc_id", secrets.written(F.col("spans")).alias("spans")).collect():
        assert r.spans == ",".join(map(":".join, sorted(want[r.doc_id] + more[r.doc_id], key=lambda x: (int(x[1]), kinds.index(x[0])))))
    assert sum(map(len, more.values())) > 20


def test_encoding_round_trip_with_small_chunks(spark, odd):
    model = sentencepiece.load_model()
    whole = {(r.doc_id, r.text_sha256): list(r.ids) for r in sentencepiece.encode_texts(odd, model, check=True).collect() if r.round_trip}
    rows = sentencepiece.encode_texts(odd, model, chunk=50, check=True).collect()
    assert len(rows) == len(odd_rows()) and all(r.round_trip for r in rows)
    assert {(r.doc_id, r.text_sha256): list(r.ids) for r in rows} == whole
    texts = {hashlib.sha256((r[1] or "").encode()).hexdigest(): r[1] or "" for r in odd_rows()}
    assert all(r.decoded == texts[r.text_sha256] for r in sentencepiece.decode_ids(sentencepiece.encode_texts(odd, model), model).collect())


def test_near_duplicates_of_the_pipeline_keep_one(spark, odd):
    kept = simhash.drop_near_duplicates(spark, odd, "")
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 6, 8, 10] and ids.count(None) == 2


def test_random_runs_of_every_alphabet(spark):
    """Uniform runs pass the battery at every length; those long enough to be told from text are reported."""
    rng = random.Random(11)
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    alphabets = [lower + digits, upper + digits, lower + "234567", upper + "234567", lower + upper + digits, lower + upper + digits + "+/"]
    cases = [(a, n) for a in range(len(alphabets)) for n in (20, 32, 64, 100, 128, 256)]
    rows = [(k, "key " + "".join(rng.choices(alphabets[a], k=n)) + " end") for k, (a, n) in enumerate(cases) for _ in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    passed, found = defaultdict(int), defaultdict(int)
    for r in secrets.with_candidates(docs).select("doc_id", F.exists("_secret_runs", lambda x: x["random"]).alias("random")).collect():
        passed[r.doc_id] += r.random
    for r in secrets.find_secrets(docs).collect():
        found[r.doc_id] += len(r.spans) > 0
    assert all(passed[k] >= 17 for k in range(len(cases))), {cases[k]: n for k, n in passed.items()}
    assert all(found[k] >= 17 for k, (_, n) in enumerate(cases) if n >= 100), {cases[k]: n for k, n in found.items()}


def copies_of_one_text(rng, word):
    """Near copies of a base with changes of their own, of which some reach the similarity only by way of others."""
    base = [word() for _ in range(80)]
    rows = [list(base)]
    for k in range(60):
        other = list(rows[rng.randrange(len(rows))] if k % 3 == 0 else base)
        for at in rng.sample(range(80), rng.choice([1, 1, 2, 3, 4])):
            other[at] = word()
        rows.append(other)
    return [" ".join(r) for r in rows]


@pytest.mark.parametrize("most", [500_000, 0])
def test_near_copies_of_the_pipeline_by_brute_force(spark, most):
    """With one side of the joins on texts broadcast, and with both shuffled."""
    rng = random.Random(12)
    word = lambda: "w" + str(rng.randrange(10**9))
    rows = [(1_000 + k, t) for k, t in enumerate(copies_of_one_text(rng, word))]
    for k in range(60):
        base = [word() for _ in range(100)]
        rows.append((3 * k, " ".join(base)))
        for n, key in ((1, 3 * k + 1), (rng.choice([2, 3, 6]), 3 * k + 2 if k % 2 else None)):
            other = list(base)
            for at in rng.sample(range(100), n):
                other[at] = word()
            rows.append((key, " ".join(other)))
    rows += [(None, a) for a in ("x y z", "X y  z", "x y q")]
    rows += [(7, "unlike text under an id that is there"), (7, "unlike text under an id that is there"), (None, "x y z")]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.lower().split() for _, t in rows)]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    want = [min((r[0] for r, x in zip(rows, root, strict=True) if x == k and r[0] is not None), default=None) for k in set(root)]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, `a.b` int").withColumn("_file", F.lit("clash"))
    out = simhash.drop_near_duplicates(spark, docs, "", most)
    kept = [r.doc_id for r in out.collect()]
    order = lambda ids: sorted(ids, key=lambda i: (i is None, i))
    assert out.columns == docs.columns and order(kept) == order(want)


def test_near_copies_meet_by_their_simhash(spark):
    """Without any bands, sets whose fingerprints differ in three bits at most are one group if they are similar; equal fingerprints alone prove nothing."""
    rng = random.Random(21)
    texts = []
    for _ in range(30):
        base = ["w" + str(rng.randrange(10**9)) for _ in range(700)]
        other = list(base)
        other[350] = "changed"
        texts += [" ".join(base), " ".join(other)]
    docs = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    sketched = simhash.sketches(docs, simhash.STAGE_SHINGLE)
    rows = simhash.stored(sketched.withColumn("bands", F.array().cast("array<long>")))
    root = {r.fp: r.root for r in simhash.similar_groups(rows, docs, ["row"]).collect()}
    sets = [np.unique(simhash.shingle_hashes(t, simhash.STAGE_SHINGLE)) for t in texts]
    prints = [simhash.simhash_of(x) for x in sets]
    linked = [(k, k + 1) for k in range(0, 60, 2) if (prints[k] ^ prints[k + 1]).bit_count() <= 3]
    assert 5 < len(linked) and len(root) == 2 * len(linked)
    assert all(root[simhash.set_id(sets[a])] == root[simhash.set_id(sets[b])] for a, b in linked)
    alike = simhash.stored(rows.withColumn("print", F.lit(5).cast("long")))
    assert len({r.root for r in simhash.similar_groups(alike, docs, ["row"]).collect()}) <= 1


def slow_kneser_ney(texts, least):
    """chars -> probability under interpolated Kneser-Ney of a language's texts, worked out place by place; and the letters."""
    four = defaultdict(int)
    for t in texts:
        codes = langid.codes(t).tolist()
        for i in range(len(codes) - 3):
            four[tuple(codes[i : i + 4])] += 1
    by_order = {4: dict(four)}
    for order in (3, 2, 1):
        by_order[order] = defaultdict(int)
        for g in by_order[order + 1]:
            by_order[order][g[1:]] += 1

    def p(g, wide):
        if not g:
            return 1 / (4 * wide)
        counts = by_order[len(g)]
        n1, n2 = (sum(v == k for v in counts.values()) for k in (1, 2))
        discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.75
        kept = {x: v for x, v in counts.items() if x[:-1] == g[:-1] and (len(g) < 4 or v >= least)}
        total = sum(v for x, v in counts.items() if x[:-1] == g[:-1])
        if not kept:
            return p(g[1:], wide)
        left = 1 - sum(v - discount for v in kept.values()) / total
        return (max(kept[g] - discount, 0) / total if g in kept else 0) + left * p(g[1:], wide)

    return p, {g[0] for g in by_order[1]}


@pytest.mark.parametrize("least", [1, 2])
def test_kneser_ney_against_a_slow_model(spark, least):
    texts = {"a": ["abra cadabra abracadabra", "cadabra abra dab", None, ""], "b": ["hocus pocus locus", "focus hocus!"]}
    rows = [(k, t, lang) for lang, own in texts.items() for k, t in enumerate(own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("fold", F.lit(2))
    tables, contexts = langid.gram_tables(langid.count_grams(docs).select("lang", "gram", "n"), least)
    model = langid.build_model(["a", "b"], [t.toPandas() for t in tables], [c.toPandas() for c in contexts])
    wide = len(model.grams[0].hashes) - 1
    for k, lang in enumerate("ab"):
        p, own = slow_kneser_ney(texts[lang], least)
        places = [c[i : i + 4] for t in ["abra hocus", "dabra cad pocus"] for c in [langid.codes(t)] for i in range(len(langid.codes(t)) - 3)]
        got = np.exp(model.position_scores(np.concatenate([langid.grams(c) for c in places]))[:, k].astype(float))
        assert got == pytest.approx([p(tuple(c.tolist()), wide) for c in places], rel=1e-4)
        for c in places:  # all next letters together, and a rest for those never seen
            assert 0.5 < sum(p((*c.tolist()[:3], x), wide) for x in own) <= 1.0001
    judged = langid.Identifier(None, [["a", "b"]], ([], [])).judge(*model.cross_entropy(["abracad", "hocus", "", None, "123 !"]))
    assert list(judged["lang"]) == ["a", "b", "und", "und", "und"] and list(judged["score"])[2:] == [0, 0, 0]


def test_languages_in_several_parts(spark):
    """With a bound that lets every language be a part of its own, the same predictions; full counts say the same within a percent."""
    at = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text", "lang")
    few = docs.filter("doc_id < 200")
    say = lambda model: {r.doc_id: (r.found.lang, round(r.found.cross_entropy or 0, 5)) for r in langid.identify_languages(few, model, "found").collect()}
    whole, parts = langid.fit_langid(docs), langid.fit_langid(docs, most_cells=1)
    assert len(whole.parts) == 1 and len(parts.parts) == len(whole.languages) > 1
    one, two, full = say(whole), say(parts), say(langid.fit_langid(docs, least=1))
    assert {k: v[0] for k, v in one.items()} == {k: v[0] for k, v in two.items()}
    assert sum(one[k][0] == full[k][0] for k in one) >= 0.99 * len(one)


def test_languages_are_calibrated_on_all_rows(spark):
    """Of 12,000 rows each counts: the map and the limits are those of a plain fit on all of them."""
    rng = np.random.default_rng(8)
    entropy = rng.gamma(9, 0.3, size=(12_000, 3))
    n = rng.integers(1, 400, 12_000)
    best, low = entropy.argmin(axis=1), entropy.min(axis=1)
    lang = np.where(rng.random(12_000) < 0.8, best, rng.integers(0, 3, 12_000))
    entropy[0], n[0], lang[0], best[0], low[0] = [97.0, 98.0, 99.0], 9, 0, 0, 97.0  # one row that no sample is sure to hold
    rows = [("abc"[lang[k]], entropy[k].tolist(), int(n[k])) for k in range(12_000)]
    found, limit = langid.calibrated(spark.createDataFrame(rows, "lang string, entropy array<double>, n long"), list("abc"))
    ahead, right = langid.evidence(entropy, n), best == lang
    order = np.argsort(ahead, kind="stable")
    plain = fit_isotonic(ahead[order], right[order].astype(float))
    at = np.quantile(ahead, np.linspace(0.02, 0.98, 30))
    assert found(at) == pytest.approx(plain(at), abs=0.03)
    for k, name in enumerate("abc"):
        assert limit[name] == pytest.approx(1.1 * np.quantile(low[right & (best == k)], 0.999), abs=1.2 / langid.GRID)
    counts = spark.createDataFrame(rows[:1] + rows[1:2] * 9000, "lang string, entropy array<double>, n long")
    assert langid.calibrated(counts.filter("lang = 'a'").filter("entropy[0] = 97.0"), list("abc"))[1]["a"] == pytest.approx(1.1 * 97)


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_with_clashing_and_dotted_columns(spark, tables, stage):
    """Columns named like the operators' own, and with dots, pass through; ids are texts; repeated rows stay rows."""
    rows = [("a", "one two three four five six", "s", 1, 7.5), ("a", "seven eight nine ten eleven twelve", "s", 2, 7.5), (None, "token=abcdefghijkl0123", None, 3, None), ("b", None, "t", 4, 1.0), ("c", "", "t", 5, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string, `m.x` int, toxicity double")
    for name in ("_file", "_row", "_position", "_secret_runs", "toxic_predicted", "fp"):
        docs = docs.withColumn(name, F.lit(name))
    got = corpus_pipeline.STAGES[stage][1](spark, docs, tables["none"])
    if stage == len(corpus_pipeline.STAGES) - 1:
        assert got.columns == ["doc_id", "n_tokens", "ids"] and got.count() == len(rows)
        return
    found = got.collect()
    assert got.columns == docs.columns and all(r["_file"] == "_file" and r["fp"] == "fp" for r in found)
    kept = {r["m.x"]: r for r in found}
    assert {1, 2, 3} <= set(kept) and kept[1]["toxicity"] == 7.5 and kept[1]["text"] == rows[0][1]
    assert ("[secret]" in kept[3]["text"]) == (corpus_pipeline.STAGES[stage][0] == "secret_scans")


def test_positions_against_a_slow_curriculum(spark):
    """Places are running sums in a fixed order, positions the roots of the integrated schedule; repeated ids share a group."""
    rng = random.Random(13)
    rows = [(None if k % 40 == 0 else k % 90, "w " * rng.randint(0, 9), rng.choice(["a", "b", "c"])) for k in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == len(rows)
    for source in "abc":
        own = sorted((r for r in got if r.source == source), key=lambda r: (r.place, r.size))
        upto = 0
        for r in own:
            assert r.place == upto and (r.taken == r.passes * r.size)
            upto += r.size
        assert upto == own[0].source_size
        for r in own:
            if r.passes:
                g, t, u = r.slope, r.position, min(1.0, r.place / r.target)
                assert (1 - g) * t + g * t * t == pytest.approx(u, abs=1e-6)


def slow_isotonic(margin, y):
    """Isotonic means by min-max formula over the distinct margins."""
    at = sorted(set(margin))
    means = [[y[k] for k in range(len(y)) if margin[k] == a] for a in at]
    mean = lambda i, j: sum(map(sum, means[i : j + 1])) / sum(map(len, means[i : j + 1]))
    return [max(min(mean(i, j) for j in range(k, len(at))) for i in range(k + 1)) for k in range(len(at))]


def test_toxicity_features_and_calibration_by_brute_force():
    weights = {"vile": 3.0, "nast~": 2.5}
    for text in ("You are vile, VILE and nastiest! br0ken", "", None, "nothing here", "you " + "x " * 9 + "vile idiot"):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        weight = [max([weights.get(k, 0.0) for k in (w, *(w[:n] + "~" for n in (4, 5, 6) if len(w) > n))]) for w in words]
        hits = [i for i, v in enumerate(weight) if v > 0]
        second = [i for i, w in enumerate(words) if w in toxicity.SECOND_PERSON]
        got = dict(zip(toxicity.FEATURES, toxicity.features(text, toxicity.Marks(weights)), strict=True))
        assert got["lexicon_hits"] == len(hits) and got["lexicon_peak"] == max(weight, default=0)
        assert got["near_second_person"] == sum(any(abs(i - j) <= toxicity.NEAR for j in second) for i in hits)
        assert got["insult_hits"] == sum(w in toxicity.INSULTS for w in words)
    rng = np.random.default_rng(4)
    margin = np.round(rng.normal(size=80), 1)
    y = (rng.random(80) < 1 / (1 + np.exp(-margin))).astype(float)
    fitted = toxicity.fit_isotonic(margin, y)
    pooled = slow_isotonic(margin.tolist(), y.tolist())
    assert len(fitted.levels) == len(set(np.round(pooled, 12)))
