"""The parts of the operators that need no Spark, against plain versions."""

import itertools
import random
import time

import numpy as np
import pytest
import xxhash

from docquery.llm import langid, licenses, sentencepiece, simhash
from docquery.llm.gbt import fit_isotonic, fit_trees
from docquery.llm.quality import capitals_of, repeated_words, statistics
from docquery.llm.sharding import hilbert_index


def test_trees_learn_and_keep_their_sign():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 3))
    y = (x[:, 0] + 0.5 * np.sin(5 * x[:, 1]) + rng.normal(scale=0.3, size=4000) > 0).astype(float)
    model = fit_trees(x, y, monotone={0: 1, 1: -1})
    assert ((model.probability(x) > 0.5) == y).mean() > 0.85
    line = np.zeros((50, 3))
    for f, sign in ((0, 1), (1, -1)):
        for base in (-1.0, 0.0, 1.0):
            at = line + base
            at[:, f] = np.linspace(-3, 3, 50)
            assert (sign * np.diff(model.margin(at)) >= -1e-12).all()
    assert len(fit_trees(np.zeros((0, 3)), np.zeros(0)).probability(np.zeros((2, 3)))) == 2
    assert fit_trees(x, y).margin(np.zeros((0, 3))).shape == (0,)


def test_isotonic_rises():
    rng = np.random.default_rng(2)
    m = rng.normal(size=500)
    f = fit_isotonic(m, (rng.random(500) < 1 / (1 + np.exp(-m))).astype(float))
    assert (np.diff(f(np.linspace(-4, 4, 99))) >= 0).all() and 0 < f(np.array([0.0]))[0] < 1
    assert 0.4 < fit_isotonic(np.zeros(0), np.zeros(0))(np.array([0.0]))[0] < 0.6


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", ["", None, " \t\n", "One", "one TWO", "a b c d e f a b c", "É ÉE x y z", "w " * 500])
def test_fingerprints(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_golay_keys_miss_no_pair():
    rng = random.Random(5)
    assert ((simhash.error_patterns() >= 0).sum(axis=1) == np.where(simhash.error_patterns()[:, 1] >= 0, 6, 1)).all()
    x = np.array([rng.getrandbits(64) for _ in range(1500)], dtype=np.uint64)
    y = np.array([int(v) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for v in x], dtype=np.uint64)
    probe, index = simhash.keys(x, False), simhash.keys(y, True)
    sets = []
    for rows, keys in (probe, index):
        own = [set() for _ in x]
        for r, k in zip(rows.tolist(), keys.tolist(), strict=True):
            own[r].add(k)
        sets.append(own)
    assert all(a & b for a, b in zip(*sets, strict=True))


def test_license_filters_lose_no_match():
    """Words covered by blocks of each template, against every block of every text."""
    rng = random.Random(3)
    m = licenses.Matcher(licenses.TEMPLATES, {"the": 900, "license": 50, "under": 80, "mit": 3}, 0.8)
    vocabulary = sorted({w for _, t, _ in licenses.TEMPLATES for w in licenses.words_of(t)}) + [b"zebra", b"house"]
    for _ in range(150):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            t = licenses.words_of(rng.choice(licenses.TEMPLATES)[1])
            words += [w for w in t if rng.random() < 0.9] + rng.choices([b"zebra", b"house"], k=rng.randint(0, 20))
        want = {}
        for k, (_, text, names) in enumerate(licenses.TEMPLATES):
            own, width = set(licenses.words_of(text)), -(-5 * len(licenses.words_of(text)) // 4)
            for i in range(len(words)):
                block = set(words[i : i + width])
                if len(own & block) >= licenses.needed(len(own), 0.8) and {n.encode() for n in names.split()} <= block:
                    want[k] = max(want.get(k, 0), len(own & block) / len(own))
        got = {}
        for _, _, k, c in m.scan(words):
            got[k] = max(got.get(k, 0), c)
        assert got == want


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated\ndocumentation files", {"mit"}),
        ("# Licensed under the Apache License,\n# Version 2.0 (the License)", {"apache-2"}),
        (licenses.TEMPLATES[8][1].replace(" ", "\n * "), {"gpl-3"}),
        ("released under the BSD license", set()),
        ("Licensed under CC BY 4.0", set()),
        ("Licensed under CC BY-NC 4.0. " + "x " * 40 + licenses.TEMPLATES[11][1], {"cc-by-nc", "bsd"}),
        ("", set()),
    ],
)
def test_licenses_in_usual_wording(text, labels):
    m = licenses.Matcher(licenses.TEMPLATES, {}, 0.8)
    assert licenses.best_labels(m.scan(licenses.words_of(text)), m.templates) == labels


def test_repeats():
    def slow(words):
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
        return len(covered)

    rng = random.Random(4)
    for n in range(0, 40):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(n)]
        assert repeated_words(words) == slow(words)
    assert statistics("a é\n\n a é\nb #")[0] == [6, 6, 1, 0, 0]
    assert statistics("x y\nx y\n \nx y")[0][3] == 2


def test_capitals_of_any_script_at_a_bounded_cost():
    text = "Größe ÄÖ Ωmega Ж \U00010400\ud800 x" + chr(0x1F130) + chr(0x2FFFF)
    assert capitals_of(text, text.encode("utf-8", "surrogatepass")) == sum(map(str.isupper, text))
    began = time.process_time()
    statistics("Über den Wolken muss die Freiheit wohl grenzenlos sein.\n" * 60_000)
    assert time.process_time() - began < 3


def test_hilbert_curve_is_a_curve():
    points = np.array(list(itertools.product(range(8), repeat=3)))
    order = points[np.argsort(hilbert_index(points, 3))]
    assert sorted(hilbert_index(points, 3)) == list(range(512)) and (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


@pytest.fixture(scope="module")
def model():
    return sentencepiece.load_model()


def test_segmentation_is_best_by_brute_force(model):
    small = sentencepiece.PieceModel({p: model.pieces[p] for p in ["▁", "a", "b", "▁a", "ab", "ba", "bab"] if p in model.pieces} | {"aab": (-1.0, 9999)}, model.spelled, model.byte_ids, True, 77, {"▁": 2, "a": 3, "b": 3})

    def best(text):
        if not text:
            return 0.0
        return max((small.pieces[text[:k]][0] if text[:k] in small.pieces else small.unknown) + best(text[k:]) for k in range(1, min(3, len(text)) + 1) if k == 1 or text[:k] in small.pieces)

    for letters in itertools.product("ab", repeat=6):
        text = small.normal("".join(letters))
        assert small.forward(text, 0, len(text), len(text))[0][-1] == pytest.approx(best(text))


def test_chunks_agree_with_the_whole(model):
    rng = random.Random(6)
    score = {k: s for s, k in model.pieces.values()}
    for _ in range(60):
        text = "".join(rng.choice(["the ", "  ", "a", "ing", "\n", "é", "日本", "▁", "tion", ". ", "xyz"]) for _ in range(rng.randint(1, 50)))
        whole = model.encode_all([text])[0].tolist()
        assert model.decode(whole) == text and whole == model.encode(text)
        for size in (1, 3, 7, 20):
            parts = list(sentencepiece.chunked(model, text, size))
            states = sentencepiece.border_states(np.stack([model.transfer(b, a) for _, b, a in parts]))
            ids = [i for (_, b, a), s, e in zip(parts, states[:-1], states[1:], strict=True) for i in model.backtrace(b, a, s, e)]
            assert model.decode(ids) == text
            assert sum(score.get(i, 0) for i in ids) == pytest.approx(sum(score.get(i, 0) for i in whole))


def test_never_worse_than_the_library(model):
    spm = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(sentencepiece.MODEL_FILE, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    library = spm.SentencePieceProcessor(model_proto=proto.SerializeToString())
    for text in ("the quick brown fox", "tionen atheth", "über den Wolken", "x y z"):
        assert sum(map(library.get_score, model.encode(text))) >= sum(map(library.get_score, library.encode(text))) - 1e-3


def test_grams_by_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    texts = ["", None, "1", "a", "a1", "1a", "..ab  cd..", "x" * 30, "\U00010400\ud800é ß  ", *("".join(rng.choice(list("ab ,É1\U00010400"), 40)) for _ in range(50))]
    for block in (1, 2, 7, 1 << 17):
        monkeypatch.setattr(langid, "BLOCK", block)
        for text in texts:
            code = langid.codes(text)
            want = langid.grams(code) if len(code) else np.zeros(0, np.uint64)
            assert np.array_equal(np.concatenate([np.zeros(0, np.uint64), *langid.packed(text)]), want)
