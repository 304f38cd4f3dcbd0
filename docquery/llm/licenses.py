"""License scans: an exact set-similarity join of text blocks with license templates.

A template is a license notice; its table (label, text, names) is joined with every block of
every text. A block is a window of words, line ends or not: for a template of w words, every run
of SLACK w words. It meets the template if it holds at least `threshold` of its distinct words,
all the template's names among them (what tells a short notice from that of another license). The
join is exact and cheap because of filters that can't lose a match:

* prefix: order all words by how many texts of the corpus hold them, rarest first. A block
  with t of a template's n words must hold one of the template's first n - t + 1; only windows
  around those are looked at.
* length: the text, and the window, must have t distinct words of it at all.
* position: if the rarest word of the template in the text is its i-th, at most n - i can be common.

Windows of one template that overlap are one match, with the best containment. Where matches of
several templates overlap, those of the greatest containment give their labels: wordings of
related licenses share most words. The table of templates is joined in each task: it is a
parameter, of MAX_TEMPLATES rows at most, and no text is shuffled. Phrases are counted beside it:
places where a phrase's words stand consecutively.

Defined results: a null text is an empty one, with no words and score 0; rows are kept one for
one, repeated ones too; score is the greatest containment of any template in any block (1 where a
phrase stands). Very long texts are scanned whole. doc_id may be of any type; other columns are
left aside, so their names don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.llm.common import table

#: Phrase -> label.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notices of common licenses, in their authors' usual wording: label, text, words that a block must hold.
TEMPLATES = [
    ("mit", "Released under the MIT License.", "mit"),
    ("mit", "Licensed under the MIT license", "mit"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ""),
    ("apache-2", "Licensed under the Apache License, Version 2.0", "apache"),
    ("apache-2", "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache"),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2.", "general 2"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3.", "general 3"),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "2"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "3"),
    ("lgpl", "licensed under the GNU Lesser General Public License", "lesser"),
    ("agpl-3", "licensed under the GNU Affero General Public License, version 3", "affero"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ""),
    ("mpl-2", "subject to the terms of the Mozilla Public License, version 2.0", "mozilla"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ""),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "organization"),
    ("unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0.", "cc nc"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0.", "cc sa"),
    ("cc0", "released into the public domain under CC0 1.0", "cc0"),
]
THRESHOLD = 0.8
#: Words of a block per word of the template it is held against.
SLACK = 1.25
#: Templates that may be joined in a task: some hundred bytes each.
MAX_TEMPLATES = 10_000

#: Bytes of a text -> the same with A-Z lowered and all that is neither an ASCII letter or digit nor beyond ASCII as a space.
_FOLDED = bytes(b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLDED).split()


def needed(n: int, threshold: float) -> int:
    """The least number of n words that makes a containment of `threshold`."""
    return max(1, math.ceil(threshold * n - 1e-9))


def places(folded: bytes, phrase: bytes) -> list[int]:
    """Starts, in words, of the phrase in words joined by single spaces with one at each end."""
    out, at, seen, n = [], folded.find(phrase), 0, 0
    while at >= 0:
        n += folded.count(b" ", seen, at)  # from the place before on, so a text full of phrases stays linear
        out.append(n)
        seen, at = at, folded.find(phrase, at + 1)
    return out


def word_frequencies(docs: DataFrame, words: set[str]) -> dict[str, int]:
    """In how many texts each of the given words stands."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = {w.encode() for w in words}
        total = dict.fromkeys(sorted(wanted), 0)
        for batch in batches:
            for text in batch["text"]:
                for w in wanted.intersection(words_of(text or "")):
                    total[w] += 1
        yield pd.DataFrame({"word": [w.decode() for w in total], "n": np.array(list(total.values()), np.int64)})

    rows = docs.select("text").mapInPandas(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {w: 0 for w in words} | {r.word: r.n for r in rows}


@dataclass(frozen=True)
class Template:
    label: str
    ranks: list[int]  # of its distinct words, rarest first
    least: int  # distinct words that a match holds
    width: int  # words of a block
    names: frozenset[int]


class Matcher:
    """The table of templates, laid out for the join: per prefix word the templates and its place in them."""

    def __init__(self, templates: list[tuple[str, str, str]], frequency: dict[str, int], threshold: float):
        sets = [[w.decode() for w in words_of(text)] for _, text, _ in templates]
        vocabulary = sorted({w for s in sets for w in s}, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w.encode(): k for k, w in enumerate(vocabulary)}
        rank = lambda words: sorted({self.rank[w.encode()] for w in words})
        self.templates = [
            Template(label, rank(s), needed(len(set(s)), threshold), math.ceil(SLACK * len(s)), frozenset(rank(names.split()))) for (label, _, names), s in zip(templates, sets, strict=True)
        ]
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for k, t in enumerate(self.templates):
            for i, r in enumerate(t.ranks[: len(t.ranks) - t.least + 1]):
                self.prefix.setdefault(r, []).append((k, i))
        self.words = frozenset(self.rank)
        self.starters = frozenset(w for w, r in self.rank.items() if r in self.prefix)

    def scan(self, words: list[bytes]) -> list[tuple[int, int, int, float]]:
        """(start, stop, template, containment) of all matches in the words of a whole text; start and stop in words."""
        if self.starters.isdisjoint(words):
            return []
        places: dict[int, list[int]] = {}
        for at, w in enumerate(words):
            if w in self.words:
                places.setdefault(self.rank[w], []).append(at)
        held, first, out = set(places), {}, []
        for r in sorted(held):
            for k, i in self.prefix.get(r, ()):
                first.setdefault(k, i)  # ranks rise, so this is the rarest word that the text has
        for k, i in first.items():
            t = self.templates[k]
            if len(t.ranks) - i >= t.least and t.names <= held and len(held.intersection(t.ranks)) >= t.least:
                out.extend((start, stop, k, n / len(t.ranks)) for start, stop, n in self.windows(t, places))
        return sorted(out)

    def windows(self, t: Template, places: dict[int, list[int]]) -> list[tuple[int, int, int]]:
        """(first word, end, distinct words) of the stretches of overlapping blocks that meet a template."""
        prefix = sorted(at for r in t.ranks[: len(t.ranks) - t.least + 1] for at in places.get(r, ()))
        events = sorted((at, r) for r in t.ranks for at in places.get(r, ()))
        inside: dict[int, int] = {}  # words of the block -> how often
        out: list[tuple[int, int, int]] = []
        low, near = 0, 0
        for at, r in events:
            inside[r] = inside.get(r, 0) + 1
            while events[low][0] <= at - t.width:
                gone = events[low][1]
                inside[gone] -= 1
                if not inside[gone]:
                    del inside[gone]
                low += 1
            while near < len(prefix) and prefix[near] < events[low][0]:
                near += 1
            if near == len(prefix) or prefix[near] > at or len(inside) < t.least or not t.names <= inside.keys():
                continue
            start = events[low][0]
            if out and start < out[-1][1]:
                out[-1] = (out[-1][0], at + 1, max(out[-1][2], len(inside)))
            else:
                out.append((start, at + 1, len(inside)))
        return out


def best_labels(matches: list[tuple[int, int, int, float]], templates: list[Template]) -> set[str]:
    """Labels of the matches (sorted by start) that no overlapping match of a greater containment covers."""
    beaten = [False] * len(matches)
    active: list[int] = []  # one a template at most, as matches of one template don't overlap
    for n, (start, _, _, share) in enumerate(matches):
        active = [o for o in active if matches[o][1] > start]
        for o in active:
            if matches[o][3] > share:
                beaten[n] = True
            elif matches[o][3] < share:
                beaten[o] = True
        active.append(n)
    return {templates[k].label for (_, _, k, _), lost in zip(matches, beaten, strict=True) if not lost}


def scan_licenses(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str, str]] | DataFrame = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """Per row of docs (doc_id, text): n_words, phrase places and labels, template matches and score.

    templates: rows (label, text, names). matches is an array of all (start, stop, label,
    containment) at the threshold, start and stop counting words from 0.
    """
    if isinstance(templates, DataFrame):
        templates = [tuple(r) for r in templates.select("label", "text", "names").limit(MAX_TEMPLATES + 1).collect()]
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    matcher = Matcher(templates, word_frequencies(docs, {w.decode() for _, t, _ in templates for w in words_of(t)}), threshold)
    wanted = [(b" " + b" ".join(words_of(p)) + b" ", label) for p, label in phrases.items()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                words = words_of(text or "")
                folded = b" " + b" ".join(words) + b" "
                found = [(label, at) for phrase, label in wanted if (at := places(folded, phrase))]
                matches = matcher.scan(words)
                starts = [x for _, at in found for x in at]
                base = {label for label, _ in found}
                labels = base | best_labels(matches, matcher.templates)
                score = 1.0 if found else max((c for *_, c in matches), default=0.0)
                out.append((
                    len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score,
                    [{"start": a, "stop": b, "label": matcher.templates[k].label, "containment": c} for a, b, k, c in matches],
                ))
            got = pd.DataFrame(out, columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"])
            got[["first_word", "last_word"]] = got[["first_word", "last_word"]].astype("Int64")
            got.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield got

    rest = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<start: int, stop: int, label: string, containment: double>>"
    return docs.select("doc_id", "text").mapInPandas(run, T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(rest)]))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
