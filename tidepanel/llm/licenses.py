"""Licence notices in documents, paragraph by paragraph.

A multinomial logistic regression on word n-grams tells licence families apart and from ordinary
text. It is trained on notices written after templates, with words changed and others around them,
and on paragraphs of a bounded sample of the corpus. Its probabilities are calibrated on examples
that it was not trained on. A passage counts as a notice only if it also repeats most of one of
its family's templates.

A paragraph is a run of lines up to a blank one. Its passages are its single lines and, as notices are
often wrapped, the runs of lines that together repeat most of a template.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tidepanel.llm.common import with_arrow_columns

UNKNOWN = "unknown"

#: notices as they are commonly written
TEMPLATES = {
    "Apache-2.0": (
        "licensed under the apache license version 2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at apache.org",
        "distributed under the apache 2.0 license",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind",
        "apache license version 2.0 january 2004 terms and conditions for use reproduction and distribution",
    ),
    "BSD-3-Clause": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "use of this source code is governed by a bsd style license",
        "released under the bsd 3 clause license",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties",
    ),
    "CC-BY-4.0": (
        "licensed under cc by 4.0",
        "this work is licensed under a creative commons attribution 4.0 international license",
    ),
    "CC-BY-NC-4.0": (
        "licensed under cc by nc 4.0",
        "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
    ),
    "CC-BY-SA-4.0": (
        "licensed under cc by sa 4.0",
        "this work is licensed under a creative commons attribution sharealike 4.0 international license",
        "text is available under the creative commons attribution sharealike license",
    ),
    "CC0-1.0": (
        "this work is dedicated to the public domain under cc0 1.0",
        "to the extent possible under law the author has waived all copyright and related rights to this work",
    ),
    "GPL-2.0": (
        "licensed under the gnu general public license version 2",
        "this program is free software you can redistribute it under the terms of the gnu general public license version 2",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
        "gnu general public license version 2 june 1991 copyright c 1989 1991 free software foundation",
    ),
    "GPL-3.0": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it under the terms of the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        "gnu general public license version 3 29 june 2007 copyright c 2007 free software foundation",
    ),
    "LGPL-3.0": (
        "licensed under the gnu lesser general public license version 3",
        "this library is free software you can redistribute it under the terms of the gnu lesser general public license",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    ),
    "MIT": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "licensed under the mit license",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability",
    ),
    "MPL-2.0": (
        "this source code form is subject to the terms of the mozilla public license version 2.0",
        "licensed under the mozilla public license version 2.0",
    ),
    "Proprietary": (
        "all rights reserved no part of this publication may be reproduced without prior written permission",
        "copyright all rights reserved",
    ),
}

#: ordinary sentences with words of notices
NEAR_MISSES = (
    "a license is required to drive a car in this country",
    "the version of the story that was released under pressure is free of charge",
    "any person obtaining permission may use the library in the public domain of the city",
    "the apache helicopter was licensed for use under the general terms",
    "students of mit released a copy of the work to the public",
    "the following conditions are met when the source is free and the license is lost",
    "the copyright law of the country reserves rights to the author of the work",
    "creative people in the commons work under an international attribution",
    "the mozilla foundation and the gnu project distribute free software to the public",
)

#: share of a template's word pairs that a passage must repeat
CONFIRM = 0.75

#: ids of documents whose paragraphs stand for ordinary text, and distinct kinds of paragraph taken from them
SAMPLE_DOCS, SAMPLE_KINDS = 2000, 4000

#: training notices of each family
NOTICES = 150

WORD = re.compile(r"[a-z]+|\d+(?:\.\d+)*")
LINE = re.compile(r"[^\r\n]+")
GRAMS = (1, 2, 3)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _grams(words: list[str], sizes=GRAMS) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + n]) for n in sizes for i in range(len(words) - n + 1)}


class Vocabulary:
    """Numbers of the n-grams that templates and near misses have."""

    def __init__(self) -> None:
        texts = [t for ts in TEMPLATES.values() for t in ts] + list(NEAR_MISSES)
        grams = sorted({g for t in texts for g in _grams(words_of(t))}, key=lambda g: (len(g), g))
        self.number = {g: i for i, g in enumerate(grams)}
        self.single = {g[0] for g in grams if len(g) == 1}
        #: distinct word pairs of each template, and the templates of each pair
        self.pairs = [_grams(words_of(t), (2,)) for ts in TEMPLATES.values() for t in ts]
        self.templates: dict[tuple[str, ...], list[int]] = {}
        for i, pairs in enumerate(self.pairs):
            for pair in pairs:
                self.templates.setdefault(pair, []).append(i)

    def features(self, words: list[str]) -> list[int]:
        """Sorted numbers of the n-grams of a paragraph that the vocabulary has."""
        single, number, found = self.single, self.number, set()
        run: list[str] = []
        for w in words:
            if w in single:
                run.append(w)
                for n in GRAMS[: len(run)]:
                    if (i := number.get(tuple(run[-n:]))) is not None:
                        found.add(i)
            elif run:
                run = []
        return sorted(found)


@dataclass
class Model:
    vocabulary: Vocabulary
    families: list[str]
    weights: np.ndarray  #: n-grams x families, the last row is the constant
    temperature: float = 1.0

    def chances(self, features: list[int]) -> np.ndarray:
        logits = (self.weights[features].sum(0) + self.weights[-1]) / self.temperature
        e = np.exp(logits - logits.max())
        return e / e.sum()


def template_similarity(words: list[str], family: str) -> float:
    """The largest share of a template's word pairs that the paragraph has."""
    have = _grams(words, (2,))
    wanted = [_grams(words_of(t), (2,)) for t in TEMPLATES.get(family, ())]
    return max((len(w & have) / len(w) for w in wanted), default=0.0)


def _notices(rng: random.Random) -> list[tuple[str, list[str]]]:
    """Written notices: words now and then lost or changed, ordinary words before and after."""
    ordinary = [w for t in NEAR_MISSES for w in words_of(t)]
    out = []
    for family, templates in TEMPLATES.items():
        for n in range(NOTICES):
            words = words_of(templates[n % len(templates)])
            words = [rng.choice(ordinary) if rng.random() < 0.03 else w for w in words if rng.random() > 0.03]
            around = [[f"x{rng.random()}"[:4] if rng.random() < 0.7 else rng.choice(ordinary) for _ in range(rng.choice((0, 0, 3, 10, 40)))] for _ in range(2)]
            out.append((family, around[0] + words + around[1]))
    return out


def _train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, classes: int, steps: int = 300, ridge: float = 2e-4) -> np.ndarray:
    """Multinomial logistic regression by gradient descent with momentum."""
    a = np.c_[x, np.ones(len(x), np.float32)]
    target = np.eye(classes, dtype=np.float32)[y]
    w, speed = np.zeros((a.shape[1], classes), np.float32), 0.0
    weight = (weight / weight.sum()).astype(np.float32)[:, None]
    for _ in range(steps):
        logits = a @ w
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(1, keepdims=True)
        speed = 0.9 * speed - 2.0 * (a.T @ (weight * (p - target)) + ridge * w)
        w = w + speed
    return w


def ordinary_paragraphs(docs: DataFrame, vocabulary: Vocabulary, key: str, text: str) -> list[tuple[list[int], int]]:
    """Kinds of paragraph (their features) of a bounded sample of documents, with their counts. Paragraphs
    that repeat a template are left out."""
    ids = docs.select(F.col(f"`{key}`").alias("id")).where("id IS NOT NULL").distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)
    sample = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(ids), "id")

    def make():
        def compute(texts: list) -> list[pa.Array]:
            out = []
            for t in texts:
                lines = [words_of(m[0]) for m in LINE.finditer(t or "")]
                out.append([vocabulary.features(w) for w in lines if max(template_similarity(w, f) for f in TEMPLATES) < 0.5])
            return [pa.array(out, pa.list_(pa.list_(pa.int32())))]

        return compute

    kinds = with_arrow_columns(sample, "text", [StructField("kinds", ArrayType(ArrayType(IntegerType())))], make)
    counted = kinds.select(F.explode("kinds").alias("kind")).groupBy("kind").count()
    rows = counted.orderBy(F.xxhash64("kind"), "kind").limit(SAMPLE_KINDS).collect()
    return [(list(r["kind"]), r["count"]) for r in rows]


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 11) -> Model:
    """A classifier from templates and a bounded sample of ``docs``."""
    vocabulary = Vocabulary()
    families = [*TEMPLATES, UNKNOWN]
    examples = [(families.index(f), vocabulary.features(w), 1.0) for f, w in _notices(random.Random(seed))]
    unknown = families.index(UNKNOWN)
    examples += [(unknown, vocabulary.features(words_of(t)), 20.0) for t in NEAR_MISSES]
    examples.append((unknown, [], 100.0))
    examples += [(unknown, kind, float(min(n, 20))) for kind, n in ordinary_paragraphs(docs, vocabulary, key, text)]
    x = np.zeros((len(examples), len(vocabulary.number)), np.float32)
    for i, (_, features, _) in enumerate(examples):
        x[i, features] = 1
    y, weight = np.array([e[0] for e in examples]), np.array([e[2] for e in examples])
    aside = np.arange(len(examples)) % 4 == 3
    model = Model(vocabulary, families, _train(x[~aside], y[~aside], weight[~aside], len(families)))
    logits = np.c_[x[aside], np.ones(aside.sum(), np.float32)] @ model.weights

    def loss(temperature: float) -> float:
        z = logits / temperature
        z = z - z.max(1, keepdims=True)
        return float((weight[aside] * (np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), y[aside]])).sum())

    model.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss)
    return model


HIT = StructType(
    [
        StructField("paragraph", IntegerType()),
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("family", StringType()),
        StructField("probability", DoubleType()),
        StructField("similarity", DoubleType()),
        StructField("confirmed", BooleanType()),
    ]
)
HIT_ARROW = pa.struct(
    [
        ("paragraph", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("family", pa.string()),
        ("probability", pa.float64()), ("similarity", pa.float64()), ("confirmed", pa.bool_()),
    ]
)


def paragraphs(text: str) -> list[list[tuple[int, int, list[str]]]]:
    """Runs of lines that hold more than white space, each line as its start, its end and its words."""
    out: list[list[tuple[int, int, list[str]]]] = []
    open_, end = False, 0
    for m in LINE.finditer(text):
        # two line ends in a row are a blank line
        if text.count("\n", end, m.start()) > 1 or text.count("\r", end, m.start()) > 1:
            open_ = False
        end = m.end()
        if m[0].isspace():
            open_ = False
            continue
        if not open_:
            out.append([])
        out[-1].append((m.start(), m.end(), words_of(m[0])))
        open_ = True
    return out


def wrapped_runs(vocabulary: Vocabulary, lines: list[list[str]]) -> list[tuple[int, int]]:
    """Runs of two or more lines, as first and last line, that repeat ``CONFIRM`` of a template.

    For each template the word pairs of it are read in their order. As soon as those of a stretch suffice, the stretch is
    cut at its beginning as far as they still do, then grown by lines next to it that add pairs; the search
    goes on behind it. One pass over the words; the next word of a line's last one is the first of the line after.
    """
    seen: dict[int, list[tuple[int, int, tuple[str, str]]]] = {}
    last, last_line = None, 0
    for i, words in enumerate(lines):
        for w in words:
            if last is not None:
                pair = (last, w)
                for t in vocabulary.templates.get(pair, ()):
                    seen.setdefault(t, []).append((last_line, i, pair))
            last, last_line = w, i
    runs = set()
    for t, places in seen.items():
        need = CONFIRM * len(vocabulary.pairs[t])
        if len({p for _, _, p in places}) < need:
            continue
        have: dict[tuple[str, str], int] = {}
        first = at = floor = 0
        while at < len(places):
            pair = places[at][2]
            have[pair] = have.get(pair, 0) + 1
            at += 1
            if len(have) < need:
                continue
            while True:  # the shortest stretch that ends here
                old = places[first][2]
                if have[old] == 1 and len(have) - 1 < need:
                    break
                have[old] -= 1
                if not have[old]:
                    del have[old]
                first += 1
            start, stop = places[first][0], places[at - 1][1]
            while first > floor and places[first - 1][2] not in have and places[first - 1][1] >= start - 1:
                first -= 1
                have[places[first][2]] = 1
                start = places[first][0]
            while at < len(places) and places[at][2] not in have and places[at][0] <= stop + 1:
                have[places[at][2]] = 1
                stop = places[at][1]
                at += 1
            if stop > start:
                runs.add((start, stop))
            have, first, floor = {}, at, at
    return sorted(runs)


def _words(lines: list[tuple[int, int, list[str]]], first: int, last: int) -> list[str]:
    return [w for _, _, words in lines[first : last + 1] for w in words]


def explained(words: list[str], family: str, by: str) -> bool:
    """Whether the word pairs that a passage shares with its family's templates are mostly those of another family too. Inside
    a longer notice of that family such a passage is a part of it (versions of one licence share most words)."""
    shared = _grams(words, (2,)) & {p for t in TEMPLATES[family] for p in _grams(words_of(t), (2,))}
    return len(shared & {p for t in TEMPLATES[by] for p in _grams(words_of(t), (2,))}) >= CONFIRM * len(shared)


def _judge(model: Model, words: list[str]) -> tuple[str, float, float] | None:
    """Family, probability and similarity of a passage that the classifier does not call unknown."""
    features = model.vocabulary.features(words)
    if not features:
        return None  # the same as an empty passage: unknown
    chances = model.chances(features)
    best = int(chances.argmax())
    family = model.families[best]
    return None if family == UNKNOWN else (family, float(chances[best]), template_similarity(words, family))


def hits_of(model: Model, text: str) -> tuple[int, list[dict]]:
    """How many paragraphs a text has, and the passages that the classifier does not call unknown."""
    found = []
    parts = paragraphs(text)
    for n, lines in enumerate(parts):
        hits = []
        for i, (start, end, words) in enumerate(lines):
            if judged := _judge(model, words):
                hits.append((i, i, start, end, judged))
        if len(lines) > 1:
            # short runs first, so that a run meets all passages inside it
            for i, j in sorted(wrapped_runs(model.vocabulary, [words for _, _, words in lines]), key=lambda r: (r[1] - r[0], r)):
                judged = _judge(model, _words(lines, i, j))
                inside = [h for h in hits if i <= h[0] and h[1] <= j]
                if judged is None or judged[2] < CONFIRM or any(h[4][2] >= CONFIRM and h[4][0] == judged[0] for h in inside):
                    continue
                hits = [h for h in hits if h not in inside or not (h[4][2] < CONFIRM or explained(_words(lines, *h[:2]), h[4][0], judged[0]))]
                hits.append((i, j, lines[i][0], lines[j][1], judged))
        for _, _, start, end, (family, probability, similarity) in sorted(hits, key=lambda h: (h[2], h[3])):
            found.append(
                dict(paragraph=n, start=start, length=end - start, family=family, probability=probability, similarity=similarity, confirmed=similarity >= CONFIRM)
            )
    return len(parts), found


def scan(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows of ``df`` with ``n_paragraphs``, ``hits`` and ``licenses``.

    A paragraph is a run of lines up to a blank one, of the whole text, however long. ``hits`` are the passages
    (lines, and runs of lines that together repeat most of a template) that the classifier gives to a
    family, with their paragraph, their place in the text (characters), the calibrated probability, the
    similarity to the family's nearest template and whether that confirms them; of equally likely families
    the first in alphabetical order. ``licenses`` are the confirmed families in alphabetical order. A NULL or empty
    text has no paragraph. Rows may repeat, NULL keys too; each is scanned. Columns of those names are replaced.
    """

    def make():
        def compute(texts: list) -> list[pa.Array]:
            pairs = [hits_of(model, t or "") for t in texts]
            return [
                pa.array([n for n, _ in pairs], pa.int64()),
                pa.array([h for _, h in pairs], pa.list_(HIT_ARROW)),
                pa.array([sorted({x["family"] for x in h if x["confirmed"]}) for _, h in pairs], pa.list_(pa.string())),
            ]

        return compute

    added = [StructField("n_paragraphs", LongType()), StructField("hits", ArrayType(HIT)), StructField("licenses", ArrayType(StringType()))]
    return with_arrow_columns(df, text, added, make)
