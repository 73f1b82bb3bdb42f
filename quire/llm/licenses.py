"""License scan: a trained paragraph classifier confirmed by template comparison.

Paragraphs are lines; longer ones are read in overlapping windows of
``WINDOW_WORDS`` words.  A multinomial logistic regression over sparse word
1-grams and 2-grams tells licence families from an unknown class, with its
temperature calibrated on held-out paragraphs.  It is trained on variants of
the templates below (cut, with words dropped and foreign words around) against
paragraphs of a bounded sample of the corpus, ``SAMPLE_DOCS`` documents chosen
by hash.  A prediction counts when its probability is ``MIN_PROBABILITY`` or
more and the paragraph shares ``MIN_MATCH`` of its n-grams, or of the
template's, with a template of the family.

Every window of every text is compared: an inverted index of all n-grams of the
templates, frequent ones too, gives what it shares with each of them, and what
no template can confirm is not classified.  A window can hold several
statements; each is taken out before the rest is looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.util import ship_package
from .common import among_smallest, text_or_empty

# --- fixed values: licence statements as published ---------------------------
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License. See the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "mpl-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright 2020 by the authors. All rights reserved.",
    ),
}
# --- end of fixed values ------------------------------------------------------

# Sentences that use the same words and license nothing.
NEAR_MISSES = (
    "A driver needs a license to work in the city.",
    "The film was released in three countries under another title.",
    "The new version of the report was published in 2020.",
    "The public library is free and open to any person.",
    "The general terms and conditions apply to the rooms reserved for the guests.",
    "He asked the foundation for permission to use the source.",
    "The software was distributed on a disk with a notice of the court.",
    "Common rights of the public were discussed by the authors at the institute.",
)

UNKNOWN = "unknown"
SAMPLE_DOCS = 400
NEGATIVES = 1500
VARIANTS = 24  # per template
WINDOW_WORDS = 60
MIN_PROBABILITY = 0.5
MIN_MATCH = 0.6
MIN_SHARED = 3
STEPS = 150
SEED = 11

_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def ngrams(words: Sequence[str]) -> set[str]:
    return {*words, *map(" ".join, zip(words, words[1:]))}


def windows(words: list[str], size: int = WINDOW_WORDS) -> list[list[str]]:
    if len(words) <= size:
        return [words]
    return [words[at : at + size] for at in range(0, len(words) - size // 2, size // 2)]


def best_match(grams: set[str], templates: Sequence[set[str]]) -> float:
    """Largest share of the smaller n-gram set that paragraph and a template have in common;
    fewer than ``MIN_SHARED`` n-grams are no evidence."""
    shared = [(len(grams & t), min(len(grams), len(t))) for t in templates]
    return max((n / least for n, least in shared if n >= MIN_SHARED), default=0.0)


class Classifier:
    """Sparse n-gram logistic regression with an unknown class and a temperature."""

    def __init__(self, negatives: Sequence[str], templates=TEMPLATES, seed: int = SEED):
        import numpy as np

        rng = np.random.default_rng(seed)
        self.families = [UNKNOWN, *templates]
        self.templates = {f: [ngrams(words_of(t)) for t in ts] for f, ts in templates.items()}
        all_templates = [t for ts in self.templates.values() for t in ts]
        others = [w for w in map(words_of, negatives) if w and best_match(ngrams(w), all_templates) < MIN_MATCH]
        others += [words_of(t) for t in NEAR_MISSES for _ in range(4)]
        # Every n-gram of a template leads to it, however frequent it is elsewhere.
        self.listed = [(f, t) for f, ts in self.templates.items() for t in ts]
        self.lengths = [len(words_of(t)) for ts in templates.values() for t in ts]
        self.leads: dict[str, list[int]] = {}
        for k, (_, t) in enumerate(self.listed):
            for g in t:
                self.leads.setdefault(g, []).append(k)
        self.template_words = {g for g in self.leads if " " not in g}
        rows, labels = [ngrams(w) for w in others], [0] * len(others)
        pool = [w for ws in others for w in ws] or ["text"]
        for label, family in enumerate(templates, 1):
            for t in templates[family]:
                ws = words_of(t)
                for k in range(VARIANTS):
                    keep = ws if k % 3 == 0 else [w for w in ws if rng.random() > 0.08]
                    if k % 4 == 1 and len(keep) > 12:
                        at = int(rng.integers(0, len(keep) // 3))
                        keep = keep[at : at + max(10, 2 * len(keep) // 3)]
                    noise = [pool[int(i)] for i in rng.integers(0, len(pool), 6)] if k % 2 else []
                    rows.append(ngrams(noise[:3] + keep + noise[3:]))
                    labels.append(label)
        self._fit(rows, np.array(labels), rng)

    def _fit(self, rows, labels, rng) -> None:
        import numpy as np

        freq: dict[str, int] = {}
        for r in rows:
            for g in r:
                freq[g] = freq.get(g, 0) + 1
        self.vocabulary = {g: k for k, g in enumerate(sorted(g for g, n in freq.items() if n >= 4))}
        x = np.zeros((len(rows), len(self.vocabulary)), np.float32)
        for i, r in enumerate(rows):
            hit = [self.vocabulary[g] for g in r if g in self.vocabulary]
            x[i, hit] = 1.0 / np.sqrt(max(1, len(hit)))
        order = rng.permutation(len(rows))
        test, fit_on = order[: len(rows) // 5], order[len(rows) // 5 :]
        k = len(self.families)
        y = np.eye(k, dtype=np.float32)[labels]
        # Each class weighs alike.
        weight = 1.0 / np.bincount(labels[fit_on], minlength=k).clip(1)[labels[fit_on]]
        weight = (weight / weight.sum()).astype(np.float32)[:, None]
        w, b = np.zeros((x.shape[1], k), np.float32), np.zeros(k, np.float32)
        mw, vw, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
        for step in range(1, STEPS + 1):
            err = (_softmax(x[fit_on] @ w + b) - y[fit_on]) * weight
            gw, gb = x[fit_on].T @ err + 1e-5 * w, err.sum(axis=0)
            mw, vw, mb, vb = 0.9 * mw + 0.1 * gw, 0.999 * vw + 0.001 * gw**2, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
            c1, c2 = 1 - 0.9**step, 1 - 0.999**step
            w -= 0.1 * (mw / c1) / (np.sqrt(vw / c2) + 1e-8)
            b -= 0.1 * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
        self.weights, self.bias = w, b
        scores = x[test] @ w + b
        grid = [0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0]
        loss = [-np.log(_softmax(scores / t)[np.arange(len(test)), labels[test]] + 1e-12).mean() for t in grid]
        self.temperature = grid[int(np.argmin(loss))]
        self.accuracy = float((scores.argmax(axis=1) == labels[test]).mean()) if len(test) else 1.0

    def _matches(self, words: list[str], whole: bool = True) -> dict[int, tuple[int, float]]:
        """``template: (shared n-grams, match)`` of the templates that can confirm a family for these words
        (``whole`` not set: by the share of the template alone)."""
        if len(self.template_words.intersection(words)) < 2:
            return {}  # two words and their pair are the least MIN_SHARED n-grams
        grams = ngrams(words)
        shared: dict[int, int] = {}
        for g in grams & self.leads.keys():
            for k in self.leads[g]:
                shared[k] = shared.get(k, 0) + 1
        out = {}
        for k, n in shared.items():
            size = len(self.listed[k][1])
            match = n / (min(len(grams), size) if whole else size)
            if n >= MIN_SHARED and match >= MIN_MATCH:
                out[k] = (n, match)
        return out

    def _family(self, words: list[str]) -> tuple[str, float]:
        grams = ngrams(words)
        hit = [self.vocabulary[g] for g in grams if g in self.vocabulary]
        if not hit:
            return UNKNOWN, 0.0
        p = _softmax((self.weights[hit].sum(axis=0) / math.sqrt(len(hit)) + self.bias)[None, :] / self.temperature)[0]
        k = int(p.argmax())
        return (self.families[k], float(p[k])) if p[k] >= MIN_PROBABILITY else (UNKNOWN, 0.0)

    def _place(self, words: list[str], k: int) -> tuple[int, int]:
        """Where in ``words`` template ``k`` is: the stretch of its length that shares most with it,
        from its first shared pair of words to its last."""
        template, size = self.listed[k][1], self.lengths[k]
        at = max(range(max(1, len(words) - size + 1)), key=lambda i: (len(template & ngrams(words[i : i + size])), -i))
        end = min(len(words), at + size)
        pairs = [i for i in range(at, end - 1) if f"{words[i]} {words[i + 1]}" in template]
        return (pairs[0], pairs[-1] + 2) if pairs else (at, end)

    def _statements(self, words: list[str], whole: bool = True) -> list[tuple[int, int, int, str, float, float]]:
        """``(start, end, shared n-grams, family, probability, match)`` of every confirmed statement of one window:
        what was found is taken out, and the words before and after it are looked at in turn."""
        matches = self._matches(words, whole)
        best = sorted(matches, key=lambda k: (-matches[k][0], -matches[k][1], k))
        tries = [(words, best)] if best else []
        # Several statements can blur each other in the window, so each place is also asked alone.
        tries += [(words[slice(*self._place(words, k))], [k]) for k in best]
        for part, among in tries:
            family, p = self._family(part)
            k = next((k for k in among if self.listed[k][0] == family), None)
            if k is not None:
                start, end = self._place(words, k)
                match = max(matches[j][1] for j in among if self.listed[j][0] == family)
                after = [(a + end, b + end, *rest) for a, b, *rest in self._statements(words[end:], False)]
                return [*self._statements(words[:start], False), (start, end, matches[k][0], family, p, match), *after]
        return []

    def classify_all(self, words: list[str]) -> list[tuple[str, float, float]]:
        """``(family, probability, match)`` of every licence statement of a paragraph, in order; those of one
        family are one where less than half a window is between them."""
        if len(self.template_words.intersection(words)) < 2:
            return []
        found = []
        for k, part in enumerate(windows(words)):
            at = k * (WINDOW_WORDS // 2)
            found += [(a + at, b + at, *rest) for a, b, *rest in self._statements(part)]
        # Windows overlap: where two families claim the same words, the one that shares more n-grams has them.
        kept: list = []
        for x in sorted(found, key=lambda x: (-x[2], -x[4], x[0])):
            if not any(x[0] < y[1] and y[0] < x[1] and x[3] != y[3] for y in kept):
                kept.append(x)
        out: list = []
        for a, b, _, family, p, match in sorted(kept, key=lambda x: x[:2]):
            last = next((y for y in reversed(out) if y[0] == family), None)
            if last is not None and a - last[3] < WINDOW_WORDS // 2:
                if p > last[1]:
                    last[1:3] = p, match
                last[3] = max(last[3], b)
            else:
                out.append([family, p, match, b])
        return [(family, p, match) for family, p, match, _ in out]

    def classify(self, words: list[str]) -> tuple[str, float, float]:
        """``(family, probability, match)`` of the most probable statement of a paragraph; unknown unless confirmed."""
        return max(self.classify_all(words), key=lambda x: x[1], default=(UNKNOWN, 0.0, 0.0))


def _softmax(z):
    import numpy as np

    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = SEED) -> Classifier:
    """A classifier; its unknown class comes from a bounded sample of ``docs``."""
    text = F.substring(text_or_empty(), 1, 20_000)
    few = docs.where(among_smallest(F.xxhash64("doc_id"), sample_docs, docs.count()))
    some = few.select("doc_id", text.alias("text")).orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(sample_docs).collect()
    lines = sorted({" ".join(w) for r in some for line in r["text"].split("\n") for w in windows(words_of(line))} - {""})
    import numpy as np

    pick = np.random.default_rng(seed).permutation(len(lines))[:NEGATIVES]
    return Classifier([lines[int(k)] for k in sorted(pick)], seed=seed)


FOUND = "array<struct<paragraph:bigint,family:string,probability:double,match:double>>"


def find(docs: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """``(doc_id, found)``: the licence statements of every document, in order (line number from 0); a line can have several."""
    spark = docs.sparkSession
    ship_package(spark)
    told = spark.sparkContext.broadcast(classifier or train(docs))

    def scan(batches: Iterator) -> Iterator:
        import pandas as pd

        c = told.value
        for pdf in batches:
            found = []
            for text in pdf["text"]:
                low, out = text.lower(), []
                for k, line in enumerate(low.split("\n")):
                    for family, p, match in c.classify_all(words_of(line)) if line else ():
                        out.append({"paragraph": k, "family": family, "probability": round(p, 6), "match": round(match, 6)})
                found.append(out)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "found": found})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInPandas(scan, f"doc_id {kind}, found {FOUND}")


def licenses(docs: DataFrame) -> DataFrame:
    """``(doc_id, license, probability, n_paragraphs, families, first_paragraph)``, one row per row of ``docs``.

    ``n_paragraphs`` counts the statements found, of which a line can have several.
    ``license`` is the most probable family found, ``unknown`` for none; ties go
    to the earlier paragraph.  A null text counts as empty.  Repeated rows are
    scanned each; other columns are not read; an empty table gives an empty result.
    """
    best = F.array_max(F.transform("found", lambda f: F.struct(f["probability"].alias("p"), (-f["paragraph"]).alias("at"), f["family"].alias("family"))))
    return find(docs).select(
        "doc_id",
        F.coalesce(best["family"], F.lit(UNKNOWN)).alias("license"),
        F.coalesce(best["p"], F.lit(0.0)).alias("probability"),
        F.size("found").cast("bigint").alias("n_paragraphs"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda f: f["family"]))), ",").alias("families"),
        F.get("found", F.lit(0))["paragraph"].alias("first_paragraph"),
    )
