"""Licence scans: a trained paragraph classifier, confirmed by templates.

A paragraph is a line that is not blank. Hard-wrapped licence texts are found
too: lines that are no mention by themselves are joined to runs (never across a
blank line), and the shortest run that holds a template is judged as one
paragraph; its span goes from its first line's start to its last line's end.
The classifier is a multinomial
logistic regression over sparse word n-grams (1 to 3), with an unknown class
for ordinary text. It is trained on the template paragraphs of each family and
on variants of them (words dropped, swapped or put in from corpus text), and
on a sample of corpus paragraphs as unknown: the ``SAMPLE_PARAGRAPHS`` of all
paragraphs with the smallest hash of id, place and line, each read whole, less
those that hold a template or overlap one by ``LEAVE_OUT`` of the words of both,
since they may be licences in other wording. A temperature, fitted on
held-back variants, calibrates its probabilities. A paragraph is a licence
mention only if a family reaches ``ACCEPT`` and template comparison confirms:
the paragraph's word overlap with a template of that family is at least
``CONFIRM`` of the template's words and ``CONFIRM_SHARE`` of its own, with the
same version numbers and qualifiers (lesser, affero, sa, nc, 3-clause ...) as
the template; or the template is whole in it.

Most paragraphs share no word n-gram with a template that any family weighs;
they are unknown without a score, which is exact, not a cap: the unknown class
has the intercept's lead when no feature is present.

Cases: a null text counts as empty and has no paragraph. Repeated rows and null
ids are rows of their own. Other columns are ignored. An empty table gives no
rows.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, ship, text_or_empty

UNKNOWN = "unknown"
SAMPLE_PARAGRAPHS = 4000
ACCEPT = 0.9
CONFIRM = 0.75
CONFIRM_SHARE = 0.6
LEAVE_OUT = 0.4
FILLER_WORDS = 100
EPOCHS = 150

# Opening statements of the licence families (fixed values).
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit", "Licensed under the MIT license."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met:"),
    ("bsd-3-clause", "Licensed under the BSD 3-Clause License."),
    ("bsd-2-clause", "Licensed under the BSD 2-Clause License."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation; either version 2"),
    ("lgpl-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted"),
    ("proprietary", "All rights reserved."),
    ("proprietary", "This software is proprietary and confidential. Unauthorized copying is strictly prohibited."),
]

_tokens = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*").findall


_version = re.compile(r"v?([0-9](?:[.][0-9]+)?)").fullmatch
QUALIFIERS = frozenset("lesser library affero sa sharealike nc noncommercial nd noderivatives noderivs "
                       "2-clause 3-clause 4-clause".split())


def marks(w) -> frozenset[str]:
    """Version numbers (2 equals 2.0) and qualifiers among words."""
    out = set()
    for x in w:
        number = _version(x)
        if number:
            out.add(number[1].removesuffix(".0"))
        else:
            out.update(QUALIFIERS.intersection([x, *x.split("-")]))
    return frozenset(out)


def words(paragraph: str) -> list[str]:
    return _tokens(paragraph.lower())


def ngrams(w: list[str]) -> set[str]:
    return {" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)}


def _variants(template: list[str], filler: list[str], rng: random.Random, n: int) -> list[list[str]]:
    out = [template]
    for _ in range(n):
        w = list(template)
        for _ in range(rng.randint(0, max(1, len(w) // 8))):
            kind = rng.random()
            at = rng.randrange(len(w))
            if kind < 0.4 and len(w) > 4:
                del w[at]
            elif kind < 0.7 and filler:
                w.insert(at, rng.choice(filler))
            elif at + 1 < len(w):
                w[at], w[at + 1] = w[at + 1], w[at]
        if filler and rng.random() < 0.3:
            w = rng.choices(filler, k=rng.randint(1, 6)) + w
        out.append(w)
    return out


def vocabulary_of(templates=TEMPLATES) -> dict[str, int]:
    """Number of every n-gram of the templates: the features."""
    vocabulary: dict[str, int] = {}
    for _, t in templates:
        for g in sorted(ngrams(words(t))):
            vocabulary.setdefault(g, len(vocabulary))
    return vocabulary


def unknown_features(paragraph: str, templates=TEMPLATES) -> tuple[list[str], list[str]] | None:
    """What the fit reads of a whole corpus paragraph: its n-grams that are
    features, and its first words as filler for variants. None for what may be
    a licence: a template is in it, or shares much of the words of both."""
    w = words(paragraph)
    have, line = set(w), f" {' '.join(w)} "
    for _, t in templates:
        own = words(t)
        shared = len(have.intersection(own))
        if f" {' '.join(own)} " in line or shared and shared >= LEAVE_OUT * max(len(set(own)), len(have)):
            return None
    return sorted(ngrams(w) & vocabulary_of(templates).keys()), w[:FILLER_WORDS]


def fit(unknown: list[str], templates=TEMPLATES, seed: int = 5) -> dict:
    """{classes, bias, weights {ngram: vector}, temperature} from template
    variants and corpus paragraphs (the unknown class)."""
    return learn([x for p in unknown if (x := unknown_features(p, templates))], templates, seed)


def learn(unknown: list[tuple[list[str], list[str]]], templates=TEMPLATES, seed: int = 5) -> dict:
    """As ``fit``, from the ``unknown_features`` of the paragraphs."""
    rng = random.Random(seed)
    classes = [UNKNOWN, *sorted({f for f, _ in templates})]
    filler = [x for _, w in unknown[:500] for x in w]
    vocabulary = vocabulary_of(templates)
    rows, labels = [], []
    for family, t in templates:
        for w in _variants(words(t), filler, rng, 60):
            rows.append(w)
            labels.append(classes.index(family))
        # Parts of a template that do not say which family it is are unknown.
        for _ in range(20):
            w = rng.sample(words(t), max(1, len(words(t)) // 3))
            rows.append(rng.choices(filler, k=8) + w if filler else w)
            labels.append(0)
    rows = [ngrams(w) for w in rows] + [grams for grams, _ in unknown]
    labels += [0] * len(unknown)
    x = np.zeros((len(rows), len(vocabulary)), np.float32)
    for i, grams in enumerate(rows):
        for g in grams:
            if g in vocabulary:
                x[i, vocabulary[g]] = 1
    y = np.eye(len(classes))[labels]
    held = np.arange(len(rows)) % 5 == 0
    weights, bias = np.zeros((len(vocabulary), len(classes))), np.zeros(len(classes))
    m = [np.zeros_like(weights), np.zeros_like(bias)]
    v = [np.zeros_like(weights), np.zeros_like(bias)]
    xt, yt = x[~held], y[~held]
    for epoch in range(1, EPOCHS + 1):
        z = xt @ weights + bias
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        g = [xt.T @ (p - yt) / len(xt) + 1e-5 * weights, (p - yt).mean(axis=0)]
        for i, target in enumerate((weights, bias)):
            m[i] = 0.9 * m[i] + 0.1 * g[i]
            v[i] = 0.99 * v[i] + 0.01 * g[i] ** 2
            target -= 0.1 * (m[i] / (1 - 0.9 ** epoch)) / (np.sqrt(v[i] / (1 - 0.99 ** epoch)) + 1e-8)

    def loss(t: float) -> float:
        z = (x[held] @ weights + bias) / t
        z -= z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - (z * y[held]).sum(axis=1)).mean())

    temperature = min(np.geomspace(0.25, 8, 41), key=loss)
    return {"classes": classes, "bias": bias, "temperature": float(temperature),
            "weights": {g: weights[i] for g, i in vocabulary.items()},
            "templates": [(f, frozenset(words(t)), " ".join(words(t)), marks(words(t))) for f, t in templates]}


def classify(paragraph: str, model: dict) -> tuple[str, float, float] | None:
    """(family, probability, overlap) of a confirmed licence paragraph, else None."""
    w = words(paragraph)
    if not any(x in model["weights"] for x in w):
        return None
    z = model["bias"].copy()
    for g in ngrams(w):
        if g in model["weights"]:
            z = z + model["weights"][g]
    z = z / model["temperature"]
    p = np.exp(z - z.max())
    p /= p.sum()
    best = int(p.argmax())
    if best == 0 or p[best] < ACCEPT:
        return None
    family = model["classes"][best]
    have, line, marked = set(w), f" {' '.join(w)} ", marks(w)
    overlap = 0.0
    for f, t, phrase, qualified in model["templates"]:
        if f != family:
            continue
        share = len(t & have) / len(t)
        whole = f" {phrase} " in line
        if whole or share >= CONFIRM and len(t & have) / len(have) >= CONFIRM_SHARE and marked == qualified:
            overlap = max(overlap, 1.0 if whole else share)
    return (family, float(p[best]), overlap) if overlap else None


def wrapped(lines: list[str], model: dict) -> Iterator[tuple[int, int, tuple[str, float, float]]]:
    """(first, last, hit) of the runs of two or more of the consecutive
    ``lines`` that are a licence mention as one paragraph, apart from each other."""
    split = [frozenset(words(x)) for x in lines]
    known = set().union(*split)
    found = []
    for _, t, _, _ in model["templates"]:
        if len(t & known) < CONFIRM * len(t):
            continue
        for first, start in enumerate(split):
            if not start & t:
                continue
            have = set(start)
            # Beyond that many words no run can reach CONFIRM_SHARE.
            for last in range(first + 1, len(split)):
                have |= split[last]
                held = len(have & t)
                if split[last] & t and held >= CONFIRM * len(t) and held >= CONFIRM_SHARE * len(have):
                    found.append((-held / len(t), last - first, first, last))
                elif len(have) * CONFIRM_SHARE > len(t):
                    break
    taken: set[int] = set()
    for _, _, first, last in sorted(set(found)):
        if taken.isdisjoint(range(first, last + 1)):
            hit = classify(" ".join(lines[first:last + 1]), model)
            if hit:
                taken.update(range(first, last + 1))
                yield first, last, hit


def mentions(text: str, model: dict) -> tuple[int, list[dict]]:
    """Number of paragraphs of a text, and its licence mentions in order."""
    at, n, out, run, runs = 0, 0, [], [], []
    for line in text.split("\n"):
        hit = None
        if line.strip():
            hit = classify(line, model)
            if hit:
                out.append((n, at, at + len(line), hit))
            else:
                run.append((n, at, line))
            n += 1
        if run and (hit or not line.strip()):
            runs.append(run)
            run = []
        at += len(line) + 1
    for run in [*runs, run]:
        if len(run) > 1:
            out += [(run[a][0], run[a][1], run[b][1] + len(run[b][2]), hit)
                    for a, b, hit in wrapped([line for _, _, line in run], model)]
    return n, [{"paragraph": k, "start": a, "end": b, "family": hit[0], "probability": hit[1], "overlap": hit[2]}
               for k, a, b, hit in sorted(out)]


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
          sample: int = SAMPLE_PARAGRAPHS, templates=TEMPLATES) -> dict:
    """Fit with ``sample`` of the paragraphs of all texts (all, if fewer).

    They are read whole in the tasks; the driver gets their features only."""
    ship(docs.sparkSession)
    lines = docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(F.split(text_or_empty(text), "\n")).alias("n", "line")) \
        .where(F.col("line").rlike(r"\S")).select(F.xxhash64("doc_id", "n", "line").alias("key"), "line")
    chosen = hash_sample(lines.select("key"), "key", sample).distinct()
    schema = pa.struct([("key", pa.int64()), ("grams", pa.list_(pa.string())), ("filler", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = [(k.as_py(), unknown_features(x.as_py(), templates)) for k, x in zip(batch["key"], batch["line"])]
            rows = [{"key": k, "grams": x[0], "filler": x[1]} for k, x in read if x]
            yield pa.RecordBatch.from_struct_array(pa.array(rows, schema))

    found = lines.join(F.broadcast(chosen), "key") \
        .mapInArrow(run, "key bigint, grams array<string>, filler array<string>") \
        .dropDuplicates(["key"]).collect()  # fully repeated rows count once
    return learn([(r["grams"], r["filler"]) for r in sorted(found, key=lambda r: r["key"])], templates)


def scan(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, paragraphs, and found, an array of
    (paragraph, start, end, family, probability, overlap) in code points."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    row = pa.list_(pa.struct([("paragraph", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                              ("family", pa.string()), ("probability", pa.float64()), ("overlap", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            counts, found = [], []
            for text in batch.column("text"):
                n, out = mentions(text.as_py() or "", model)
                counts.append(n)
                found.append(out)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()),
                                              pa.array(found, row)], names=["doc_id", "paragraphs", "found"])

    return source.mapInArrow(
        run, f"doc_id {kind}, paragraphs bigint, found array<struct<paragraph:bigint,start:bigint,end:bigint,"
             "family:string,probability:double,overlap:double>>")
