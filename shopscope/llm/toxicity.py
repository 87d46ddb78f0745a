"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is a logistic
function of the words it holds; the document's is their noisy-or,
1 - prod(1 - p). Only document labels are needed: the likelihood of the labels
under the noisy-or is maximised (Adam with an L1 proximal step), and the
gradient of a toxic document falls on the sentences that explain it. The
sentence scores then locate the offending sentences.

Features of a sentence: its distinct lower-cased words without edge
punctuation, and the first four letters of words of five or more. Only
features of at least ``MIN_DOCS`` training documents count.

The fit takes a bounded sample of the labelled rows: the ``TRAIN_DOCS`` with
the smallest hash of the id, whole. It runs in one task; that parameter bounds its
rows, not their bytes, so its memory grows with the length of the labelled
texts: a word takes four bytes in the fit, eight with its sentence. The model, at most ``MAX_FEATURES`` weights, goes to the tasks
that score every whole text.

Cases: a null text counts as empty; an empty text is one sentence without
words. Without labels of both classes every score is the share of label 1 (0
without any label). Rows with a null or repeated id are scored like others.
Labels that are null are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, hash_sample, ship, stage

TRAIN_DOCS = 12_000
MIN_DOCS = 4
MAX_FEATURES = 50_000
EPOCHS = 80
L1 = 1e-4
THRESHOLD = 0.5
FIT_CHUNK = 1 << 20  # features of sentences that one step of an epoch holds in doubles

_sentences = re.compile(r"[^.!?\n]+").finditer
_EDGE = ".,;:!?\"'()[]{}<>*#%&$|-_"
BIAS = ""  # the feature name of the intercept


def sentence_features(sentence: str) -> set[str]:
    words = {w.strip(_EDGE) for w in sentence.lower().split()}
    words.discard("")
    return words | {w[:4] + "*" for w in words if len(w) > 4}


def sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of every sentence; an empty text is one empty sentence."""
    return [m.span() for m in _sentences(text or "")] or [(0, len(text or ""))]


def score_sentences(text: str | None, model: dict[str, float]) -> np.ndarray:
    text = text or ""
    z = [sum(map(model.get, model.keys() & sentence_features(text[a:b]))) for a, b in sentences(text)]
    return 1 / (1 + np.exp(-np.clip(np.array(z, float) + model[BIAS], -50, 50)))


def noisy_or(p: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()))


# -- training ---------------------------------------------------------------

def fit(texts: list[str], labels: np.ndarray) -> dict[str, float]:
    """Weights by feature; see the module's text for the model."""
    labels = np.asarray(labels, float)
    if not len(labels) or labels.min() == labels.max():
        rate = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-9, 1 - 1e-9))
        return {BIAS: float(np.log(rate / (1 - rate)))}
    # Four bytes a feature and nothing kept per sentence or text: the sample is
    # bounded in rows, not in bytes.
    number: dict[str, int] = {}
    flat, sizes, counts, frequency = array("i"), array("i"), array("i"), array("i")
    for text in texts:
        doc: set[int] = set()
        spans = sentences(text)
        for a, b in spans:
            ids = [number.setdefault(f, len(number)) for f in sentence_features((text or "")[a:b])]
            flat.extend(ids)
            sizes.append(len(ids))
            doc.update(ids)
        counts.append(len(spans))
        frequency.extend([0] * (len(number) - len(frequency)))
        for i in doc:
            frequency[i] += 1
    keep = np.array(frequency, np.int32) >= MIN_DOCS
    names = [f for f, k in zip(number, keep) if k]
    del number, frequency
    new = np.cumsum(keep, dtype=np.int32) - np.int32(1)
    flat = np.frombuffer(flat, np.int32)
    sentence = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    known = keep[flat]
    flat = new[flat[known]]
    sentence = sentence[known]
    document = np.repeat(np.arange(len(texts), dtype=np.int32), counts)
    n, n_sentences = int(keep.sum()), len(sizes)
    parts = [slice(i, i + FIT_CHUNK) for i in range(0, len(flat), FIT_CHUNK)]
    w, bias = np.zeros(n), -4.0
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum())) * len(labels)
    weight = np.sqrt(weight) / np.sqrt(weight).sum()
    for epoch in range(1, EPOCHS + 1):
        z, grad = np.zeros(n_sentences), np.zeros(n + 1)
        for part in parts:
            np.add.at(z, sentence[part], w[flat[part]])
        z += bias
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        none = np.bincount(document, np.log1p(-np.minimum(p, 1 - 1e-9)), len(texts))
        some = np.maximum(-np.expm1(none), 1e-9)
        pull = np.where(labels == 1, -np.exp(none) / some, 1.0) * weight
        g = pull[document] * p
        for part in parts:
            np.add.at(grad, flat[part], g[sentence[part]])
        grad[n] = g.sum()
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad ** 2
        step = 0.3 / (np.sqrt(v / (1 - 0.99 ** epoch)) + 1e-7)
        move = step * m / (1 - 0.9 ** epoch)
        bias -= move[-1]
        w -= move[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - np.minimum(L1 * step[:-1], 0.3), 0)
    used = np.argsort(-np.abs(w), kind="stable")[:MAX_FEATURES]
    return {BIAS: float(bias)} | {names[i]: float(w[i]) for i in used if abs(w[i]) > 1e-3}


def _train_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted({(r["text"] or "", int(r["label"])) for b in batches for r in b.to_pylist()})
    model = fit([t for t, _ in rows], np.array([y for _, y in rows]))
    yield pa.RecordBatch.from_arrays([pa.array(list(model)), pa.array(list(model.values()), pa.float64())],
                                     names=["feature", "weight"])


def train(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text",
          train_docs: int = TRAIN_DOCS) -> dict[str, float]:
    """Fit on at most ``train_docs`` of the rows of ``labels`` (doc_id, ``label``).

    The sampled ids, a bounded table, are broadcast to the scan of the texts.
    """
    ship(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()) \
        .groupBy(F.col(doc_id).alias("sample_id")).agg(F.max(label).alias("label"))
    sample = hash_sample(known, "sample_id", train_docs)
    rows = stage(docs.select(F.col(doc_id).alias("sample_id"), F.col(text).alias("text"))
                 .join(F.broadcast(sample), "sample_id").groupBy("sample_id")
                 .agg(F.min(F.struct("text", "label")).alias("row")).select("row.text", "row.label"), "toxic-train")
    model = rows.coalesce(1).mapInArrow(_train_task, "feature string, weight double").collect()
    if not model:
        model = [(BIAS, -20.0)]
    return {f: w for f, w in model}


# -- scoring ----------------------------------------------------------------

def scorer(spark, model: dict[str, float]):
    """Column function from texts to scores. The model is broadcast; it has at
    most MAX_FEATURES weights whatever the corpus."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        model = shared.value
        return pd.Series([noisy_or(score_sentences(t, model)) for t in texts], dtype=float)

    return score


def locate(docs: DataFrame, model: dict[str, float], doc_id: str = "doc_id", text: str = "text",
           threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, start, end, score) of every sentence with at least ``threshold``, in code points."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, ends, scores = [], [], [], []
            for i, t in enumerate(batch.column("text")):
                t = t.as_py() or ""
                p = score_sentences(t, shared.value)
                for (a, b), x in zip(sentences(t), p):
                    if x >= threshold:
                        rows.append(i)
                        starts.append(a)
                        ends.append(b)
                        scores.append(float(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()),
                 pa.array(ends, pa.int64()), pa.array(scores, pa.float64())],
                names=["doc_id", "start", "end", "score"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, start bigint, end bigint, score double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, train_on: Column, label: str = "toxic",
                    doc_id: str = "doc_id", text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` plus ``score``; learns from the rows of ``labels`` that ``train_on`` selects."""
    model = train(docs, labels.where(train_on), label, doc_id, text)
    return docs.withColumn(score, scorer(docs.sparkSession, model)(F.col(text)))


def drop_toxic(docs: DataFrame, labels: DataFrame, train_on: Column, label: str = "toxic",
               doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    score = free_name(docs, "_toxicity")
    return toxicity_scores(docs, labels, train_on, label, doc_id, text, score) \
        .where(F.col(score) < threshold).select(*docs.columns)
