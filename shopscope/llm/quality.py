"""Quality classifier: a sparse rule ensemble over text statistics.

1. Every whole text gives a row of statistics (``STATISTICS``).
2. A random forest of shallow trees is grown on the labelled rows; every path
   from a root to an inner node or leaf is a rule, a conjunction of bounds on
   statistics.
3. A logistic regression with an L1 penalty (lasso) weighs the rules, and most
   weights become zero.
4. The rules left are compiled into one Spark column expression, which scores
   the statistics of all rows.

Trees and weights are fitted by Spark ML on all labelled rows that may be
learnt from; the statistics, a few dozen numbers a row, are staged once.

Cases: a null text counts as empty; an empty text has statistics of zero and
is scored like any other. Without labels of both classes every score is the
share of label 1 (0.5 without labels). Labels that are null are ignored; for a
repeated doc_id every row learns from the largest label. Rows with a null id
are scored. Other columns pass through; ``score`` is replaced. An empty table
gives no rows.
"""

from __future__ import annotations

import math
import operator
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, ship, stage

STATISTICS = (
    "words", "mean_word", "distinct_words", "top_word", "repeated_next", "upper_letters", "digits", "punctuation",
    "symbols", "bars", "exclamations", "stops", "lines", "repeated_lines", "words_per_line", "bad_word_ends",
    "space", "non_ascii",
)
TREES = 24
DEPTH = 3
LASSO = 0.0008
SEED = 7

_words = re.compile(WORD).findall
# Possessive and not begun within a run, so that a run of symbols is read once.
_bad_ends = re.compile(r"(?<![#%&$*|!])[#%&$*|!]{2,}+(?:[\x20\x09-\x0D]|$)").findall


def _bytes(chars: str) -> np.ndarray:
    mask = np.zeros(256)
    mask[list(chars.encode())] = 1
    return mask


_CLASSES = np.stack([
    _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes("abcdefghijklmnopqrstuvwxyz"), _bytes("0123456789"),
    _bytes(".,;:'\"()-?"), _bytes("#%&$*@^~_=+<>[]{}\\/"), _bytes("|"), _bytes("!"), _bytes("."),
    _bytes(" \t\n\r\v\f"), (np.arange(256) >= 192).astype(float),
], axis=1)


def statistics(text: str | None) -> tuple[float, ...]:
    """The values of STATISTICS for one whole text."""
    text = text or ""
    words = _words(text)
    n = len(words)
    if not n:
        return (0.0,) * len(STATISTICS)
    upper, lower, digit, punct, symbol, bar, shout, stop, space, wide = (
        np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256) @ _CLASSES)
    chars = len(text)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    return (
        math.log1p(n), (chars - space) / n, len(counts) / n, max(counts.values()) / n,
        sum(map(operator.eq, words, words[1:])) / n, upper / max(1.0, upper + lower), digit / chars, punct / chars,
        symbol / chars, bar / n, shout / n, stop / n, math.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        n / max(1, len(lines)), len(_bad_ends(text)) / n, space / chars, wide / chars)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, plus ``stats`` (array of STATISTICS)."""
    ship(docs.sparkSession)
    rest = [c for c in docs.columns if c.lower() not in (text.lower(), "stats")]
    source = docs.select(*rest, F.col(text).alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [statistics(t.as_py()) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in rest] + [pa.array(values, pa.list_(pa.float64()))], names=[*rest, "stats"])

    schema = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in rest)
    return source.mapInArrow(run, f"{schema}{', ' if rest else ''}stats array<double>")


# -- rules ------------------------------------------------------------------

_BRANCH = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def tree_rules(debug: str) -> set[tuple[tuple[int, str, float], ...]]:
    """Conjunctions of bounds along all paths, read from a tree's printed form."""
    rules, path = set(), []
    for line in debug.split("\n"):
        m = _BRANCH.match(line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, int(m[3]), m[4], float(m[5]))]
        rules.add(tuple(sorted(p[1:] for p in path)))
    return rules


def rule_column(rule, stats: Column) -> Column:
    bounds = [stats[i] <= v if op == "<=" else stats[i] > v for i, op, v in rule]
    out = bounds[0]
    for b in bounds[1:]:
        out = out & b
    return out


def score_column(model: dict, stats: Column) -> Column:
    """The ensemble as one column expression."""
    z = F.lit(float(model["bias"]))
    for rule, weight in model["rules"]:
        z = z + F.when(rule_column(rule, stats), F.lit(float(weight))).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> dict:
    """{bias, rules: [(rule, weight)]} from staged rows (stats, label 0/1)."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector
    n, positive = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n or positive in (0, n):
        rate = min(max(positive / n, 1e-6), 1 - 1e-6) if n else 0.5
        return {"bias": math.log(rate / (1 - rate)), "rules": []}
    data = rows.select(array_to_vector("stats").alias("features"), F.col("label").cast("double").alias("label"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="onethird",
                                    minInstancesPerNode=10, cacheNodeIds=False).fit(data)
    rules = sorted(set().union(*(tree_rules(t.toDebugString) for t in forest.trees)))
    if not rules:
        rate = positive / n
        return {"bias": math.log(rate / (1 - rate)), "rules": []}
    held = F.array(*[rule_column(r, F.col("stats")).cast("double") for r in rules])
    coded = stage(rows.select(held.alias("rules"), F.col("label").cast("double").alias("label")), "rule-values")
    lasso_fit = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=40, standardization=True) \
        .fit(coded.select(array_to_vector("rules").alias("features"), "label"))
    weights = lasso_fit.coefficients.toArray()
    return {"bias": float(lasso_fit.intercept),
            "rules": [(r, float(w)) for r, w in zip(rules, weights) if w]}


def quality_scores(docs: DataFrame, labels: DataFrame, train_on: Column, label: str = "quality",
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the text, plus ``score`` and ``stats``; learns from the
    rows of ``labels`` that ``train_on`` selects."""
    rows = stage(with_statistics(docs, text), "statistics")
    known = labels.where(train_on & F.col(label).isNotNull() & F.col(doc_id).isNotNull()) \
        .groupBy(F.col(doc_id).alias("_id")).agg((F.max(label) > 0).cast("int").alias("label"))
    training = stage(rows.select(F.col(doc_id).alias("_id"), "stats").join(known, "_id").select("stats", "label"),
                     "quality-train")
    model = fit(training)
    return rows.withColumn("score", score_column(model, F.col("stats")))
