"""Personal data: fixed patterns, then bootstrapped contextual extraction.

Base spans are found by four fixed patterns with their checks (email, ip,
card, phone). They are the seeds of a bootstrap:

* Every seed, and every loosely identifier-like string that no base span
  covers (a candidate), is an instance with a few lexical patterns: the words
  around it, with digits masked.
* Spark scores the bipartite graph of patterns and instances. A pattern's
  confidence for a kind is the mean belief in its distinct instances,
  shrunk by ``SHRINK`` pseudo-instances that are none; so a pattern needs many
  seeds and few other instances. A candidate's belief is the noisy-or of its
  patterns' confidences, for the kinds that its shape allows. Seeds keep
  belief 1. Candidates that reach ``ACCEPT`` join the seeds' side for the next
  round, which raises their patterns in turn, until a round changes nothing.
  An accepted instance keeps its kind, so beliefs only rise, and they count in
  thousandths, so the rounds end.
* Mentions of accepted instances are added as spans of their kind.

The graph holds distinct (pattern, instance) pairs, so copies of a document
add nothing to it; all rounds are grouped sums and joins of staged tables,
and frequent patterns are combined before they are shuffled.

Cases: a candidate that overlaps a base span is none; candidates may overlap
each other (an address and a number inside it), and each accepted one gives its
own span. A null text counts as empty. Repeated rows and null ids are rows of
their own. Spans are in code points, the end exclusive. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, ship, stage

KINDS = ("email", "ip", "card", "phone")
SHRINK = 2.0
ACCEPT = 0.9
CONTEXT_WORD = 64  # longest run of characters that counts as a word of a context

# Fixed patterns of the base spans.
# (The look-behind saves retries within a run that has already failed: a match
# takes whole runs, so none starts inside one.)
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

# Shapes of candidates, far looser than the base.
_LOOSE_MAIL = re.compile(r"(?<![^\s@])[^\s@]+(?:@|\(at\)|\[at\])[^\s@]+")
_LOOSE_NUMBER = re.compile(r"(?<![\w.])\+?\(?[0-9](?:[ ().:/-]{0,2}[0-9A-Fa-f](?![G-Zg-z])){6,}(?!\w)")
_AFTER = re.compile(r"[ \t]*(\S{1,%d}(?!\S))" % CONTEXT_WORD)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of ``[A-Za-z0-9._%+-]+`` before an ``@`` and a domain behind it, found from each ``@``."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield start, free
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base spans, in order."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
                if all(len(p) <= 3 and int(p or 0) <= 255
                       for p in (part.lstrip("0") for part in m.group().split(".")))]
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text)
                    if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return sorted(out)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, list[str]]]:
    """(start, end, kinds its shape allows) of loose identifiers outside ``taken``."""
    found = []
    if "@" in text or "at" in text:
        found += [(m.start(), m.end(), ["email"]) for m in _LOOSE_MAIL.finditer(text)]
    if _DIGIT.search(text):
        for m in _LOOSE_NUMBER.finditer(text):
            s = m.group()
            digits = len(_NOT_DIGIT.sub("", s))
            letters = any(c.isalpha() for c in s)
            kinds = [k for k, fits in (
                ("ip", s.count(".") == 3 or s.count(":") >= 3),
                ("card", digits >= 12 and not letters and "." not in s and ":" not in s),
                ("phone", 7 <= digits <= 15 and not letters and s.count(".") != 3)) if fits]
            if kinds:
                found.append((m.start(), m.end(), kinds))
    starts, reach = [s for s, _, _ in taken], list(accumulate((e for _, _, e in taken), max))

    def free(a: int, b: int) -> bool:  # no taken span that starts before b ends after a
        i = bisect_left(starts, b)
        return i == 0 or reach[i - 1] <= a
    return [(a, b, k) for a, b, k in found if free(a, b)]


def _word_before(text: str, end: int) -> tuple[str | None, int]:
    """The word that ends, but for blanks, at ``end``, and its start."""
    while end and text[end - 1] in " \t":
        end -= 1
    start = end
    while start and end - start <= CONTEXT_WORD and not text[start - 1].isspace():
        start -= 1
    return (text[start:end] if 0 < end - start <= CONTEXT_WORD else None), start


def lexical_patterns(text: str, start: int, end: int) -> list[str]:
    """The words around a span: two before; one before and one after; one before; one after.
    Blanks of any number may lie between; a run of over ``CONTEXT_WORD`` characters is no word,
    so it gives no pattern (else each address of an unbroken list would carry the list)."""
    second, begin = _word_before(text, start)
    first = _word_before(text, begin)[0] if second else None
    after = _AFTER.match(text, end)
    after = after[1] if after else None
    first, second, after = (_DIGIT.sub("0", w.lower()) if w else None for w in (first, second, after))
    out = []
    if first and second:
        out.append(f"{first} {second} _")
    if second and after:
        out.append(f"{second} _ {after}")
    if second:
        out.append(f"{second} _")
    if after:
        out.append(f"_ {after}")
    return out


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("seed", pa.string()),
                                 ("kinds", pa.list_(pa.string())), ("instance", pa.string()),
                                 ("patterns", pa.list_(pa.string()))]))
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            text = text.as_py() or ""
            base = base_spans(text)
            found = [(a, b, KINDS[k], [KINDS[k]]) for a, k, b in base]
            found += [(a, b, None, kinds) for a, b, kinds in candidates(text, base)]
            rows.append([{"start": a, "end": b, "seed": seed, "kinds": kinds,
                          "instance": " ".join(text[a:b].lower().split()), "patterns": lexical_patterns(text, a, b)}
                         for a, b, seed, kinds in found])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_id"), pa.array(rows, schema)],
                                         names=["doc_id", "row_id", "mentions"])


MENTIONS = ("array<struct<start:bigint,end:bigint,seed:string,kinds:array<string>,instance:string,"
            "patterns:array<string>>>")


def mentions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row_id, mentions) of every row: base spans (``seed`` set) and candidates."""
    ship(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row_id"),
                         F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_mentions, f"doc_id {kind}, row_id bigint, mentions {MENTIONS}")


def discover(found: DataFrame, accept: float = ACCEPT, shrink: float = SHRINK) -> DataFrame:
    """(instance, kind, belief) of the accepted candidates of staged ``mentions``."""
    m = found.select(F.explode("mentions").alias("m")).select("m.*")
    seeds = m.where("seed is not null").select("instance", F.col("seed").alias("kind")).distinct()
    allowed = m.where("seed is null").select("instance", F.explode("kinds").alias("kind")).distinct() \
        .join(seeds.select("instance").distinct(), "instance", "left_anti")
    edges = stage(m.select(F.explode("patterns").alias("pattern"), "instance").distinct(), "pii-edges")
    size = stage(edges.groupBy("pattern").agg(F.count("*").alias("size")), "pii-sizes")
    certain = stage(seeds.withColumn("belief", F.lit(1.0)), "pii-seeds")
    possible = stage(allowed.join(edges, "instance"), "pii-candidates")
    accepted, state = None, None
    while True:
        known = certain if accepted is None else certain.union(accepted)
        confidence = edges.join(known, "instance").groupBy("pattern", "kind").agg(F.sum("belief").alias("sum")) \
            .join(size, "pattern") \
            .select("pattern", "kind", (F.col("sum") / (F.col("size") + F.lit(shrink))).alias("confidence"))
        belief = possible.join(confidence, ["pattern", "kind"]).groupBy("instance", "kind") \
            .agg((1 - F.exp(F.sum(F.log1p(-F.least("confidence", F.lit(1 - 1e-9)))))).alias("belief")) \
            .where(F.col("belief") >= accept) \
            .select("instance", "kind", (F.floor(F.col("belief") * 1000) / 1000).alias("belief"), F.lit(False).alias("held"))
        if accepted is not None:
            belief = belief.union(accepted.withColumn("held", F.lit(True))).groupBy("instance", "kind") \
                .agg(F.max("belief").alias("belief"), F.max("held").alias("held"))
        # The kind under which an instance was accepted stays; else the most believed one.
        best = belief.groupBy("instance").agg(F.max(F.struct("held", "belief", "kind")).alias("best"))
        before, accepted = accepted, stage(best.select("instance", "best.kind", "best.belief"), "pii-accepted")
        now = accepted.agg(F.count("*"), F.sum(F.round(F.col("belief") * 1000).cast("bigint"))).first()
        if before is not None:
            drop_staged(before)
        if now == state or not now[0]:
            return accepted
        state = now


def extract(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, base, spans) of every row: arrays of (start, kind, end), base
    spans first by start then kind; ``spans`` holds the discovered ones too."""
    found = stage(mentions(docs, doc_id, text), "pii-mentions")
    accepted = discover(found, **options)
    added = found.select("row_id", F.explode(F.filter("mentions", lambda x: x["seed"].isNull())).alias("m")) \
        .select("row_id", "m.start", "m.end", "m.instance").join(accepted.select("instance", "kind"), "instance") \
        .groupBy("row_id").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))

    def number(kind):
        return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)

    def ordered(spans):
        keyed = F.transform(spans, lambda s: F.struct(s["start"], number(s["kind"]).alias("n"), s["end"], s["kind"]))
        return F.transform(F.array_sort(keyed), lambda s: F.struct(s["start"], s["kind"], s["end"]))

    base = F.transform(F.filter("mentions", lambda x: x["seed"].isNotNull()),
                       lambda x: F.struct(x["start"].alias("start"), x["seed"].alias("kind"), x["end"].alias("end")))
    return found.select("doc_id", "row_id", base.alias("base")).join(added, "row_id", "left").select(
        "doc_id", ordered(F.col("base")).alias("base"),
        ordered(F.concat("base", F.coalesce("added", F.filter("base", lambda s: F.lit(False))))).alias("spans"))


def joined(spans) -> "Column":  # noqa: F821
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
