"""URL filters as a sort-merge range join (DataFrame functions only).

A host becomes a canonical key: its labels in reverse order, each in hex and
ended by a space, so ``www.example.com`` is the keys of ``com``, ``example``
and ``www`` one after the other. A rule for a host and all its subdomains is
then the interval from the host's key to that key followed by ``Z`` (above
every hex digit). Intervals of rules nest or are disjoint.

Every end of an interval carries the stack of rules that are active behind it,
the longest first: opening a host puts its rules before those of the hosts
around it, closing takes them off again. Urls and interval ends are sorted
together by key, and the sweep hands each url the last stack before it (a
running ``last`` over the sorted rows). The url's rule is the first on the
stack whose path is a prefix of the url's.

The sorted sweep runs in slices: a url is in one slice by a hash of its id, so
slices are even whatever host is frequent, and the interval ends are in every
slice. Slices hold at least ten urls per interval end, so that the copies of
the rules add little to the sort however many rules there are.

Longest means the longest ``host + path``; then the longer host, then block
before allow. A url that no rule fits gets ``default`` (allow).

Cases: a null url, or one without ``://``, has an empty host and path, which no
rule fits. Null, empty or repeated rules count once or not at all: a rule
without a host is ignored, a null path is ``/``. Repeated rows are judged one
by one. Input columns named like an output column are replaced; others pass
through. An empty table gives no rows; without rules every url gets the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import free_name

URLS_PER_SLICE = 50_000
RULE_FIELDS = "host string, path string, verdict string"


def url_host(url: Column) -> Column:
    """From behind the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Reversed labels, in hex (the order of the UTF-8 bytes), each ended by a space."""
    labels = F.reverse(F.split(host, r"\.", -1))
    return F.array_join(F.transform(labels, lambda x: F.concat(F.hex(x.cast("binary")), F.lit(" "))), "")


def interval_ends(rules: DataFrame) -> DataFrame:
    """(key, stack): both ends of every rule host's interval, with the rules
    active behind it. ``rules`` has host, path and verdict."""
    clean = (rules.select(F.lower("host").alias("host"), F.coalesce("path", F.lit("/")).alias("path"), "verdict")
             .where("host <> '' and verdict is not null"))
    rule = F.struct(
        (-F.length(F.concat("host", "path"))).alias("order_1"), (-F.length("host")).alias("order_2"),
        (F.col("verdict") != "block").alias("order_3"), "host", "path", "verdict")
    hosts = clean.select(host_key(F.col("host")).alias("key"), "host", rule.alias("rule")) \
        .groupBy("key").agg(F.first("host").alias("host"), F.collect_set("rule").alias("rules"))
    # A host's stack: its own rules and those of every rule host around it, which
    # are the hosts of its trailing labels.
    labels = F.split("host", r"\.", -1)
    around = hosts.select("key", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: host_key(F.array_join(F.slice(labels, i, F.size(labels)), ".")))).alias("outer"))
    active = around.join(hosts.select(F.col("key").alias("outer"), "rules"), "outer") \
        .groupBy("key").agg(
            F.sort_array(F.flatten(F.collect_list("rules"))).alias("inside"),
            F.sort_array(F.flatten(F.collect_list(F.when(F.col("outer") != F.col("key"), F.col("rules")))))
            .alias("outside"))
    return active.select(F.explode(F.array(
        F.struct("key", F.col("inside").alias("stack")),
        F.struct(F.concat("key", F.lit("Z")).alias("key"), F.col("outside").alias("stack")))).alias("end")) \
        .select("end.key", "end.stack")


def judge_urls(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
               default: str = "allow", urls_per_slice: int = URLS_PER_SLICE) -> DataFrame:
    """``pages`` plus host, path, rule (null if none fits) and verdict."""
    ends = interval_ends(rules)
    slices = max(1, -(-pages.count() // max(urls_per_slice, 10 * ends.count())))
    key, stack, part, is_url, found = (free_name(pages, f"_url_{n}") for n in
                                       ("key", "stack", "slice", "row", "found"))
    out = ("host", "path", "rule", "verdict")
    rest = [c for c in pages.columns if c.lower() not in out]
    urls = pages.select(
        *rest, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"),
        F.pmod(F.xxhash64(page_id, url), F.lit(slices)).alias(part), F.lit(True).alias(is_url))
    urls = urls.withColumn(key, host_key(F.col("host")))
    events = ends.select(F.col("key").alias(key), F.col("stack").alias(stack),
                         F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint"))).alias(part),
                         F.lit(False).alias(is_url))
    sweep = W.partitionBy(part).orderBy(key, is_url).rowsBetween(W.unboundedPreceding, W.currentRow)
    swept = urls.unionByName(events, allowMissingColumns=True) \
        .withColumn(stack, F.last(stack, ignorenulls=True).over(sweep)).where(F.col(is_url))
    fits = F.filter(F.col(stack), lambda r: F.col("path").startswith(r["path"]))
    return swept.withColumn(found, F.get(fits, F.lit(0))).select(
        *rest, "host", "path",
        F.concat(F.col(f"{found}.host"), F.col(f"{found}.path")).alias("rule"),
        F.coalesce(F.col(f"{found}.verdict"), F.lit(default)).alias("verdict"))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given in code, as a table of SQL literals."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))
