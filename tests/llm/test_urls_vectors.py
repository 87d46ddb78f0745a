"""URL filter and nearest neighbours: brute force and edge rows."""

import random

import numpy as np
import pytest

from shopscope.llm import ann, url_filter

URLS = [
    "http://a.example.com/en/x?q=/de/", "https://WWW.Example.COM/en/", "https://example.com", "x://net/es/1",
    "no scheme", None, "", "http://", "http:///en/", "http://sub.net/fr/#/es/", "http://net/esx", "http://xnet/es/",
    "http://a.b.example.com/en", "http://com.", "http://..com/", "mailto:x http://y.com/en/ ://z",
    "http://example.com:80/en/", "http://\u00c4.com/\U0001f600", "http://net?/es/", "http://net/es/\n://x",
]
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def judge(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), v == "block", h, p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    _, _, _, h, p, v = max(fits, key=lambda f: f[:3])
    return host, path, h + p, v


def check(spark, urls, rules, **options):
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)],
                                  "page_id bigint, url string, verdict string, _url_key string")
    table = spark.createDataFrame(rules, url_filter.RULE_FIELDS)
    got = url_filter.judge_urls(pages, table, **options)
    assert got.columns == ["page_id", "url", "_url_key", "host", "path", "rule", "verdict"]
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()} \
        == {i: judge(u, rules) for i, u in enumerate(urls)}


def test_urls_match_brute_force(spark):
    check(spark, URLS, RULES)
    check(spark, URLS, [("com", "/", "allow"), ("com", "/", "block"), ("b.example.com", "/", "block")])
    check(spark, URLS, [])
    check(spark, [], RULES)


def test_many_rules_and_slices(spark):
    rng = random.Random(2)
    names = ["a", "b", "c.a", "b.a", "a.b.a", "x.c.a", "c"]
    paths = ["/", "/p", "/p/q", "/q/"]
    rules = [(rng.choice(names), rng.choice(paths), "block") for _ in range(14)]
    rules += [(rng.choice(names), p + "z", "allow") for p in paths]
    urls = [f"http://{rng.choice(['', 'w.', 'a.'])}{rng.choice(names)}{rng.choice(paths)}{rng.choice(['', 'z', '/q'])}"
            for _ in range(900)]
    check(spark, urls, rules, urls_per_slice=50)


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    plan = url_filter.judge_urls(pages, url_filter.rule_table(spark, RULES))._jdf.queryExecution().executedPlan() \
        .toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string, shard string, dim int")


def brute(rows, k):
    good = {}
    for i, v, *_ in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        v = [float(np.float32(x)) for x in v]
        good[i] = min(good.get(i, v), v)
    out = set()
    for q in good:
        if q % 10:
            continue
        near = sorted((float(np.sqrt(((np.array(v) - np.array(good[q])) ** 2).sum())), i)
                      for i, v in good.items() if i != q and len(v) == len(good[q]))[:k]
        out |= {(q, r + 1, i, d) for r, (d, i) in enumerate(near)}
    return out


def test_neighbours_on_edge_rows(spark):
    from pyspark.sql import functions as F
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (10, None), (20, []), (30, [0.0, 0.0]),
            (40, [nan, 1.0]), (50, [inf, 1.0]), (60, [None, 1.0]), (None, [1.0, 1.0]), (70, [3.0, 1.0, 2.0]),
            (71, [3.0, 1.0, 1.0]), (80, [5.0, 5.0]), (80, [5.0, 4.0]), (80, [5.0, 4.0]), (90, [7.0])]
    rows = [(i, v, "x", "y", 3) for i, v in rows]
    got = ann.nearest_neighbours(vectors(spark, rows), F.col("vec_id") % 10 == 0, k=3)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert {tuple(r) for r in got.collect()} == brute(rows, 3)
    assert ann.nearest_neighbours(vectors(spark, []), F.col("vec_id") % 10 == 0).count() == 0


@pytest.mark.parametrize("cluster", [0, 300])
def test_recall_over_shards(spark, cluster):
    """Gaussian vectors over several shards, without and with a dense cluster."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 24))
    x[:cluster] = x[0] + rng.normal(size=(cluster, 24)) / 30
    rows = [(i, v.tolist(), "", "", 0) for i, v in enumerate(x.astype(np.float32))]
    got = {tuple(r) for r in ann.nearest_neighbours(vectors(spark, rows), F.col("vec_id") % 10 == 0, k=10,
                                                    shard_rows=400).collect()}
    want = brute(rows, 10)
    assert len(got) == len(want)
    assert len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}) > 0.97 * len(want)


@pytest.mark.parametrize("factor,offset", [(1e25, 0), (1e-25, 0), (1e-3, 100)])
def test_recall_of_large_small_and_far_vectors(spark, factor, offset):
    from pyspark.sql import functions as F
    x = np.random.default_rng(9).normal(size=(800, 16)) * factor + offset
    rows = [(i, v.tolist(), "", "", 0) for i, v in enumerate(x.astype(np.float32))]
    got = {tuple(r) for r in ann.nearest_neighbours(vectors(spark, rows), F.col("vec_id") % 10 == 0, k=10).collect()}
    want = brute(rows, 10)
    assert len(got) == len(want)
    assert len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}) > 0.97 * len(want)


def test_distances_beyond_the_range_of_squares():
    a, b = np.array([[3e200, 0.0], [1e-200, 0.0]]), np.array([[0.0, 4e200], [0.0, 0.0]])
    assert ann._distance(a[:1], b[:1]) == pytest.approx([5e200]) and ann._distance(a[1:], b[1:]) == [1e-200]


def test_registered_query_finds_the_nearest(spark):
    from conftest import MEDIUM
    from shopscope.llm.queries import QUERIES
    rows = [r for r in spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]
    good = {r["vec_id"]: np.array(r["embedding"], float) for r in rows if r["embedding"] is not None}
    ids, x = np.array(list(good)), np.stack(list(good.values()))
    got = {}
    for r in QUERIES["op5_ann"](spark, MEDIUM).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert set(got) == {i for i in good if i % 100 == 0}
    hits = 0
    for q, found in got.items():
        d = ((x - good[q]) ** 2).sum(axis=1)
        order = [i for i in ids[np.lexsort((ids, d))].tolist() if i != q][:10]
        hits += len(found & set(order))
    assert hits >= 0.9 * 10 * len(got)


def test_many_equal_vectors(spark):
    """A third of all rows hold one vector, more hold a few others: ties go to the smaller ids."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(6)
    x = rng.normal(size=(900, 8))
    x[::3] = x[0]
    x[1:300:3] = x[rng.integers(1, 20, 100)]
    rows = [(i, v.tolist(), "", "", 0) for i, v in enumerate(x.astype(np.float32))]
    found = ann.nearest_neighbours(vectors(spark, rows), F.col("vec_id") % 10 == 0, k=10, shard_rows=300)
    got, want = {tuple(r) for r in found.collect()}, brute(rows, 10)
    assert len(got) == len(want) and len(got & want) > 0.97 * len(want)
    for q in range(0, 900, 30):  # queries with the common vector: exact
        assert {r for r in got if r[0] == q} == {r for r in want if r[0] == q}


def test_pruned_edges_are_diverse():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [-3, 0]], np.float32)
    squares = (points ** 2).sum(axis=1)
    cand = np.array([[1, 2, 3, 4, 1, -1, 0]])
    dist = ((points[np.where(cand < 0, 0, cand)] - points[0]) ** 2).sum(axis=2)
    assert ann.robust_prune(points, squares, np.array([0]), cand, dist, 4, 1.0).tolist() == [[1, 3, 4, -1]]
