"""The distributed NTILE equals the single-partition window function."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopscope.operators.ranking import ascending, descending, distributed_ntile, exact_tiles, global_row_number


def _check(spark, data, k, partitions=8):
    df = spark.createDataFrame(data, "id long, v long")
    order = [F.col("v").desc_nulls_first(), F.col("id").asc()]
    got = {r["id"]: r["t"] for r in distributed_ntile(df, k, order, name="t", partitions=partitions).collect()}
    want = {r["id"]: r["t"] for r in df.select("id", F.ntile(k).over(Window.orderBy(*order)).alias("t")).collect()}
    assert got == want


@pytest.mark.parametrize("n,k,distinct", [(0, 5, 3), (3, 5, 3), (10, 4, 1), (1001, 5, 4), (997, 4, 500),
                                          (2000, 5, 2000)])
def test_ntile_matches_window(spark, n, k, distinct):
    rnd = random.Random(n * 31 + k)
    data = [(i, rnd.randrange(distinct) if rnd.random() > 0.05 else None) for i in range(n)]
    _check(spark, data, k)


def test_ntile_heavy_tie_spreads_over_partitions(spark):
    # One value holds a third of all rows; the unique tie-break splits it.
    data = [(i, 7 if i % 3 == 0 else i) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, v long")
    ranked = global_row_number(df, [F.col("v").asc(), F.col("id").asc()], name="rn", partitions=8)
    per_part = ranked.filter("v = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_part) > 1
    assert sorted(r["rn"] for r in ranked.collect()) == list(range(1, 3001))
    _check(spark, data, 5)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=120),
       k=st.integers(1, 7), partitions=st.integers(1, 9))
def test_ntile_property(spark, values, k, partitions):
    data = [(i, v) for i, v in enumerate(values)]
    _check(spark, data, k, partitions=partitions)


def _check_tiles(spark, data, k, **size):
    """Tiles of two orders at once equal the window function's."""
    df = spark.createDataFrame(data, "id long, v long, d decimal(20,2)")
    by_v, by_d = F.col("v").desc_nulls_first(), F.col("d").asc_nulls_last()
    want = {r["id"]: (r["a"], r["b"]) for r in df.select(
        "id", F.ntile(k).over(Window.orderBy(by_v, F.col("id").asc())).alias("a"),
        F.ntile(k + 1).over(Window.orderBy(by_d, F.col("id").asc())).alias("b")).collect()}
    tiled = exact_tiles(df, {"a": (k, [*descending(F.col("v")), F.col("id")]),
                             "b": (k + 1, [*ascending(F.col("d")), F.col("id")])}, **size)
    assert {r["id"]: (r["a"], r["b"]) for r in tiled.collect()} == want


@pytest.mark.parametrize("n,k,distinct", [(0, 5, 3), (1, 2, 1), (3, 5, 3), (1001, 5, 1), (997, 4, 500), (3000, 5, 3000)])
def test_exact_tiles_match_window(spark, n, k, distinct):
    rnd = random.Random(n * 31 + k)
    data = [(i, rnd.randrange(distinct) if rnd.random() > 0.05 else None,
             Decimal(rnd.randrange(distinct * 7)) / 100 if rnd.random() > 0.3 else None) for i in range(n)]
    _check_tiles(spark, data, k, width=2)  # so that ranges hold many rows
    _check_tiles(spark, data, k)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3)), max_size=80), k=st.integers(2, 6),
       width=st.sampled_from([1, 2, 8]))
def test_exact_tiles_property(spark, values, k, width):
    data = [(i, v, None if v is None else Decimal(v * v)) for i, v in enumerate(values)]
    _check_tiles(spark, data, k, width=width)
