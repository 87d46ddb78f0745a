"""Keep-first as an aggregate equals keep-first as a window (property test)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopscope.operators.dedup import first_per_key, latest_first

rows = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("abc")),
                          st.one_of(st.none(), st.integers(0, 3)),
                          st.text("xyz", max_size=2)), max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_first_per_key_equals_row_number(spark, data):
    base = dt.datetime(2020, 1, 1)
    df = spark.createDataFrame(
        [(k, None if d is None else base + dt.timedelta(days=d), v, i) for i, (k, d, v) in enumerate(data)],
        "k string, ts timestamp_ntz, v string, ingest_seq long")
    got = sorted((tuple(r) for r in first_per_key(df, ["k"], latest_first("ts")).collect()), key=repr)
    w = Window.partitionBy("k").orderBy(F.col("ts").desc_nulls_last(), F.col("ingest_seq"))
    want = sorted((tuple(r) for r in df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn").collect()),
                  key=repr)
    assert got == want
