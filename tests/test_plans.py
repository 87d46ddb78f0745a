"""Physical plan properties: pushdown, pruning, no single-task customer window."""

from shopscope.plans import retention as T
from shopscope.plans import revenue as R
from shopscope.plans.warehouse import open_warehouse

from conftest import SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_status_filter_and_columns_reach_the_scan(spark):
    fact = open_warehouse(spark, SMALL).table("fact_orders")
    text = plan_text(R.kpi_summary(fact))
    assert "PushedFilters: [IsNotNull(order_status), EqualTo(order_status,delivered)]" in text
    scan = [line for line in text.splitlines() if "ReadSchema" in line][0]
    assert "customer_city" not in scan and "order_status" in scan


def test_customer_tiles_do_not_use_a_global_window(spark):
    fact = open_warehouse(spark, SMALL).table("fact_orders")
    text = plan_text(T.customer_clv(fact))
    # The only global window left is over the per-partition offsets table.
    assert "ntile(" not in text.lower()


def test_customer_aggregation_combines_before_its_only_shuffle(spark):
    wh = open_warehouse(spark, SMALL)
    df = T.retention_rate(wh.table("fact_orders"), orders=wh.table("order_summary"))
    text = plan_text(df)
    # One shuffle of partial counts per customer, then the one-row total: the
    # orders of one customer (or of none) are never gathered in one task.
    assert text.count("Exchange") == 2 and "partial_count" in text.split("Exchange hashpartitioning")[1]


def test_size_probe_merges_one_row_per_task(spark):
    from shopscope.operators import sizing
    df = spark.range(1000).selectExpr("id", "repeat('x', 10) AS t").repartition(4)
    assert sizing.side_bytes(df) == 1000 * (16 * 3 + 10)
    plan = plan_text(sizing.bounded_broadcast(df, max_bytes=10))
    assert "broadcast" not in plan.lower() and "GlobalLimit" not in plan


def test_no_broadcast_without_a_bound(spark):
    # The planner's file-size estimate alone never triggers a broadcast.
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    wh = open_warehouse(spark, SMALL)
    joined = wh.table("order_items").join(wh.table("order_payments_aggregated"), "order_id")
    assert "BroadcastExchange" not in joined._jdf.queryExecution().sparkPlan().toString()


def test_review_join_on_bucketed_fact_needs_no_shuffle(spark):
    wh = open_warehouse(spark, SMALL)
    df = R.top_products(wh.table("fact_orders"), wh.table("products"), wh.table("order_reviews"))
    text = plan_text(df)
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and "product_id" in shuffles[0]


def test_cohorts_scan_and_shuffle_customers_once(spark):
    wh = open_warehouse(spark, SMALL)
    text = plan_text(T.cohort_retention(wh.table("fact_orders"), orders=wh.table("order_summary")))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning(customer_unique_id") == 1


def test_orphans_count_child_keys_before_the_join(spark):
    from shopscope.operators.quality import fk_orphans
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(2,)], "p int")
    df = fk_orphans([("c", child, "k", "parents", parent, "p")])
    assert [(r["key_value"], r["row_count"]) for r in df.collect()] == [("1", 2)]
    text = plan_text(df)
    assert text.index("Join") < text.index("partial_count")  # the join stands above the count


def test_tiles_share_one_customer_shuffle_and_run_nothing_early(spark):
    wh = open_warehouse(spark, SMALL)
    fact, orders = wh.table("fact_orders"), wh.table("order_summary")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("tiles-built", "tiles-built")
    df = T.rfm_segments(fact, "2001-08-02", orders)
    text = plan_text(df)
    assert len(tracker.getJobIdsForGroup("tiles-built")) == 0
    assert "ntile(" not in text.lower() and "ExistingRDD" not in text  # as a checkpoint shows
    df.collect()
    # After the run the stages show which shuffles were made and which reused.
    lines = plan_text(df).splitlines()
    stages = [b for a, b in zip(lines, lines[1:]) if "ShuffleQueryStage" in a
              and "Exchange hashpartitioning(customer_unique_id" in b or "ReusedExchange [customer_unique_id" in b]
    made = [x for x in stages if "ReusedExchange" not in x]
    assert 1 <= len(made) <= 2 and len(stages) > len(made)
