from decimal import Decimal

from shopscope.operators import quality as K
from shopscope.plans.warehouse import ALL_TABLES, open_warehouse
from shopscope.schemas import NUMERIC_SIZES, PRIMARY_KEYS, VARCHAR_LENGTHS

from conftest import SMALL, rows


def test_pk_duplicates_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2), ("c", None)], "k1 string, k2 int")
    got = sorted(rows(K.pk_violations({"t": (df, ["k1", "k2"])})))
    assert got == [("t", "<null>|2", 1, "null key"), ("t", "a|1", 2, "duplicate key"),
                   ("t", "c|<null>", 1, "null key")]


def test_fk_orphans(spark):
    child = spark.createDataFrame([("o1", "c1"), ("o2", "c9"), ("o3", "c9"), ("o4", None)], "id string, fk string")
    parent = spark.createDataFrame([("c1",)], "pk string")
    got = rows(K.fk_orphans([("orders", child, "fk", "customers", parent, "pk")]))
    assert got == [("orders", "fk", "customers", "c9", 2)]


def test_scale_and_length(spark):
    df = spark.createDataFrame([(Decimal("123456789.00"), "ABCDEF"), (Decimal("1.00"), "AB"), (None, None)],
                               "price decimal(18,2), state string")
    scale = rows(K.scale_violations({"t": (df, {"price": (10, 2)})}))
    assert scale == [("t", "price", "numeric(10,2)", 1, "123456789.00")]
    length = rows(K.length_violations({"t": (df, {"state": 5})}))
    assert length == [("t", "state", "varchar(5)", 1, "6")]


def test_checks_measured_while_writing_equal_the_reports(spark, scratch):
    orders = [(None if i == 7 else f"o{i}", i, Decimal(10) ** (i % 12), "x" * (45 + i % 9)) for i in range(500)]
    items = spark.createDataFrame(orders, "order_id string, order_item_id int, price decimal(18,2), seller_id string") \
        .repartition(5)
    fact = items.withColumnRenamed("price", "revenue")
    seen = {}
    for name, df, sizes, lengths in (("order_items", items, {"price": (10, 2)}, {"seller_id": 50}),
                                     ("fact_orders", fact, {"revenue": (10, 2)}, {})):
        frame, result = K.measured(df, name, ["order_id"], sizes, lengths)
        frame.write.parquet(f"{scratch}/{name}")
        got = spark.createDataFrame(result(), K.MEASURED)
        assert sorted(rows(K.violations_of(got, "scale"))) == sorted(rows(K.scale_violations({name: (df, sizes)})))
        if lengths:
            assert rows(K.violations_of(got, "length")) == rows(K.length_violations({name: (df, lengths)})) != []
        assert rows(K.violations_of(got, "null key")) == [(name, "order_id", "not null", 1, None)]
        seen[name] = {r["row_count"] for r in got.collect()}
    assert seen == {"order_items": {500}, "fact_orders": {500}}
    empty, result = K.measured(items.where("false"), "order_items", ["order_id"], {"price": (10, 2)})
    empty.write.parquet(f"{scratch}/empty")
    assert {r[4] for r in result()} == {r[6] for r in result()} == {0}


def test_warehouse_checks_equal_a_second_reading(spark):
    wh = open_warehouse(spark, SMALL)
    checks = wh.checks()
    assert wh.counts() == {n: wh.table(n).count() for n in ALL_TABLES}
    for kind, again in (("scale", K.scale_violations({t: (wh.table(t), c) for t, c in NUMERIC_SIZES.items()})),
                        ("length", K.length_violations({t: (wh.table(t), c) for t, c in VARCHAR_LENGTHS.items()}))):
        assert sorted(rows(K.violations_of(checks, kind))) == sorted(rows(again))
    measured = {(r["table_name"], r["column_name"]) for r in checks.where("check_name = 'null key'").collect()}
    assert measured == {(t, k) for t, keys in PRIMARY_KEYS.items() for k in keys}
