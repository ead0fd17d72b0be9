"""SQL semantics the analyses depend on (SURVEY T-rules), checked on Spark."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from casebook.functions.cleaning import number_in, to_int_array
from casebook.functions.numeric import exact_avg
from casebook.operators import dense_rank_by, first_rows, rank_by, running_sum
from casebook.operators.sequence import sequence_number
from casebook.operators.schedule import payment_schedule
from tests.conftest import rows

D = dt.date


def test_running_sum_includes_same_day_peers(spark):  # T10
    df = spark.createDataFrame([(1, D(2020, 1, 1), 10), (1, D(2020, 1, 1), 5), (1, D(2020, 1, 2), -3),
                                (2, D(2020, 1, 1), 7)], "c int, d date, v int")
    r = rows(running_sum(df, "c", "d", "v", "bal"), "c", "d", "v", "bal")
    assert r == [(1, D(2020, 1, 1), 5, 15), (1, D(2020, 1, 1), 10, 15), (1, D(2020, 1, 2), -3, 12),
                 (2, D(2020, 1, 1), 7, 7)]


def test_rank_helpers_match_sql(spark):  # W1, W4, T11
    df = spark.createDataFrame([("A", 1), ("A", 1), ("A", 3), ("B", 2)], "k string, d int")
    assert rows(rank_by(df, "k", "d", "r"), "k", "d", "r") == [("A", 1, 1), ("A", 1, 1), ("A", 3, 3), ("B", 2, 1)]
    assert rows(dense_rank_by(df, "k", "d", "r"), "k", "d", "r") == [
        ("A", 1, 1), ("A", 1, 1), ("A", 3, 2), ("B", 2, 1)]
    assert len(first_rows(df, "k", "d").collect()) == 3


def test_sequence_number_spans_days(spark):  # W2 without one hot task
    df = spark.createDataFrame([(1, D(2020, 1, 2), "b"), (1, D(2020, 1, 1), "z"), (1, D(2020, 1, 2), "a")],
                               "c int, d date, t string")
    assert rows(sequence_number(df, "c", "d", "t"), "d", "t", "seq") == [
        (D(2020, 1, 1), "z", 1), (D(2020, 1, 2), "a", 2), (D(2020, 1, 2), "b", 3)]


def test_zip_explode_pads_short_side(spark):  # T2
    df = spark.createDataFrame([([1, 2], [9]), (None, None)], "a array<int>, b array<int>")
    z = df.select(F.explode(F.arrays_zip(F.coalesce("a", F.array().cast("array<int>")),
                                         F.coalesce("b", F.array().cast("array<int>")))).alias("z"))
    assert len(z.collect()) == 2


def test_cleaning_units_and_lists(spark):  # F3, F5, S10, T18
    df = spark.createDataFrame([("20km", "25mins", "1, 4"), ("23.4 km", "15 minute", ""),
                                ("null", "null", "null"), (None, None, None)], "a string, b string, c string")
    r = df.select(number_in("a").alias("a"), number_in("b", "int").alias("b"), to_int_array("c").alias("c"))
    got = [tuple(x) for x in r.collect()]
    assert got == [(Decimal("20.00"), 25, [1, 4]), (Decimal("23.40"), 15, None), (None, None, None),
                   (None, None, None)]


def test_exact_avg_rounds_half_away(spark):  # T20 with decimal inputs
    df = spark.createDataFrame([(Decimal("1.00"),), (Decimal("1.01"),)], "x decimal(18,2)")
    assert df.agg(exact_avg("x").alias("a")).first()["a"] == Decimal("1.01")
    neg = spark.createDataFrame([(Decimal("-1.00"),), (Decimal("-1.01"),)], "x decimal(18,2)")
    assert neg.agg(exact_avg("x").alias("a")).first()["a"] == Decimal("-1.01")


def test_payment_series_guard_and_month_step(spark):  # T4, T5
    plans = spark.createDataFrame([(1, "basic monthly", Decimal("9.90")), (2, "pro monthly", Decimal("19.90")),
                                   (3, "pro annual", Decimal("199.00")), (4, "churn", None)],
                                  "plan_id int, plan_name string, price decimal(5,2)")
    subs = spark.createDataFrame([(1, 1, D(2020, 1, 31)), (1, 2, D(2020, 3, 15)), (2, 1, D(2021, 2, 1)),
                                  (3, 2, D(2020, 5, 10)), (3, 3, D(2020, 6, 20)), (4, 1, D(2020, 11, 1)),
                                  (4, 4, D(2020, 12, 5))], "customer_id int, plan_id int, start_date date")
    p = payment_schedule(subs, plans, "2020-12-31")
    c1 = rows(p.filter("customer_id = 1"), "payment_date", "plan_id", "amount")
    assert c1[:3] == [(D(2020, 1, 31), 1, Decimal("9.90")), (D(2020, 2, 29), 1, Decimal("9.90")),
                      (D(2020, 3, 15), 2, Decimal("10.00"))]                 # upgrade credit
    assert rows(p.filter("customer_id = 2")) == []                            # starts after the cap
    c3 = rows(p.filter("customer_id = 3"), "payment_date", "plan_id")
    assert c3 == [(D(2020, 5, 10), 2), (D(2020, 6, 10), 2), (D(2020, 7, 10), 3)]  # annual at period end
    # churn on Dec 5 stops payments after the Dec 1 one
    assert rows(p.filter("customer_id = 4"), "payment_date") == [(D(2020, 11, 1),), (D(2020, 12, 1),)]


def test_ancestors_union_semantics_stop_on_cycle(spark):  # T21, U5
    from casebook.operators.hierarchy import ancestors
    edges = spark.createDataFrame([(1, None), (2, 1), (3, 2), (10, 12), (11, 10), (12, 11)],
                                  "id int, parent_id int")
    got = rows(ancestors(edges), "id", "ancestor_id", "depth")
    assert (3, 1, 2) in got and (3, 2, 1) in got and (2, 1, 1) in got
    cyc = [g for g in got if g[0] >= 10]
    assert sorted((a, b) for a, b, _ in cyc) == [(a, b) for a in (10, 11, 12) for b in (10, 11, 12)]
    assert max(d for _, _, d in cyc) == 3


def test_ancestors_of_a_long_chain(spark):  # U5: no depth limit
    from casebook.operators.hierarchy import ancestors
    edges = spark.createDataFrame([(i, i - 1 if i else None) for i in range(100)], "id int, parent_id int")
    got = ancestors(edges)
    assert got.count() == 4950 and got.where("depth <> id - ancestor_id").count() == 0


def test_append_keeps_what_was_there(spark):  # S7
    from casebook.sources.catalog import append, create_table, drop_table, full_name, replace_table
    from casebook.sources.io import drop_stages, materialize
    one, two = spark.range(3), spark.range(10, 12)
    read = lambda: spark.table(full_name(spark, "append_test"))
    replace_table(one, "append_test")
    assert append(two, "append_test").count() == 5 and read().count() == 5
    assert replace_table(two, "append_test").count() == 2 and read().count() == 2
    drop_table(spark, "append_test")
    create_table(two, "append_test")
    assert append(one, "append_test").count() == 5
    drop_table(spark, "append_test")
    staged = materialize(one, "drop_test")
    path = staged.inputFiles()[0]
    assert drop_stages(spark) >= 1
    import os
    assert not os.path.exists(path.removeprefix("file://"))


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_read_files_with_declared_schema(spark, tmp_path, fmt):  # S1
    from casebook.sources.tables import read_files
    schema = "customer_id string, order_date date, product_id int"
    df = spark.createDataFrame([("A", D(2021, 1, 1), 1), ("B", D(2021, 1, 2), 2)], schema)
    path = str(tmp_path / fmt)
    opts = {"header": "true"} if fmt == "csv" else {}
    df.write.format(fmt).options(**opts).save(path)
    back = read_files(spark, path, schema, fmt, **opts)
    assert back.schema == df.schema and rows(back) == rows(df)


def test_broadcast_only_when_estimate_is_small(spark):
    from casebook.operators.broadcast import broadcast_if_small
    from casebook.sources.subjects import literal_table
    small = literal_table(spark, [(1, "a")], "k int, v string")
    big = spark.range(0, 10_000_000).withColumnRenamed("id", "k")
    j1 = big.join(broadcast_if_small(small), "k")
    j2 = small.join(broadcast_if_small(big, max_bytes=1024), "k")
    # rows from createDataFrame have no size estimate: never hinted
    assert broadcast_if_small(spark.createDataFrame([(1,)], "k int")) is not None
    assert "broadcast" in j1._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in j2._jdf.queryExecution().analyzed().toString().lower()


def test_append_keeps_to_the_version_of_its_run(spark, monkeypatch):
    """Another run of op_S7 starts between the two steps of the first."""
    from casebook.plans import all_queries
    from casebook.sources import catalog
    foreign, append = spark.range(3).selectExpr("id as c_custkey", "'x' as c_name", "0D as c_acctbal"), catalog.append

    def disturbed(df, name):
        catalog.replace_table(foreign, "customers_by_part")
        return append(df, name)
    monkeypatch.setattr(catalog, "append", disturbed)
    query = next(f for k, f in all_queries().items() if k.startswith("op_S7"))
    sf = "/root/testdata/sf0.001"
    assert query(spark, sf).count() == spark.read.parquet(f"{sf}/customer.parquet").count()
