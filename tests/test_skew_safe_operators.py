"""Skew-safe operators equal the plain window functions they replace, on
random data where one key holds over a third of the rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window as W, functions as F

from casebook.operators import dense_rank_by, first_rows, rank_by, running_sum
from casebook.operators.rowid import global_row_number
from casebook.operators.sequence import sequence_number
from tests.conftest import rows


@pytest.fixture(scope="module", params=[3, 11])
def skewed(spark, request):
    rnd = random.Random(request.param)
    data = []
    for i in range(1500):
        c = 0 if rnd.random() < 0.4 else rnd.randint(1, 40)             # key 0 is hot
        d = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 20))
        data.append((c, d, rnd.randint(-50, 100), f"t{rnd.randint(0, 3)}", i))
    return spark.createDataFrame(data, "c int, d date, v int, t string, id int")


def test_running_sum_equals_range_window(skewed):
    w = W.partitionBy("c").orderBy("d").rangeBetween(W.unboundedPreceding, W.currentRow)
    want = skewed.withColumn("r", F.sum("v").over(w))
    assert rows(running_sum(skewed, "c", "d", "v", "r"), "id", "r") == rows(want, "id", "r")


@pytest.mark.parametrize("desc", [False, True])
def test_ranks_equal_window_ranks(skewed, desc):
    o = F.col("d").desc() if desc else F.col("d")
    w = W.partitionBy("c").orderBy(o)
    want = skewed.withColumn("rk", F.rank().over(w)).withColumn("dr", F.dense_rank().over(w))
    got = rank_by(skewed, "c", "d", "rk", desc=desc)
    got = dense_rank_by(got, "c", "d", "dr", desc=desc)
    assert rows(got, "id", "rk", "dr") == rows(want, "id", "rk", "dr")
    assert rows(first_rows(skewed, "c", "d", desc=desc), "id") == rows(want.filter("rk = 1"), "id")


def test_sequence_number_equals_row_number(skewed):
    w = W.partitionBy("c").orderBy("d", "t", "id")
    want = skewed.withColumn("seq", F.row_number().over(w))
    got = sequence_number(skewed, "c", "d", ["t", "id"], out="seq")
    assert rows(got, "id", "seq") == rows(want, "id", "seq")


def test_global_row_number_is_consecutive_in_order(skewed):
    got = global_row_number(skewed, ["d", "id"], stage="test_row_ids")
    want = skewed.withColumn("row_id", F.row_number().over(W.orderBy("d", "id")))
    assert rows(got, "id", "row_id") == rows(want, "id", "row_id")


def test_row_number_by_equals_row_number(skewed):
    from casebook.operators.rowid import row_number_by
    w = W.partitionBy("c").orderBy("d", "t", "id")
    want = skewed.withColumn("seq", F.row_number().over(w))
    got = row_number_by(skewed.repartition(7), "c", ["d", "t", "id"], out="seq", stage="test_rn_by")
    assert rows(got, "id", "seq") == rows(want, "id", "seq")
