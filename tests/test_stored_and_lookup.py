"""Stored tables, lookups in several roles, samples, whole-result windows, dyadic period joins."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from casebook.operators import lookup
from casebook.operators.lookup import names_by_role
from casebook.operators.neighbours import over_all
from casebook.operators.range_join import dyadic_bins, join_periods
from casebook.operators.sample import bottom_k, merge_samples
from casebook.operators.distinct import distinct_counts, distinct_partials, merge_partials
from casebook.plans import dlv, partials
from casebook.session import checkpoint_dir
from casebook.sources import catalog as C
from casebook.sources.io import drop_stages, materialize, materialize_once, staged_paths
from tests.conftest import rows


# ---- lookups (J5, D17, D18) ------------------------------------------------------
def test_two_roles_with_200_000_names(spark):
    n = 200_000
    toppings = spark.range(1, n + 1).select(F.col("id").cast("int").alias("topping_id"), F.concat(F.lit("t"), F.col("id")).alias("topping_name"))
    co = spark.range(3000).select(
        F.col("id").alias("order_id"), F.lit(1).alias("customer_id"), F.lit(7).alias("pizza_id"),
        F.array((F.col("id") * 61 + 1).cast("int"), (F.col("id") * 61 + 1).cast("int"), F.lit(5)).alias("exclusions"),
        F.when(F.col("id") % 2 == 0, F.array((F.lit(n) - F.col("id")).cast("int"), F.lit(n + 9), F.lit(None).cast("int"))).alias("extras"))
    names = spark.createDataFrame([(7, "P")], "pizza_id int, pizza_name string")
    got = {r["order_id"]: r["order_item"] for r in dlv.line_labels(co, names, toppings).collect()}
    assert len(got) == 3000
    for i, label in got.items():
        ex = ", ".join(sorted({f"t{i * 61 + 1}", "t5"}))
        assert label == f"P - Exclude {ex}" + (f" - Extra t{n - i}" if i % 2 == 0 else "")
    two = {r["order_id"]: (r["excluded"], r["added"]) for r in dlv.two_roles(co, toppings).collect()}
    assert two[4] == ("t245, t245, t5", f"t{n - 4}") and two[5][1] is None


def test_hot_id_is_split_and_nothing_changes(spark):
    data = [(i, [1, 2 + i % 5], [1] if i % 3 else None) for i in range(400)] + [(1, [1, 3], None)] * 2
    df = spark.createDataFrame(data, "k int, a array<int>, b array<int>")
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(1, 7)], "id int, name string")
    tagged = materialize(df, "split_test")
    assert [(r["_id"], r["_parts"] > 1) for r in lookup.split_ids(tagged, ["a", "b"], 300, "split_test").collect()] == [(1, True)]
    out = names_by_role(df, ["a", "b"], dim, "id", "name", rows_per_key=50)
    got = sorted((r["k"], [x["name"] for x in r["a_found"]], [x["name"] for x in r["b_found"]]) for r in out.collect())
    assert got == sorted((k, [f"n{x}" for x in a], [f"n{x}" for x in b or []]) for k, a, b in data)
    assert names_by_role(df.limit(0), ["a", "b"], dim, "id", "name").count() == 0


# ---- samples (O7) ------------------------------------------------------------------
def test_sample_does_not_depend_on_layout_and_merges(spark):
    df = spark.createDataFrame([(i, i % 7, None if i % 5 else "x") for i in range(900)], "id int, g int, t string")
    one = rows(bottom_k(df.coalesce(1), "id", 40))
    assert len(one) == 40 and rows(bottom_k(df.repartition(13, "t"), "id", 40)) == one
    assert rows(bottom_k(df, "id", 40, seed=1)) != one
    parts = [bottom_k(df.where(c), "id", 40) for c in ("id < 500", "id >= 500")]
    assert rows(merge_samples(*parts, 40)) == one
    strata = rows(bottom_k(df.repartition(9), "id", 6, by="g"))
    assert strata == rows(bottom_k(df.coalesce(1), "id", 6, by="g")) and len(strata) == 42
    halves = [bottom_k(df.where(c), "id", 6, by="g") for c in ("id % 2 = 0", "id % 2 = 1")]
    assert rows(merge_samples(*halves, 6, by="g")) == strata
    assert bottom_k(df.limit(0), "id", 6).count() == 0


# ---- stored tables (S4 to S9) ------------------------------------------------------
@pytest.fixture
def stored(spark):
    df = spark.range(200).selectExpr("id", "id % 10 as v", "cast(id % 4 as int) as p", "case when id % 7 = 0 then null else concat('a''b', id % 3) end as q")
    C.replace_table(df, "stored_test", ["p", "q"])
    yield df
    C.drop_table(spark, "stored_test")


def files(spark):
    return {f for f in glob.glob(checkpoint_dir(spark).removeprefix("file:") + "/catalog/**/stored_test/**/part-*", recursive=True)}


def part_of(f):
    return f.rsplit("/", 3)[1:3]


def test_create_replace_append_and_two_sessions(spark, stored):
    with pytest.raises(Exception):
        C.create_table(stored, "stored_test", ["p", "q"])
    C.append(spark.createDataFrame([("x", 1000, 5, 9)], "q string, id long, v long, p int"), "stored_test")
    other = spark.newSession()
    table = C.full_name(spark, "stored_test")
    assert other.table(table).where("id = 1000 and v = 5 and p = 9 and q = 'x'").count() == 1
    assert C.full_name(other, "stored_test") == table
    C.append(other.createDataFrame([(1001, 0, 0, None)], "id long, v long, p int, q string"), "stored_test")
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 202
    for _ in range(2):
        assert C.replace_table(stored.where("id < 50"), "stored_test", "p").count() == 50
    assert C.partition_columns(spark, "stored_test") == ["p"]


def test_update_rewrites_only_touched_partitions(spark, stored):
    before, want = files(spark), [(r["id"], -1 if r["p"] == 1 and r["q"] == "a'b2" and r["v"] > 3 else r["v"]) for r in stored.collect()]
    out = C.update_where(spark, "stored_test", {"v": F.lit(-1)}, (F.col("p") == 1) & (F.col("q") == "a'b2") & (F.col("v") > 3))
    assert rows(out.select("id", "v")) == sorted(want)
    gone = before - files(spark)
    assert gone and all(part_of(f)[0] == "p=1" and part_of(f)[1].endswith("b2") for f in gone)
    untouched = files(spark)
    assert rows(C.update_where(spark, "stored_test", {"v": F.lit(0)}, F.lit(None).cast("boolean")).select("id", "v")) == sorted(want)
    assert files(spark) == untouched
    with pytest.raises(ValueError):
        C.update_where(spark, "stored_test", {"p": F.lit(1)}, F.lit(True))


def test_delete_by_condition_and_keys(spark, stored):
    all_rows = [tuple(r) for r in stored.collect()]
    out = C.delete_where(spark, "stored_test", F.col("q") == "a'b1")                 # unknown for null q: stays
    left = [r for r in all_rows if r[3] != "a'b1"]
    assert sorted(tuple(r) for r in out.select("id", "v", "p").collect()) == sorted(r[:3] for r in left)
    C.delete_where(spark, "stored_test", F.col("q").isNull() & (F.col("p") == 2))   # a whole partition, by a null value
    left = [r for r in left if not (r[3] is None and r[2] == 2)]
    keys = spark.createDataFrame([(3,), (None,), (5,), (5,)], "id long")
    before = files(spark)
    out = C.delete_keys(spark, "stored_test", keys, "id")
    left = [r for r in left if r[0] not in (3, 5)]
    assert sorted(r["id"] for r in out.collect()) == sorted(r[0] for r in left)
    assert {tuple(part_of(f)) for f in before - files(spark)} <= {tuple(part_of(f)) for f in before if part_of(f)[0] in ("p=1", "p=3")}
    assert C.delete_where(spark, "stored_test", F.lit(True)).count() == 0


def test_shared_stage_follows_its_files(spark, tmp_path):
    folder = str(tmp_path)
    for n in (5, 8):
        spark.range(n).write.mode("overwrite").parquet(f"{folder}/t.parquet")
        for _ in range(2):
            assert materialize_once(spark, "follow", folder, lambda: spark.read.parquet(f"{folder}/t.parquet")).count() == n


def test_drop_chosen_stages(spark):
    first = materialize(spark.range(3), "drop_a")
    before = staged_paths(spark)
    materialize(spark.range(4), "drop_b")
    new = [p for p in staged_paths(spark) if p not in before]
    assert len(new) == 1 and drop_stages(spark, new + ["/no/stage/of/ours"]) == 1
    assert first.count() == 3 and staged_paths(spark) == before


# ---- windows over a whole result (W7, W9, W10, W15) ---------------------------------
@pytest.mark.parametrize("parts,block", [(1, 3), (200, 3), (7, 50), (5, 100_000)])
def test_whole_result_windows(spark, parts, block):
    vals = random.Random(1).sample(range(1000), 60)
    df = spark.createDataFrame([(v, v * 3 % 11) for v in vals], "k int, v int").repartition(parts)
    out = over_all(df, "k", {"l1": lambda w: F.lag("v", 1).over(w), "l3": lambda w: F.lag("v", 3).over(w), "s": lambda w: F.sum("v").over(w.rowsBetween(-2, 0)),
                             "n": lambda w: F.lead("v", 2).over(w)}, back=3, ahead=2, block=block, stage="neighbour_test")
    o = sorted((v, v * 3 % 11) for v in vals)
    x = [b for _, b in o]
    want = [(k, v, x[i - 1] if i else None, x[i - 3] if i > 2 else None, sum(x[max(0, i - 2):i + 1]), x[i + 2] if i + 2 < len(x) else None) for i, (k, v) in enumerate(o)]
    assert sorted((tuple(r) for r in out.select("k", "v", "l1", "l3", "s", "n").collect())) == want
    assert over_all(df.limit(0), "k", {"l": lambda w: F.lag("v").over(w)}, back=1).count() == 0


# ---- period joins (J9) ---------------------------------------------------------------
def test_dyadic_bins_tile_every_period(spark):
    rnd = random.Random(3)
    spans = [(a, a + rnd.choice((0, 1, 5, 63, 64, 1000))) for a in (rnd.randint(0, 5000) for _ in range(200))]
    df = spark.createDataFrame(spans, "a long, b long")
    for r in df.select("a", "b", dyadic_bins(F.col("a"), F.col("b")).alias("bins")).collect():
        covered = sorted(x for lv, n in r["bins"] for x in range(n << lv, (n + 1) << lv))
        assert covered == list(range(r["a"], r["b"] + 1))
        assert len(r["bins"]) <= 2 * (r["b"] - r["a"] + 1).bit_length()


def test_long_overlapping_periods_and_a_hot_time(spark):
    rnd = random.Random(4)
    day = dt.datetime(1960, 1, 1)
    events = [(i, day + dt.timedelta(days=rnd.randint(-10, 30000), seconds=rnd.randint(0, 86399))) for i in range(300)] + [(1000 + i, dt.datetime(1999, 1, 1)) for i in range(200)]
    periods = [(k, day + dt.timedelta(days=rnd.randint(0, 25000)), rnd.choice((0, 3, 400, 20000))) for k in range(60)]
    periods = [(k, s, s + dt.timedelta(days=n, hours=5)) for k, s, n in periods] + [(90, dt.datetime(1999, 1, 1), dt.datetime(1999, 1, 1)), (91, day, day - dt.timedelta(1))]
    out = join_periods(spark.createDataFrame(events, "id long, t timestamp_ntz"), "t", spark.createDataFrame(periods, "period long, s timestamp_ntz, e timestamp_ntz"), "s", "e")
    want = [(i, k) for i, t in events for k, s, e in periods if s <= t <= e]
    want += [(i, None) for i, t in events if not any(s <= t <= e for _, s, e in periods)]
    assert sorted(((r["id"], r["period"]) for r in out.collect()), key=str) == sorted(want, key=str)


# ---- additive distinct counts, partial reports, rejects, recursion -------------------
def test_bitmaps_merge_to_exact_distinct_counts(spark):
    rnd = random.Random(6)
    data = [(rnd.randint(1, 6), rnd.choice((None, rnd.randint(-5, 100_000))), rnd.randint(0, 9)) for _ in range(2000)] + [(7, None, 1)]
    p = distinct_partials(spark.createDataFrame(data, "g int, a long, b long"), "g", {"a": "a", "b": "b"})
    for key, of in (("g", lambda g: g), ("half", lambda g: g % 2)):
        q = merge_partials(p, [(F.col("g") if key == "g" else F.col("g") % 2).alias(key)])
        want = sorted((k, len({a for g, a, _ in data if of(g) == k and a is not None}), len({b for g, _, b in data if of(g) == k})) for k in {of(g) for g, _, _ in data})
        assert rows(distinct_counts(q, key, ["a", "b"])) == want


def test_late_month_rebuilds_only_itself(spark):
    def sales(rs):
        return spark.createDataFrame([(dt.date(2024, m, 3), p, q, 10, 0) for m, p, q in rs], "txn_date date, prod_id int, qty int, price int, discount int")
    first = [(m, p, 1 + p % 3) for m in (1, 2, 5) for p in range(m, 40)]
    partials.build_partials(sales(first))
    where = checkpoint_dir(spark).removeprefix("file:")
    listing = lambda: {f for f in glob.glob(f"{where}/catalog/**/report_month_*/**/part-*", recursive=True)}
    before, late = listing(), first + [(2, 900, 7), (2, 901, 1)]
    partials.refresh_month(sales(late), "2024-02")
    gone = before - listing()
    assert gone and all("month=2024-02-01" in f for f in gone)
    got = partials.report(spark, "quarter").collect()
    want = {q: (sum(x[2] for x in late if (x[0] - 1) // 3 == q), len({x[1] for x in late if (x[0] - 1) // 3 == q})) for q in (0, 1)}
    assert {(r["period"].month - 1) // 3: (r["total_qty"], r["products"]) for r in got} == want


def test_rejects_do_not_fail_the_job(spark, tmp_path):
    lines = ["1,2,x,2024-01-01", "2,many,x,2024-01-01", "3,4", "", "4,5,,2024-02-30", '5,6,"a,b",2024-03-01', "6,7,x,2024-01-01,more"]
    (tmp_path / "f.csv").write_text("\n".join(lines))
    good, bad = partials.read_csv_with_rejects(spark, str(tmp_path), partials.ORDER_COLS)
    assert rows(good, "o_orderkey", "o_orderpriority") == [(1, "x"), (5, "a,b")]
    assert rows(bad) == sorted((x,) for x in (lines[1], lines[2], lines[4], lines[6]))


def test_recursive_paths_carry_state_and_end_on_cycles(spark):
    edges = [(1, None), (2, 1), (3, 2), (4, 2), (9, None), (10, 11), (11, 10)]
    got = rows(partials.hierarchy_paths(spark.createDataFrame(edges, "id int, parent_id int")))
    assert got == [(1, "1", 0), (2, "1/2", 1), (3, "1/2/3", 2), (4, "1/2/4", 2), (9, "9", 0)]
