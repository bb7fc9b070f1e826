"""Operators against brute force on small fixtures."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from meterstone.operators.dedup import keep_one_per_key
from meterstone.operators.fill import fill_down, fill_lookup
from meterstone.operators.lag import previous_values
from meterstone.operators.months import counts_by_month, day_spine, explode_month_ends
from meterstone.operators.positions import quantile, with_positions
from meterstone.operators.profile import text_widths
from meterstone.plans.quality import unique_key_violations


def test_duplicates(spark):
    rows = [(1, 10, "a")] * 3 + [(2, 5, "b"), (3, 7, "z"), (3, 7, "c")]
    df = spark.createDataFrame(rows, "id int, amount int, code string")
    once = keep_one_per_key(df, ["id"])
    assert sorted(map(tuple, once.collect())) == [(1, 10, "a", 3), (2, 5, "b", 1), (3, 7, "c", 2)]
    again = keep_one_per_key(once.drop("dup_rows"), ["id"])
    assert sorted(map(tuple, again.drop("dup_rows").collect())) == sorted(map(tuple, once.drop("dup_rows").collect()))


def test_duplicates_collapse_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 1).alias("id"), (F.col("id") % 3).alias("v"))
    plan = keep_one_per_key(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    below = plan.rsplit("Exchange", 1)[1]
    assert "partial_count(1)" in below and "Window" not in below
    done = keep_one_per_key(df, ["id"])
    done.collect()
    assert "ReusedExchange" in done._jdf.queryExecution().executedPlan().toString()  # the rows are read and counted once


def _bills(spark, hot_share=0.4, n=3000):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        customer = 1 if rng.random() < hot_share else rng.randrange(2, 200)
        rows.append((customer, date(2024, 1, 1) + timedelta(days=rng.randrange(60)), i,
                     None if rng.random() < 0.1 else float(rng.randrange(100)), rng.random() < 0.3))
    return rows, spark.createDataFrame(rows, "k int, d date, id int, kwh double, est boolean")


def test_previous_value_of_hot_key(spark):
    rows, df = _bills(spark)
    want, last = [], {}
    for k, d, i, kwh, est in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        want.append((k, i, *last.get(k, (None, None))))
        last[k] = (kwh, est)
    take = {"was": "kwh", "was_est": "est"}
    for piece in (F.trunc("d", "week"), F.trunc("d", "month"), F.col("d"), F.lit(1)):  # one path, pieces of any size
        got = previous_values(df, ["k"], ["d", "id"], take, piece).select("k", "id", "was", "was_est")
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_month_expansion(spark):
    df = spark.createDataFrame(
        [(1, date(2024, 9, 10), date(2024, 12, 31)), (2, date(2024, 11, 30), None), (3, date(2024, 11, 5), date(2024, 11, 20)),
         (4, date(2023, 1, 1), date(2024, 11, 1))],
        "id int, since date, until date")
    out = explode_month_ends(df, F.col("since"), F.coalesce("until", F.lit(date(9999, 12, 31))),
                             date(2024, 10, 1), date(2025, 1, 31), "me")
    got = {}
    for r in out.collect():
        got.setdefault(r.id, []).append(r.me)
    assert {k: sorted(v) for k, v in got.items()} == {
        1: [date(2024, 10, 31), date(2024, 11, 30)],
        2: [date(2024, 11, 30), date(2024, 12, 31), date(2025, 1, 31)],
        4: [date(2024, 10, 31)],
    }


def test_day_spine(spark):
    assert day_spine(spark, date(2014, 1, 1), date(2026, 12, 31)).count() == 4748


def test_fill(spark):
    df = spark.createDataFrame([(0, None), (1, 2.0), (2, None), (3, 5.0), (4, None), (5, None)], "o int, x double")
    assert [r.x for r in fill_lookup(df, "o", ["x"]).orderBy("o").collect()] == [None, 2.0, 2.0, 5.0, 5.0, 5.0]
    grouped = df.withColumn("g", F.col("o") >= 4)
    assert [r.x for r in fill_down(grouped, "o", ["x"], ["g"]).orderBy("o").collect()] == [None, 2.0, 2.0, 5.0, None, None]
    with pytest.raises(ValueError):
        fill_down(df, "o", ["x"], [])


def test_text_widths(spark):
    df = spark.createDataFrame([("abc", "x" * 21, None, 1), ("a", "y", None, 2)], "a string, b string, c string, n int")
    assert {r.column_name: r.width for r in text_widths(df).collect()} == {"a": 10, "b": 30, "c": 10}


def test_key_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert sorted((r.k or 0) for r in unique_key_violations(df, ["k"]).collect()) == [0, 1]


def test_positions(spark):
    rows = [(i * 7919 % 500, None if i % 11 == 0 else i % 3, "x" * (i % 5)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, g int, _range string").repartition(5)
    got = sorted(with_positions(df, [F.col("g").desc_nulls_last()], tie=["k", "_range"]).collect(), key=lambda r: r.position)
    key = lambda r: (r[1] is None, -(r[1] or 0), r[0], r[2])
    assert [r.position for r in got] == list(range(1, 2001)) and [key(r) for r in got] == sorted(map(key, rows))
    assert with_positions(df.limit(0), [F.col("k")]).count() == 0
    assert sorted(r.position for r in with_positions(spark.range(3).select(F.lit(1).alias("a")), [F.col("a")]).collect()) == [1, 2, 3]


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 0.95, 1.0])
def test_quantile_equals_percentile_on_skewed_values(spark, share):
    skewed = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 97 == 0, None).otherwise(F.sqrt("id") * F.when(F.col("id") % 2 == 0, -1).otherwise(1)).alias("x"))
    assert quantile(skewed, "x", share).first().value == pytest.approx(skewed.agg(F.percentile("x", F.lit(share))).first()[0], abs=1e-12)


def test_quantile_of_few_values(spark):
    one = lambda v, s: quantile(spark.createDataFrame([(x,) for x in v], "x int"), "x", s).first().value
    assert one([], .5) is None and one([None], .5) is None and one([4], .95) == 4.0 and one([1, 2], .25) == 1.25 and one([3] * 9, .3) == 3.0
    with pytest.raises(ValueError):
        one([1], 1.5)


def test_counts_by_month_equal_counting_each_month(spark):
    n = lambda y, m: (y - 1970) * 12 + m - 1
    rng, rows = random.Random(2), []
    for i in range(300):
        a = rng.choice([None, rng.randrange(n(2023, 1), n(2025, 12))])
        b = rng.choice([None, rng.randrange(n(2023, 1), n(2025, 12))])
        rows.append((i, rng.choice(["p", "q", None]), a, b))
    df = spark.createDataFrame(rows, "id int, g string, a int, b int")
    got = counts_by_month(df, ["g"], {"x": (F.col("a"), F.col("b")), "y": (F.col("a"), F.col("a"))}, date(2024, 2, 1), date(2025, 3, 31), "me")
    want = {}
    for m in range(n(2024, 2), n(2025, 3) + 1):
        for g in ("p", "q", None):
            x = sum(r[1] == g and r[2] is not None and r[3] is not None and r[2] <= m <= r[3] for r in rows)
            y = sum(r[1] == g and r[2] == m for r in rows)
            if x or y:
                want[g, m] = (x, y)
    assert {(r.g, n(r.me.year, r.me.month)): (r.x, r.y) for r in got.collect()} == want and len(want) > 20


def test_one_row_a_key_without_sort_aggregate(spark):
    rows = [(1, "a", 2.0), (1, "a", 2.0), (2, "b", None), (2, "a", 5.0), (2, "a", 4.0), (2, "a", 4.0), (None, "z", 1.0), (None, "z", 1.0), (None, "y", 3.0)]
    df = spark.createDataFrame(rows, "k int, s string, x double")
    out = keep_one_per_key(df, ["k"])
    assert sorted(((r.k or 0), r.s, r.x, r.dup_rows) for r in out.collect()) == [(0, "y", 3.0, 3), (1, "a", 2.0, 2), (2, "a", 4.0, 4)]
    assert out.columns == ["k", "s", "x", "dup_rows"]
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
