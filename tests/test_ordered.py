"""Split running sums and numbering against the plain ones."""

import random
from datetime import datetime as dt
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from anchorage.operators import ordered


def plain(rows, order, reverse=False):
    """{id: (running sum, total)} by sorting each group."""
    out = {}
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=order, reverse=reverse)
        total, upto = sum(r[3] for r in group), 0
        for r in group:
            upto += r[3]
            out[r[2]] = (upto, total)
    return out


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    # a third of the rows belongs to key 0, and half of those share one value
    out = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rnd.randrange(1, 40)
        value = 0.5 if key == 0 and i % 2 == 0 else round(rnd.gauss(0, 1), 2)
        out.append((key, value, i, rnd.randrange(10)))
    return out


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("mode", [{"group_rows": 10}, {"split_all": True}, {"buckets": 1}, {}])
def test_running_sums(spark, rows, mode, descending):
    df = spark.createDataFrame(rows, "k long, v double, id long, x long")
    options = {"buckets": 8, **mode}
    got = ordered.running_sums(
        df, ["k"], ["v", "id"], {"s": "x"}, descending=descending, totals=("s",), **options
    )
    assert got.columns[:4] == ["k", "v", "id", "x"]
    seen = {r["id"]: (r["s"], r["s_total"]) for r in got.collect()}
    assert seen == plain(rows, lambda r: (r[1], r[2]), descending)


def test_global_running_sum(spark, rows):
    df = spark.createDataFrame(rows, "k long, v double, id long, x long")
    got = ordered.running_sums(df.drop("k"), [], ["v", "id"], {"s": "x"}, buckets=16)
    want = plain([(0, *r[1:]) for r in rows], lambda r: (r[1], r[2]))
    assert {r["id"]: r["s"] for r in got.collect()} == {i: s for i, (s, _) in want.items()}


def test_even_one_repeated_value_is_spread(spark, rows):
    df = spark.createDataFrame(rows, "k long, v double, id long, x long")
    sizes = ordered.with_buckets(df, ["v", "id"], 16).groupBy("k", "_ord_bucket").count()
    assert sizes.agg(F.max("count")).first()[0] <= 2 * len(rows) / 16


def test_buckets_follow_the_order(spark, rows):
    df = spark.createDataFrame(rows, "k long, v double, id long, x long")
    coded = ordered.with_buckets(df, ["v", "id"], 16).collect()
    coded.sort(key=lambda r: (r["v"], r["id"]))
    marks = [r["_ord_bucket"] for r in coded]
    assert marks == sorted(marks)


def test_numbering_with_times_and_text_ties(spark):
    rnd = random.Random(9)
    start = dt(1999, 12, 31)
    rows = [(i % 2, start + timedelta(seconds=rnd.choice([0, 0, 0, 7, 90])), f"dé{rnd.random()}") for i in range(900)]
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, id string")
    got = ordered.row_numbers(df, ["k"], ["t", "id"], buckets=12, group_rows=5).collect()
    for key in (0, 1):
        mine = sorted((r for r in got if r["k"] == key), key=lambda r: r["row_number"])
        assert [r["row_number"] for r in mine] == list(range(1, 451))
        pairs = [(r["t"], r["id"].encode()) for r in mine]
        assert pairs == sorted(pairs)


def test_null_keys_and_values_are_kept(spark):
    rows = [(None, 1.0, 1), (None, 2.0, 2), (1, None, 3), (1, 5.0, 4)] + [(2, float(i), 10 + i) for i in range(50)]
    df = spark.createDataFrame(rows, "k long, v double, id long")
    got = ordered.row_numbers(df, ["k"], ["v", "id"], buckets=4, group_rows=5).collect()
    assert len(got) == len(rows)
    assert {r["id"]: r["row_number"] for r in got if r["id"] < 10} == {1: 1, 2: 2, 3: 1, 4: 2}


def test_hot_keys_are_few_whatever_the_data(spark, rows):
    df = spark.createDataFrame(rows, "k long, v double, id long, x long")
    hot = [r["k"] for r in ordered.hot_keys(df, ["k"], 8, group_rows=10).collect()]
    assert hot == [0]
    assert ordered.hot_keys(df, ["k"], 8).count() == 0
