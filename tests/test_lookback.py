"""Interval joins against brute force, and their behaviour under skew."""

import random
from datetime import datetime as dt
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from anchorage.operators import lookback, ranking

T0 = dt(2180, 7, 23, 14, 0)
US = timedelta(microseconds=1)


def hours(n):
    return timedelta(hours=n)


@pytest.fixture
def stay(frame):
    return frame("subject_id long, stay_id long, t0 timestamp_ntz", (1, 10, T0))


def test_both_ends_are_inside(stay, frame):
    events = frame(
        "subject_id long, t timestamp_ntz, n string",
        (1, T0 - hours(24), "low"),
        (1, T0, "high"),
        (1, T0 - hours(24) - US, "before"),
        (1, T0 + US, "after"),
        (2, T0, "other"),
        (1, None, "never"),
    )
    got = lookback.join(stay, events, "subject_id", "t0", "t", 24)
    assert sorted(r["n"] for r in got.collect()) == ["high", "low"]


@pytest.mark.parametrize("pick, want", [("closest", "c"), ("farthest", "a")])
def test_nearest(stay, frame, pick, want):
    events = frame(
        "subject_id long, t timestamp_ntz, id string",
        (1, T0 - hours(23), "a"),
        (1, T0 - hours(5), "b"),
        (1, T0 - hours(1), "c"),
        (1, T0 - hours(25), "d"),
    )
    got = lookback.nearest(stay, events, "subject_id", "t0", "t", 24, tie="id", pick=pick).collect()
    assert [r["id"] for r in got] == [want]


def test_nearest_tie_goes_to_the_smallest_id(stay, frame):
    events = frame("subject_id long, t timestamp_ntz, id string", (1, T0, "b"), (1, T0, "a"), (1, T0, "c"))
    assert lookback.nearest(stay, events, "subject_id", "t0", "t", 24, tie="id").first()["id"] == "a"


def test_bad_arguments(stay):
    with pytest.raises(ValueError, match="pick"):
        lookback.nearest(stay, stay, "subject_id", "t0", "t0", 24, tie="stay_id", pick="middle")
    with pytest.raises(ValueError, match="window"):
        lookback.join(stay, stay, "subject_id", "t0", "t", 0)
    with pytest.raises(ValueError, match="whole hours"):
        lookback.join(stay, stay, "subject_id", "t0", "t", 0.5)


def test_first_breaks_ties_by_id(frame):
    stays = frame("subject_id long, stay_id long, t timestamp_ntz", (1, 12, T0), (1, 11, T0), (1, 9, T0 + US))
    assert ranking.first(stays, "subject_id", ["t", "stay_id"]).first()["stay_id"] == 11


def random_tables(spark, seed, subjects=6, span=200):
    """Few subjects, one of them with a third of all rows."""
    rnd = random.Random(seed)

    def who():
        return 0 if rnd.random() < 1 / 3 else rnd.randrange(subjects)

    def when():
        # a coarse clock, so that ends of windows are hit exactly
        return dt(1969, 12, 30) + timedelta(minutes=30 * rnd.randrange(2 * span))

    stays = [(who(), i, when()) for i in range(40)]
    events = [(who(), i, when()) for i in range(150)]
    return (
        stays,
        events,
        spark.createDataFrame(stays, "s long, stay long, t0 timestamp_ntz"),
        spark.createDataFrame(events, "s long, id long, t timestamp_ntz"),
    )


@pytest.mark.parametrize("seed, before, after", [(1, 24, 0), (2, 24, 24), (3, 7, 2), (4, 0, 5)])
def test_join_and_exists_against_brute_force(spark, seed, before, after):
    stays, events, a, b = random_tables(spark, seed)

    def near(x, y):
        return x[0] == y[0] and x[2] - hours(before) <= y[2] <= x[2] + hours(after)

    want = sorted((x[1], y[1]) for x in stays for y in events if near(x, y))
    got = lookback.join(a, b, "s", "t0", "t", before, after)
    assert sorted((r["stay"], r["id"]) for r in got.collect()) == want
    found = lookback.exists(a, b, "s", "t0", "t", before, after)
    assert sorted(r["s"] for r in found.collect()) == sorted({x[0] for x in stays for y in events if near(x, y)})


@pytest.mark.parametrize("per_key", [0, 100])
def test_join_with_a_known_span(spark, monkeypatch, per_key):
    monkeypatch.setattr(lookback, "BROADCAST_PER_KEY", per_key)
    stays, events, a, b = random_tables(spark, 7)
    found = lookback.span(a, "s", "t0", 24)
    assert (found.rows, found.small) == (len(stays), per_key == 100)
    assert found.low == min(x[2] for x in stays) - hours(24) and found.high == max(x[2] for x in stays)
    got = lookback.join(a, b, "s", "t0", "t", 24, found=found)
    want = lookback.join(a, b, "s", "t0", "t", 24)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_span_of_no_anchors(stay, frame):
    none = stay.where("false")
    found = lookback.span(none, "subject_id", "t0", 24)
    assert (found.rows, found.low) == (0, None)
    events = frame("subject_id long, t timestamp_ntz", (1, T0))
    assert lookback.join(none, events, "subject_id", "t0", "t", 24, found=found).count() == 0


def test_exists_is_exact_at_the_window_ends(spark, frame):
    for gap, hit in [(hours(24), True), (hours(24) + US, False), (-US, False), (hours(0), True)]:
        a = frame("s long, t0 timestamp_ntz", (1, T0))
        b = frame("s long, t timestamp_ntz", (1, T0 - gap))
        assert (lookback.exists(a, b, "s", "t0", "t", 24).count() == 1) is hit


def test_rank_orders_by_gap_then_id(stay, frame):
    events = frame(
        "subject_id long, t timestamp_ntz, id string",
        (1, T0 - hours(5), "a"),
        (1, T0 - hours(1), "c"),
        (1, T0 - hours(1), "b"),
    )
    pairs = lookback.join(stay, events, "subject_id", "t0", "t", 24)
    rows = lookback.rank(pairs, "stay_id", "t0", "t", "id").collect()
    assert {r["id"]: r["gap_rank"] for r in rows} == {"b": 1, "c": 2, "a": 3}
    rows = lookback.rank(pairs, "stay_id", "t0", "t", "id", signed=True).collect()
    assert {r["id"]: (r["gap_seconds"], r["gap_rank"]) for r in rows}["a"] == (-18000, 1)


def test_a_hot_key_is_split_by_the_skew_join(spark):
    """One subject and one slot holding a third of all events must not stay one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 60000
        events = spark.range(0, n, 1, 16).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("s"),
            F.expr("timestamp_ntz'2024-01-02 00:00:00' + make_dt_interval(0, 0, 0, id % 3600)").alias("t"),
            F.rand(1).alias("v"),
        )
        stays = spark.range(500).select(
            F.col("id").alias("s"),
            F.col("id").alias("stay"),
            F.expr("timestamp_ntz'2024-01-02 12:00:00' + make_dt_interval(0, 0, 0, id % 7)").alias("t0"),
        )
        near = lookback.join(stays, events, "s", "t0", "t", 24)
        out = near.groupBy("stay").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top"))
        assert sum(r["n"] for r in out.collect()) == n
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def nearest_by_hand(anchors, events, before, after, pick):
    out = set()
    for k, a, t0 in anchors:
        inside = [
            (abs(t0 - t) * (1 if pick == "closest" else -1), i, t)
            for j, t, i in events
            if None not in (k, j, t, t0) and j == k and t0 - hours(before) <= t <= t0 + hours(after)
        ]
        if inside:
            _, i, t = min(inside, key=lambda x: (x[0], x[1] is not None, x[1] or 0))
            out.add((k, a, t0, t, i))
    return out


@pytest.mark.parametrize("pick", ["closest", "farthest"])
@pytest.mark.parametrize(
    "before, after, group_rows", [(24, 0, 100_000), (24, 0, 20), (5, 7, 20), (0, 6, 100_000), (-2, 9, 20), (9, -2, 100_000)]
)
def test_nearest_equals_brute_force(frame, pick, before, after, group_rows):
    draw = random.Random(before * 31 + after)

    def when():
        return None if draw.random() < 0.03 else T0 + timedelta(minutes=30 * draw.randrange(160))

    def who():
        return draw.choice([1, 1, 1, 1, 1, 2, 3, 4, None])

    anchors = [(who(), i, when()) for i in range(60)] + [(1, 99, T0), (1, 99, T0)]
    # many events at one time, repeated rows, and ties without a value
    events = [(who(), when(), draw.choice([None, *range(40)])) for _ in range(300)]
    events += [(1, T0 + hours(1), i) for i in range(90)] * 2 + events[:20]
    got = lookback.nearest(
        frame("k long, a long, t0 timestamp_ntz", *anchors),
        frame("k long, t timestamp_ntz, i long", *events),
        "k", "t0", "t", before, tie="i", after=after, pick=pick, group_rows=group_rows,
    ).collect()
    want = nearest_by_hand(anchors, events, before, after, pick)
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_nearest_of_empty_tables(frame):
    anchors = frame("k long, a long, t0 timestamp_ntz")
    events = frame("k long, t timestamp_ntz, i long")
    got = lookback.nearest(anchors, events, "k", "t0", "t", 24, tie="i")
    assert got.columns == ["k", "a", "t0", "t", "i"] and got.isEmpty()


@pytest.mark.parametrize("group_rows", [100_000, 1_000])
def test_nearest_forms_no_pairs_of_a_busy_key(spark, group_rows):
    """All in one slot of one key: pairs would be 4 * 10^9."""
    n, m = 200_000, 20_000
    second = lambda k: F.expr(f"timestamp_ntz'2180-01-01 00:00:00' + make_dt_interval(0, 0, 0, {k})")
    events = spark.range(n).select(F.lit(1).alias("k"), second("id % 80000").alias("t"), F.col("id").alias("i"))
    anchors = spark.range(m).select(F.lit(1).alias("k"), F.col("id").alias("a"), second("id * 4 + 1").alias("t0"))
    got = lookback.nearest(anchors, events, "k", "t0", "t", 24, tie="i", group_rows=group_rows)
    # the event of the same second with the smallest number
    row = got.agg(F.count(F.lit(1)), F.count_if(F.col("i") == F.col("a") * 4 + 1)).first()
    assert tuple(row) == (m, m)
