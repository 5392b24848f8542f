"""Flattening, merging, fitting, applying, splitting, checking."""

import random
import statistics
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from anchorage import config as C
from anchorage.operators import features, prepare, quality, split
from anchorage.sources import sinks, tables


def test_codes_pool_into_one_feature(frame):
    df = frame("k long, i int, v double", (1, 50809, 100.0), (1, 50931, 140.0), (1, 50813, 2.0), (2, 50912, None))
    flat = features.flatten_long(df, "k", "i", "v", C.LAB_CODES)
    row = flat.where("k = 1").first()
    assert (row["glucose_min"], row["glucose_max"], row["glucose_mean"]) == (100.0, 140.0, 120.0)
    assert row["lactate_mean"] == 2.0 and row["creatinine_min"] is None


def test_only_items_keeps_wanted_codes_with_values(frame):
    df = frame("i int, v double", (220045, 1.0), (999999, 2.0), (220045, None))
    assert features.only_items(df, "i", "v", C.CHART_CODES).count() == 1


@pytest.mark.parametrize(
    "ed, icu, want",
    [((80.0, 70.0, 95.0), (90.0, None, 99.0), (80.0, 70.0, 99.0)), ((None, None, None), (90.0, 60.0, 99.0), (90.0, 60.0, 99.0))],
)
def test_merge_prefers_the_first_mean_and_spans_the_extremes(frame, ed, icu, want):
    names = ", ".join(f"x_{s}{src} double" for src in ("_ed", "_icu") for s in ("mean", "min", "max"))
    row = frame(names, ed + icu).select(*features.merged(["x"], "_ed", "_icu")).first()
    assert (row["x_mean"], row["x_min"], row["x_max"]) == want


def test_encode(frame):
    df = frame("g string", ("M",), ("F",))
    assert [r["g"] for r in prepare.encode(df, "g", C.GENDER_CODES).collect()] == [0, 1]


@pytest.mark.parametrize("bad", ["x", "0", None, "m"])
def test_encode_rejects_any_other_value(frame, bad):
    df = frame("g string", ("M",), (bad,), ("F",))
    with pytest.raises(Exception, match="M/F are the only values of g"):
        prepare.encode(df, "g", C.GENDER_CODES).collect()


def test_indicators_always_for_every_feature(frame):
    df = frame("a_max double, b_max double", (1.0, 2.0), (None, 3.0))
    rows = prepare.indicators(df, ["a", "b"]).collect()
    assert [(r["a_missing"], r["b_missing"]) for r in rows] == [(0, 0), (1, 0)]


def test_median_of_even_count(frame):
    df = frame("a double, b int, c double", (1.0, 5, None), (2.0, None, None), (4.0, None, None), (9.0, None, None))
    row = prepare.fit_medians(df, ["a", "b", "c"]).first()
    assert (row["a"], row["b"], row["c"]) == (3.0, 5.0, None)


def skewed(n):
    """Ties, a skewed column, a constant, nulls."""
    rnd = random.Random(n)
    return [(rnd.gauss(0, 1), float(rnd.randrange(4)), 7.0, rnd.random() ** 9 if i % 3 else None) for i in range(n)]


def exact(rows):
    columns = [[v for v in column if v is not None] for column in zip(*rows)]
    return tuple(statistics.median(c) if c else None for c in columns)


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 2501])
@pytest.mark.parametrize("group_rows", [100_000, 0])
def test_bracketed_median_is_exact(spark, n, group_rows):
    df = spark.createDataFrame(skewed(n), "a double, b double, c double, d double")
    got = prepare.fit_medians(df, ["a", "b", "c", "d"], size=16, group_rows=group_rows).first()
    assert tuple(got) == exact(skewed(n))


def test_median_of_old_and_new_rows_by_merged_states(spark, tmp_path):
    old, new, cols = skewed(3000), [(a + 1, b, c, d) for a, b, c, d in skewed(2001)], ["a", "b", "c", "d"]
    frames = [spark.createDataFrame(r, "a double, b double, c double, d double") for r in (old, new)]
    stored = prepare.quantile_state(frames[0], cols, size=256)
    stored.write.parquet(str(tmp_path / "state"))
    state = prepare.merge_states(spark.read.parquet(str(tmp_path / "state")), prepare.quantile_state(frames[1], cols, size=256))
    slack = prepare.SURE * prepare.rank_error(256)
    first = prepare._brackets(state, [slack])[0]
    want = exact(old + new)
    assert all(lo <= m <= hi for (lo, hi), m in zip((first[c] for c in cols), want))
    both = frames[0].union(frames[1])
    assert tuple(prepare.fit_medians(both, cols, state=state, size=256).first()) == want
    lone = prepare.merge_states(state, prepare.quantile_state(frames[0].limit(0), cols))
    assert all(lo <= m <= hi for (lo, hi), m in zip(prepare._brackets(lone, [slack])[0].values(), want))


def test_a_state_that_misses_is_widened(spark, frame):
    df = spark.createDataFrame(skewed(1000), "a double, b double, c double, d double")
    foreign = prepare.quantile_state(frame("a double, b double", (1e9, None)), ["a", "b"])
    assert tuple(prepare.fit_medians(df, ["a", "b"], state=foreign).first()) == exact(skewed(1000))[:2]


def test_median_with_nan_and_infinite_values(frame):
    inf, nan = float("inf"), float("nan")
    df = frame("a double, b double, c double", (1.0, -inf, nan), (nan, -inf, nan), (nan, inf, nan), (2.0, 3.0, nan), (0.0, inf, 1.0))
    row = prepare.fit_medians(df, ["a", "b", "c"]).first()
    assert row["a"] == 2.0 and row["b"] == 3.0 and row["c"] != row["c"]  # NaN counts as the largest


def test_approximate_median(frame):
    df = frame("a double", *[(float(i),) for i in range(101)])
    assert prepare.fit_medians(df, ["a"], approx=True).first()["a"] == 50.0


def test_impute_fills_only_fitted_columns(frame):
    df = frame("id long, a double, b double", (1, None, None), (2, 4.0, 1.0))
    rows = prepare.impute(df, prepare.fit_medians(df, ["a"])).collect()
    assert [tuple(r) for r in rows] == [(1, 4.0, None), (2, 4.0, 1.0)]


def test_stats_and_standardize(frame):
    df = frame("a double, g int", (1.0, 0), (2.0, 1), (4.0, 0), (9.0, 1))
    stats = prepare.fit_stats(df, ["a"])
    row = stats.first()
    assert row["mean"]["a"] == 4.0 and abs(row["std"]["a"] - 3.559026) < 1e-6
    scaled = prepare.standardize(df, stats).collect()
    assert abs(scaled[3]["a"] - 5 / (3.5590260840104366 + 1e-8)) < 1e-12 and scaled[3]["g"] == 1


def test_standardize_known_values(spark, frame):
    stats = spark.sql(
        """select named_struct('age', 62.333D, 'glucose_min', 149.58595440564935D) as mean,
                  named_struct('age', 18.323734373938383D, 'glucose_min', 90.93735343330343D) as std"""
    )
    row = prepare.standardize(frame("age long, glucose_min double", (53, 121.0)), stats).first()
    assert abs(row["age"] + 0.509339) < 1e-6 and abs(row["glucose_min"] + 0.314348) < 1e-6


def test_assemble_keeps_the_order(frame):
    df = frame("b double, id long, a double, y int", (2.0, 7, 1.0, 1))
    row = prepare.assemble(df, ["a", "b"], "y").first()
    assert row.asDict() == {"id": 7, "features": [1.0, 2.0], "y": 1.0}


def test_split_shares_and_stability(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    parts = split.by_hash(df, "k", C.SPLIT_FRACTIONS)
    share = {r["split"]: r["count"] / 20000 for r in parts.groupBy("split").count().collect()}
    for name, want in C.SPLIT_FRACTIONS.items():
        assert abs(share[name] - want) < 0.02
    few = split.by_hash(df.where("k < 100"), "k", C.SPLIT_FRACTIONS)
    assert few.exceptAll(parts).count() == 0
    with pytest.raises(ValueError, match="sum to 1"):
        split.by_hash(df, "k", {"a": 0.5})


def test_split_keeps_a_subject_together(spark):
    df = spark.range(3000).select((F.col("id") % 50).alias("s"))
    parts = split.by_hash(df, "s", C.SPLIT_FRACTIONS).distinct()
    assert parts.count() == 50


@pytest.mark.parametrize("frac", [0, 0.0, 1.5, -1])
def test_sample_rejects_bad_fractions(frame, frac):
    with pytest.raises(ValueError, match="fraction"):
        split.sample(frame("k long", (1,)), "k", frac)


def test_sample_and_shuffle(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert split.sample(df, "k", 1.0).count() == 1000
    assert 200 < split.sample(df, "k", 0.25).count() < 300
    order = [r["k"] for r in split.shuffle(df, "k").collect()]
    assert order != list(range(1000)) and sorted(order) == list(range(1000))
    assert order == [r["k"] for r in split.shuffle(df.repartition(3), "k").collect()]


def test_features_label(frame):
    x, y = split.features_label(frame("a int, y int", (1, 0)), "y")
    assert x.columns == ["a"] and y.columns == ["y"]


def test_null_consistency_checks_rows_too(frame):
    df = frame("x_min double, x_max double, x_mean double", (None, 1.0, 1.0), (1.0, None, 1.0), (1.0, 1.0, None))
    row = quality.null_consistency(df, ["x"]).first()
    # the counts agree, the rows do not
    assert (row["min_nulls"], row["max_nulls"], row["mean_nulls"], row["rows_differing"], row["ok"]) == (1, 1, 1, 3, False)
    with pytest.raises(ValueError, match="missing together"):
        quality.require_consistent(df, ["x"])


def test_domain_and_mandatory(frame):
    df = frame("g string, a int", ("M", 1), ("x", None), (None, 2))
    assert {r["value"]: r["rows"] for r in quality.domain(df, "g", ["M", "F"]).collect()} == {"x": 1, None: 1}
    assert [tuple(r) for r in quality.mandatory(df, ["a"]).collect()] == [("a", 1)]


def test_missing_counts_and_schema_report(frame):
    df = frame("a int, `odd name` string", (1, None), (None, None))
    assert {r["column"]: r["missing"] for r in quality.missing_counts(df).collect()} == {"a": 1, "odd name": 2}
    assert [tuple(r) for r in quality.schema_report(df, ["odd name"]).collect()] == [
        (0, "a", "int", False, 2, 1),
        (1, "odd name", "string", True, 2, 2),
    ]


def test_contract(frame):
    df = frame("a double, c double", (1.0, float("nan")))
    rows = quality.contract(df, ["a", "b", "z"]).collect()
    assert [(r["expected"], r["actual"], r["bad_rows"], r["ok"]) for r in rows] == [
        ("a", "a", 0, True),
        ("b", "c", 1, False),
        ("z", None, 0, False),
    ]


def test_missing_inputs(spark, tmp_path):
    here = str(tmp_path)
    assert quality.absent_inputs(spark, [here, here + "/nono"]) == [here + "/nono"]
    with pytest.raises(FileNotFoundError, match="nono"):
        quality.require_inputs(spark, [here + "/nono"])


def test_listing_and_inventory(spark, frame, tmp_path):
    (tmp_path / "p1").mkdir()
    (tmp_path / "p1" / "a.jpg").write_bytes(b"abc")
    (tmp_path / "p1" / "note.txt").write_bytes(b"")
    found = quality.listing(spark, str(tmp_path), "*.jpg")
    assert [(r["path"], r["length"]) for r in found.collect()] == [(f"{tmp_path}/p1/a.jpg", 3)]
    wanted = frame("path string", (f"{tmp_path}/p1/a.jpg",), ("/gone.jpg",), (None,))
    assert [r["path"] for r in quality.missing_paths(wanted, found).collect()] == ["/gone.jpg", None]
    present = found.union(frame("path string, length long", ("/more.jpg", 1), ("/more.jpg", 1)))
    states = {(r["path"], r["state"]) for r in quality.inventory(wanted.dropna(), present).collect()}
    assert states == {("/gone.jpg", "missing"), ("/more.jpg", "surplus")}


def test_splits_stats_and_csv_round_trip(spark, frame, tmp_path):
    df = frame("id long, name string, split string", (1, 'a "quoted", b', "train"), (2, None, "val"))
    root = sinks.write_splits(df, str(tmp_path / "s"), "csv")
    back = tables.read_csv(spark, root + "/split=train", "id long, name string")
    assert [tuple(r) for r in back.collect()] == [(1, 'a "quoted", b')]
    stats = prepare.fit_stats(frame("a double", (1.0,), (3.0,)), ["a"])
    path = sinks.write_stats(stats, str(tmp_path / "stats"))
    assert sinks.read_stats(spark, path, ["a"]).collect() == stats.collect()


def test_materialized_frames_know_their_size(spark, frame):
    df = sinks.materialize(frame("a long, t timestamp_ntz", (1, dt(2024, 1, 1))))
    assert [tuple(r) for r in df.collect()] == [(1, dt(2024, 1, 1))]
    assert df.inputFiles()


def test_left_join_keeps_the_left_copy(frame):
    a, b = frame("k int, x int", (1, 10), (2, 20)), frame("k int, x int, y int", (1, 99, 5))
    assert sorted(tuple(r) for r in tables.left_join(a, b, "k").collect()) == [(1, 10, 5), (2, 20, None)]


def test_sql_over_frames_and_tables(spark, frame, tmp_path):
    df = frame("a int, b int", (1, 2), (3, 4))
    assert tables.sql(spark, "select sum(a) as s from {x} where b > 2", x=df).first()["s"] == 3
    df.write.parquet(str(tmp_path / "t"))
    assert tables.table(spark, str(tmp_path / "t"), ["b"]).columns == ["b"]
    df.createOrReplaceTempView("listed")
    assert tables.table(spark, "listed").count() == 2
    assert "listed" in [r["name"] for r in tables.list_tables(spark).collect()]
