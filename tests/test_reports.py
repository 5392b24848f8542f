"""Metrics, reports, lineage, baseline."""

import math
import random

import pytest
from pyspark.sql import functions as F

from anchorage import config as C
from anchorage.operators import explore, learn, manifest, metrics, split


def scored(spark, rows):
    return spark.createDataFrame(rows, "s double, y int")


@pytest.mark.parametrize(
    "rows, auroc, ap, sens",
    [
        ([(0.99, 1), (0.98, 1), (0.2, 0), (0.1, 0)], 1.0, 1.0, 1.0),
        ([(0.9, 1), (0.8, 1), (0.8, 0), (0.3, 0)], 0.875, 0.833333, 0.5),
        ([(0.5, 1), (0.5, 0)], 0.5, 0.5, 0.0),
        ([(0.1, 1), (0.9, 0)], 0.0, 0.5, 0.0),
    ],
)
def test_metrics(spark, rows, auroc, ap, sens):
    got = metrics.from_curve(metrics.curve(scored(spark, rows), "s", "y")).first()
    assert (got["AUROC"], round(got["AUPRC"], 6), got["sens_at_95_spec"]) == (auroc, ap, sens)


def brute(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    ap, sens = 0.0, 0.0
    for t in sorted({s for s, _ in rows}, reverse=True):
        tp, fp = sum(p >= t for p in pos), sum(n >= t for n in neg)
        ap += sum(p == t for p in pos) / len(pos) * tp / (tp + fp)
        if fp / len(neg) <= 0.05:
            sens = max(sens, tp / len(pos))
    return wins / len(pos) / len(neg), ap, sens


def test_metrics_by_group_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(g, round(rnd.gauss(y, 1.5), 1), y) for g in range(3) for y in (0, 1) for _ in range(120)]
    df = spark.createDataFrame(rows, "g int, z double, y int")
    got = {r["g"]: r for r in metrics.report(df, "z", "y", 2.5, by="g").collect()}
    for g in range(3):
        mine = [(z, y) for h, z, y in rows if h == g]
        auroc, ap, sens = brute(mine)
        loss = sum((2.5 * y * math.log1p(math.exp(-z)) + (1 - y) * math.log1p(math.exp(z))) for z, y in mine) / len(mine)
        assert math.isclose(got[g]["AUROC"], auroc) and math.isclose(got[g]["AUPRC"], ap)
        assert math.isclose(got[g]["sens_at_95_spec"], sens) and math.isclose(got[g]["loss"], loss)


def test_roc_has_an_origin_and_ends_at_one(spark):
    points = metrics.roc(scored(spark, [(0.9, 1), (0.8, 0), (0.8, 1), (None, 1)]), "s", "y").collect()
    got = sorted((r["fpr"], r["tpr"], r["threshold"]) for r in points)
    assert got == [(0.0, 0.0, float("inf")), (0.0, 0.5, 0.9), (1.0, 1.0, 0.8)]


def test_one_class_only(spark):
    df = spark.createDataFrame([("p", 0.1, 1), ("p", 0.9, 1), ("n", 0.5, 0)], "g string, z double, y int")
    got = {r["g"]: (r["AUROC"], r["AUPRC"], r["sens_at_95_spec"]) for r in metrics.report(df, "z", "y", 1.0, by="g").collect()}
    assert got == {"p": (None, 1.0, 0.0), "n": (None, 0.0, None)}


def test_weighted_bce(spark):
    df = spark.createDataFrame([(0.0, 1), (0.0, 0)], "z double, y int")
    assert abs(metrics.weighted_bce(df, "z", "y", C.POSITIVE_WEIGHT).first()["loss"] - 2.257172) < 1e-6


def test_best_epoch_is_the_earliest(frame):
    df = frame("epoch int, m double", (0, 0.3), (1, 0.5), (2, 0.5), (3, 0.4), (4, None))
    assert metrics.best(df, "m").first()["epoch"] == 1
    assert metrics.best(df, "m", mode="lower").first()["epoch"] == 0
    with pytest.raises(ValueError, match="mode"):
        metrics.best(df, "m", mode="best")


def test_epoch_loss_both_ways(frame):
    df = frame("epoch int, loss double, n int", (0, 1.0, 32), (0, 3.0, 8))
    row = metrics.epoch_loss(df, rows="n").first()
    assert row["mean_loss"] == 2.0 and row["row_mean_loss"] == 1.4


def test_bootstrap_interval(spark):
    df = spark.createDataFrame([(0, int(i % 10 == 0)) for i in range(2000)] + [(1, i % 2) for i in range(500)], "g int, y int")
    got = {r["g"]: r for r in explore.bootstrap_mean(df, "g", "y").collect()}
    for g, p, n in ((0, 0.1, 2000), (1, 0.5, 500)):
        half = 1.96 * math.sqrt(p * (1 - p) / n)
        assert got[g]["mean"] == p and got[g]["rows"] == n
        assert abs(got[g]["low"] - (p - half)) < half / 5 and abs(got[g]["high"] - (p + half)) < half / 5
    again = explore.bootstrap_mean(df.repartition(5), "g", "y").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got.values()))


def test_bootstrap_of_any_numeric_label(frame):
    rnd = random.Random(3)
    ys = [rnd.gauss(10, 3) for _ in range(800)]
    df = frame("g string, y double", *[(None, y) for y in ys], ("one", 4.0), ("none", None))
    got = {r["g"]: r for r in explore.bootstrap_mean(df, "g", "y").collect()}
    mean = sum(ys) / len(ys)
    half = 1.96 * math.sqrt(sum((y - mean) ** 2 for y in ys) / (len(ys) - 1) / len(ys))
    assert got.keys() == {None, "one"} and math.isclose(got[None]["mean"], mean)
    assert abs(got[None]["low"] - (mean - half)) < half / 5 and abs(got[None]["high"] - (mean + half)) < half / 5
    assert (got["one"]["low"], got["one"]["high"]) == (4.0, 4.0)


def test_binned_density_is_near_the_exact_one_on_the_columns_own_range(frame):
    rnd = random.Random(4)
    xs = [rnd.gauss(5, 1) for _ in range(500)]
    df = frame("g string, x double", *[("a", x) for x in xs], ("flat", 2.0), ("flat", None))
    exact, binned = (explore.kde(df, "x", "g", points=21, bins=b).orderBy("point").collect() for b in (None, 800))
    assert exact[0]["x"] == min(xs + [2.0]) and math.isclose(exact[-1]["x"], max(xs))
    assert len(exact) == len(binned) == 21
    assert all(abs(a["density"] - b["density"]) < 1e-4 for a, b in zip(exact, binned))
    assert explore.kde(df.where("false"), "x", "g", bins=10).collect() == []


def test_density_integrates_to_one_and_matches_the_formula(spark):
    rnd = random.Random(1)
    xs = [round(rnd.gauss(5, 1), 1) for _ in range(200)]
    df = spark.createDataFrame([("a", x) for x in xs] + [("flat", 2.0)] * 3, "g string, x double")
    got = explore.kde(df, "x", "g", -5.0, 15.0, 81).orderBy("point").collect()
    assert {r["g"] for r in got} == {"a"}
    assert abs(sum(r["density"] for r in got) * 0.25 - 1) < 1e-3
    mean = sum(xs) / len(xs)
    h = math.sqrt(sum((x - mean) ** 2 for x in xs) / (len(xs) - 1)) * len(xs) ** -0.2
    want = sum(math.exp(-0.5 * ((got[40]["x"] - x) / h) ** 2) for x in xs) / (len(xs) * h * math.sqrt(2 * math.pi))
    assert math.isclose(got[40]["density"], want)


def test_histogram_last_bin_is_closed(frame):
    df = frame("g int, x double", *[(0, float(i)) for i in range(11)], (1, None))
    got = {r["bin"]: (r["low"], r["rows"]) for r in explore.histogram(df, "x", "g", 5).collect()}
    assert got == {0: (0.0, 2), 1: (2.0, 2), 2: (4.0, 2), 3: (6.0, 2), 4: (8.0, 3)}
    fixed = explore.histogram(df, "x", "g", 2, low=0, high=4).collect()
    assert {r["bin"]: r["rows"] for r in fixed} == {0: 2, 1: 3}
    same = explore.histogram(df.withColumn("x", F.lit(3.0)), "x", "g", 5).collect()
    assert {r["bin"] for r in same} == {0}


def test_correlations(frame):
    df = frame("a int, b double, c double, t string", (1, 2.0, None, "x"), (2, 4.0, 1.0, "y"), (3, 6.0, 0.0, "z"))
    r = {(x["a"], x["b"]): x["r"] for x in explore.corr(df).collect()}
    assert len(r) == 9 and math.isclose(r["a", "b"], 1.0) and math.isclose(r["c", "a"], -1.0)
    top = explore.top_corr(df, "a", 2).collect()
    assert [x["column"] for x in top] == ["b"]


def test_label_balance_and_rates(frame):
    df = frame("f int, y int", (0, 1), (0, 0), (1, 0), (1, 0), (1, 1), (1, None))
    assert tuple(explore.label_balance(df, "y").first()) == (2, 5, 1.5)
    got = {r["flag"]: (r["rows"], round(r["rate_pct"], 6), round(r["difference_pct"], 6)) for r in explore.rate_by(df, "f", "y").collect()}
    assert got == {0: (2, 50.0, 16.666667), 1: (3, 33.333333, 16.666667)}


def test_study_counts(frame):
    df = frame("subject_id long, StudyDate string, study_id long", (1, "d", 7), (1, "d", 7), (1, "d", 8), (1, "e", 9))
    got = sorted(tuple(r) for r in explore.study_counts(df).collect())
    assert got == [(1, "d", 3, 2), (1, "e", 1, 1)]


def test_scatter_thins_by_key_only_when_asked(spark):
    df = spark.range(400).select("id", F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"), F.lit(0).alias("g"))
    assert explore.scatter(df, "x", "y", "g").count() == 400
    assert 60 < explore.scatter(df, "x", "y", "g", key="id", frac=0.25).count() < 140


def test_fingerprint_counts_copies_and_ignores_order(spark, frame):
    a = frame("k int, s string", (1, "x"), (2, None), (2, None))
    same = frame("k int, s string", (2, None), (1, "x"), (2, None))
    fewer = frame("k int, s string", (1, "x"))
    moved = frame("k int, s string", (1, "x"), (2, ""), (2, None))
    prints = [tuple(manifest.fingerprint(d).first()) for d in (a, same, fewer, moved)]
    assert prints[0] == prints[1] and len(set(prints)) == 3


def test_run_manifest(spark, frame, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    table = manifest.build(spark, {"d": frame("k int", (1,))}, {"p": 1}, {"d": "/data/d"}, revision="abc", ref="main", folders={"d": str(tmp_path)})
    got = {r["key"]: r["value"] for r in table.collect()}
    assert got["source.git_sha"] == "abc" and got["p"] == "1" and got["dataset.d_filepath"] == "/data/d"
    assert got["dataset.d_files"].startswith("1:")
    assert got["dataset.d_fingerprint"].startswith("1:") and got["environment.spark_version"] == spark.version


def test_fuse(frame):
    a, b = frame("k int, a array<float>", (1, [1.0]), (2, [2.0])), frame("k int, b array<float>", (1, [3.0, 4.0]))
    assert [tuple(r) for r in learn.fuse(a, b, "k").collect()] == [(1, [1.0, 3.0, 4.0])]


def test_baseline_learns_and_weighs(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.gauss(2.0 * y, 1), rnd.random(), y) for i in range(1500) for y in (int(rnd.random() < 0.15),)]
    parts = split.by_hash(spark.createDataFrame(rows, "id long, a double, b double, y int"), "id", {"train": 0.7, "val": 0.3})
    model = learn.fit_baseline(parts.where("split = 'train'"), ["a", "b"], "y")
    val = learn.score(model, parts.where("split = 'val'"))
    got = metrics.report(val, "logit", "y", 1.0).first()
    assert got["AUROC"] > 0.85
    train = parts.where("split = 'train'")
    slopes = learn.gradients(model, train, ["a", "b"], "y", train.agg(F.expr("count_if(y = 0) / sum(y)")).first()[0])
    assert {r["term"] for r in slopes.collect() if abs(r["gradient"]) < 1e-4} == {"intercept", "a", "b"}
    with pytest.raises(ValueError, match="not converged"):
        learn.fit_baseline(train, ["a", "b"], "y", max_iter=1)
    # with weighted positives about half of the mass is called positive
    assert val.agg(F.avg("score")).first()[0] > 0.3
