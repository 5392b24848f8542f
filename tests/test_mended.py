"""Cases in which rows were lost or changed before."""

import datetime as dt
import math
import os
import time

import pytest
from pyspark.sql import functions as F

from anchorage.functions import hashing
from anchorage.operators import explore, lookback, manifest, metrics, ordered, split
from anchorage.plans import clinical
from anchorage.sources import tables


@pytest.fixture
def elsewhere():
    """The driver in another time zone than the session."""
    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    yield
    os.environ.pop("TZ") if old is None else os.environ.update(TZ=old)
    time.tzset()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_known_span_loses_no_event_of_zoned_columns(spark, elsewhere, kind):
    anchor = spark.range(1).select(F.lit(1).alias("s"), F.lit("2024-03-10 12:00:00").cast(kind).alias("t0"))
    events = spark.range(60).select(
        F.lit(1).alias("s"), F.expr(f"cast('2024-03-09 00:00:00' as {kind}) + make_interval(0, 0, 0, 0, id)").alias("t")
    )
    found = lookback.span(anchor, "s", "t0", 24)
    assert lookback.join(anchor, events, "s", "t0", "t", 24, found=found).count() == 25
    assert lookback.join(anchor, events, "s", "t0", "t", 24).count() == 25


def test_metrics_keep_null_groups_and_infinite_scores(spark):
    inf = float("inf")
    rows = [(g, s, y) for g in (None, "a") for s, y in [(-inf, 0)] * 5 + [(0.3, 1), (0.2, 0)] + [(inf, 1)] * 5]
    df = spark.createDataFrame(rows, "g string, s double, y int")
    found = {r["g"]: r["AUROC"] for r in metrics.auroc(df, "s", "y", "g").collect()}
    assert found == {None: 1.0, "a": 1.0}
    assert {r["g"] for r in metrics.report(df, "s", "y", 1.0, "g").collect()} == {None, "a"}


def test_a_big_null_group_is_numbered_whole(spark):
    df = spark.range(400).select(F.when(F.col("id") >= 40, F.col("id") % 2).alias("g"), "id")
    df = df.withColumn("g", F.when(F.col("g") == 1, 1))
    found = ordered.row_numbers(df, ["g"], ["id"], buckets=8, group_rows=10)
    counts = {r["g"]: (r["n"], r["m"]) for r in found.groupBy("g").agg(F.count("*").alias("n"), F.max("row_number").alias("m")).collect()}
    assert counts == {None: (220, 220), 1: (180, 180)}


def test_small_shares_are_kept(spark):
    df = spark.range(1_000_000)
    assert 15 < split.sample(df, "id", 0.00004).count() < 80
    old = df.limit(5000).where(hashing.bucket(42, "id") < 1234)
    assert split.sample(df.limit(5000), "id", 0.1234).count() == old.count()


def test_corr_by_columns_with_nulls(spark):
    rows = [(1.0, 2.0, None), (2.0, 1.0, 5.0), (4.0, None, 6.0), (7.0, 3.0, 5.5), (None, 9.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double").withColumn("k", F.lit(1))
    found = {(r["a"], r["b"]): r["r"] for r in explore.corr(df).collect()}
    for x in "abc":
        for y in "abc":
            assert found[x, y] == pytest.approx(df.agg(F.corr(x, y)).first()[0])
    assert found["a", "k"] is None and len(found) == 16
    big = spark.range(1000).select((F.col("id") + 1e9).alias("x"), (F.col("id") * 2 + 1e9).cast("double").alias("y"))
    assert all(math.isclose(r["r"], 1) for r in explore.corr(big).collect())


def test_fingerprints_tell_nested_values_apart(spark):
    one, two = (spark.createDataFrame([(x,)], "v array<string>") for x in (["a, b"], ["a", "b"]))
    assert manifest.fingerprint(one).first() != manifest.fingerprint(two).first()
    one, two = (spark.createDataFrame([(x,)], "v binary") for x in (b"\xff", b"\xfe"))
    assert manifest.fingerprint(one).first() != manifest.fingerprint(two).first()


def test_a_malformed_key_joins_with_nothing(spark):
    df = tables.cast_key(spark.createDataFrame([("7",), ("007",), ("x7",)], "k string"), "k", "long")
    assert [r["k"] for r in df.collect()] == [7, 7, None]


def test_missing_ids_stop_the_preparation(spark):
    cols = ["subject_id", "study_id", "dicom_id", "gender", "age", *clinical.C.MEASUREMENTS, clinical.C.LABEL]
    row = [1, None, "d", "M", 50, *[1.0] * len(clinical.C.MEASUREMENTS), 0]
    kinds = {"dicom_id": "string", "gender": "string"}
    schema = ", ".join(f"{c} {kinds.get(c, 'double' if c in clinical.C.MEASUREMENTS else 'int')}" for c in cols)
    with pytest.raises(ValueError, match="study_id"):
        clinical.check(spark.createDataFrame([row], schema))
