"""Scalar rules on hand-made values."""

import math
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from anchorage import config as C
from anchorage.functions import hashing, images, times, values


def one(df, expr):
    return df.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "time, want",
    [("80556.875", dt(2180, 7, 23, 8, 5, 56)), ("191426", dt(2180, 7, 23, 19, 14, 26)), ("7.5", dt(2180, 7, 23, 0, 0, 7)), ("", dt(2180, 7, 23))],
)
def test_parse_study_time(frame, time, want):
    df = frame("d string, t string", ("21800723", time))
    assert one(df, times.parse_study_time("d", "t")) == want


def test_parse_study_time_rejects_or_nulls_bad_hours(frame):
    df = frame("d string, t string", ("21800723", "250000"))
    assert one(df, times.parse_study_time("d", "t", strict=False)) is None
    with pytest.raises(Exception, match="(?i)hour"):
        one(df, times.parse_study_time("d", "t"))


@pytest.mark.parametrize("date", ["2180", "218007230", "2180072x", "21801301", "21800230"])
def test_parse_study_time_rejects_bad_dates(frame, date):
    df = frame("d string, t string", (date, "1"))
    assert one(df, times.parse_study_time("d", "t", strict=False)) is None
    with pytest.raises(Exception, match="(?i)parse|cast|month|date"):
        one(df, times.parse_study_time("d", "t"))


def test_parse_study_time_of_nulls(frame):
    df = frame("d string, t string", (None, "1"))
    assert one(df, times.parse_study_time("d", "t")) is None
    assert one(frame("d string, t string", ("20240101", None)), times.parse_study_time("d", "t")) is None


def test_seconds_count_boundaries(frame):
    df = frame(
        "a timestamp_ntz, b timestamp_ntz", (dt(2180, 1, 2), dt(2180, 1, 1, 23, 59, 59, 500000))
    )
    assert one(df, times.seconds("a", "b")) == -1
    assert one(df, times.seconds("b", "a")) == 1


def test_seconds_before_1970(frame):
    df = frame(
        "a timestamp_ntz, b timestamp_ntz", (dt(1960, 1, 2), dt(1960, 1, 1, 23, 59, 59, 500000))
    )
    assert one(df, times.seconds("a", "b")) == -1


def test_time_arithmetic_ignores_the_session_zone(spark, frame):
    # 02:30 does not exist in New York on this day
    df = frame("a timestamp_ntz, b timestamp_ntz", (dt(2024, 3, 10, 1, 30), dt(2024, 3, 10, 2, 45)))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(df, times.seconds("a", "b")) == 75 * 60
        assert one(df, times.micros("b") - times.micros("a")) == 75 * 60 * 10**6
        assert one(df, times.bounds("b", 24)[0]) == dt(2024, 3, 9, 2, 45)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_age(frame):
    df = frame("a int, y int, t timestamp_ntz", (50, 2150, dt(2153, 3, 1)))
    assert one(df, times.age("a", "y", "t")) == 53


def test_preference_and_extrema_skip_nulls(frame):
    df = frame("a double, b double", (None, 2.0))
    assert one(df, values.prefer("a", "b")) == 2.0
    assert one(df, values.merge_min("a", "b")) == 2.0
    assert one(df, values.merge_max("a", "b")) == 2.0


def test_when_item(frame):
    df = frame("i int, v double", (50931, 7.0))
    assert one(df, values.when_item("i", [50809, 50931], "v")) == 7.0
    assert one(df, values.when_item("i", [1], "v")) is None


def test_bce_is_stable_and_sigmoid_bounded(frame):
    df = frame("z double, y int", (800.0, 0), (-800.0, 1))
    rows = df.select(values.bce_with_logits("z", "y", 2.0).alias("x"), values.sigmoid("z").alias("s")).collect()
    assert [r["x"] for r in rows] == [800.0, 1600.0]
    assert rows[0]["s"] == 1.0 and rows[1]["s"] == 0.0


def test_image_path(frame):
    df = frame(
        "subject_id long, study_id long, dicom_id string", (11111111, 3030303, "0"), (22222222, 8080808, "1")
    )
    col = images.path("b/", "subject_id", "study_id", "dicom_id", ".jpg")
    assert [r[0] for r in df.select(col).collect()] == [
        "b/p11/p11111111/s3030303/0.jpg",
        "b/p22/p22222222/s8080808/1.jpg",
    ]


@pytest.mark.parametrize("ext", ["jpg", ".jpg", "dcm", ".dcm", "dicom", ".dicom", ".JPEG"])
def test_known_extensions(ext):
    assert images.check_ext(ext) in images.EXTENSIONS


@pytest.mark.parametrize("ext", ["unallowed", ".unallowed", "#? unallowed", ""])
def test_unknown_extensions(ext):
    with pytest.raises(ValueError, match="Extension .* is not supported."):
        images.check_ext(ext)


def test_dotted_dicom_is_still_dicom():
    assert images.is_dicom(".dcm") and not images.is_dicom("jpg")


def test_extension_filter(frame):
    df = frame("n string", ("a/b.JPG",), ("a.dcm/b.png",), (".dicom",), ("jpg",), ("none",))
    assert [r[0] for r in df.where(images.has_known_ext("n")).collect()] == ["a/b.JPG", ".dicom", "jpg"]


@pytest.mark.parametrize(
    "h, w, want", [(300, 401, (0, 0, 50, 51)), (5, 2, (1, 2, 0, 0)), (7, 7, (0, 0, 0, 0))]
)
def test_pad_plan(frame, h, w, want):
    df = frame("h int, w int", (h, w))
    assert tuple(one(df, images.pad_plan("h", "w"))) == want


def test_row_text_is_unambiguous(frame):
    df = frame("a string, b string", ("x|1:y", None), ("x", "1:y|~"), (None, "x"), ("~", "x"))
    seen = [r[0] for r in df.select(hashing.row_text(["a", "b"])).collect()]
    assert len(set(seen)) == 4


def test_feature_order_is_the_model_contract():
    assert len(C.FEATURE_ORDER) == 34 and len(C.CONTINUOUS) == 25
    assert C.FEATURE_ORDER[:5] == ["gender", "age", "glucose_min", "glucose_max", "glucose_mean"]
    assert C.FEATURE_ORDER[11:14] == ["heart_rate_mean", "heart_rate_min", "heart_rate_max"]
    assert C.FEATURE_ORDER[-8:] == [f"{f}_missing" for f in C.CORE]
    assert math.isclose(C.POSITIVE_WEIGHT, 5.512820, abs_tol=1e-6)
