"""The clinical plans end to end on a small hand-made hospital."""

from datetime import datetime as dt
from datetime import timedelta

import pytest

from anchorage import config as C
from anchorage.operators import prepare, quality
from anchorage.plans import clinical
from anchorage.sources import sinks

T0 = dt(2180, 7, 23, 14, 0)


def at(hours):
    return T0 + timedelta(hours=hours)


def image(subject, name, when, view="AP"):
    return (str(subject), name, subject * 10, when.strftime("%Y%m%d"), f"{int(when.strftime('%H%M%S'))}.875", view)


@pytest.fixture(scope="module")
def hospital(spark):
    def make(schema, rows):
        return spark.createDataFrame(rows, schema)

    subjects = range(11, 61)
    stays = [(s, s * 100, s * 1000, T0) for s in subjects] + [(11, 999, 9999, at(50))]
    cxr = [image(s, f"d{s}", at(-3)) for s in subjects if s != 60]
    cxr += [image(11, "early", at(-20)), image(11, "late", at(-1), "LATERAL"), image(11, "old", at(-25))]
    labs = [(s, 50809 if s % 2 else 50931, at(-2), float(s)) for s in subjects]
    labs += [(s, 50813, at(-1), 2.0) for s in range(11, 26)]
    labs += [(11, 50813, at(1), 99.0), (11, 50912, at(-1), None)]
    charts = [(s * 100, 220045, at(-1), 90.0 + s) for s in subjects] + [(1100, 999999, at(-1), 1.0)]
    ed = [(s, at(-5), 80.0, None, 16.0, 98.6, 97.0) for s in subjects if s % 5]
    return C.Tables(
        make("subject_id long, stay_id long, hadm_id long, intime timestamp_ntz", stays),
        make(
            "hadm_id long, subject_id long, admittime timestamp_ntz, hospital_expire_flag int",
            [(h, s, at(-30), int(s % 6 == 0)) for s, _, h, _ in stays],
        ),
        make(
            "subject_id long, gender string, anchor_age int, anchor_year int",
            [(s, "M" if s % 2 else "F", 50, 2177) for s in subjects],
        ),
        make("subject_id long, itemid int, charttime timestamp_ntz, valuenum double", labs),
        make("stay_id long, itemid int, charttime timestamp_ntz, valuenum double", charts),
        make(
            "subject_id long, charttime timestamp_ntz, heartrate double, sbp double, resprate double, "
            "temperature double, o2sat double",
            ed,
        ),
        make(
            "subject_id string, dicom_id string, study_id long, StudyDate string, StudyTime string, ViewPosition string",
            cxr,
        ),
    )


@pytest.fixture(scope="module")
def built(hospital):
    return clinical.build(hospital)


def test_manifest_takes_the_closest_frontal_image_of_the_first_stay(hospital):
    rows = {r["subject_id"]: r for r in clinical.images_manifest(hospital).collect()}
    assert len(rows) == 49 and 60 not in rows
    assert rows[11]["dicom_id"] == "d11" and rows[11]["stay_id"] == 1100


def test_dataset_values(built):
    row = built.where("subject_id = 11").first()
    assert (row["age"], row["gender"], row["glucose_mean"], row["lactate_max"]) == (53, "M", 11.0, 2.0)
    assert row["creatinine_min"] is None and row["blood_pressure_min"] is None
    # ED mean preferred, extremes span both sources
    assert (row["heart_rate_mean"], row["heart_rate_min"], row["heart_rate_max"]) == (80.0, 80.0, 101.0)
    only_icu = built.where("subject_id = 15").first()
    assert only_icu["heart_rate_mean"] == 105.0 and only_icu["resp_rate_mean"] is None


def test_prepared_rows_meet_the_contract(built):
    rows = sinks.materialize(clinical.prepared(built))
    assert rows.count() == 49
    x = rows.select(*C.FEATURE_ORDER)
    # blood pressure and creatinine were never measured, so there is no median to fill them with
    bad = {r["actual"] for r in quality.contract(x, C.FEATURE_ORDER).where("not ok").collect()}
    assert bad == {f"{f}_{s}" for f in ("blood_pressure", "creatinine") for s in ("min", "max", "mean")}
    assert {r["gender"] for r in rows.select("gender").distinct().collect()} == {0, 1}
    assert rows.where("lactate_missing = 1 and lactate_mean is null").count() == 0
    stats = clinical.training_stats(rows)
    with pytest.raises(ValueError, match="creatinine_min"):
        clinical.model_matrix(rows, stats, "img/", ".jpg")
    for few in (rows.limit(0), rows.limit(1)):  # nothing to standardise by
        lone = clinical.model_matrix(rows, prepare.fit_stats(few, C.CONTINUOUS), "img/", ".jpg")
        assert lone.columns == ["split", "image_path", "features", C.LABEL] and lone.collect() == []
    matrix = clinical.model_matrix(rows, stats, "img/", ".jpg", checked=False)
    got = matrix.where("image_path like '%/d11.jpg'").first()
    assert got["image_path"] == "img/p11/p11/s110/d11.jpg" and len(got["features"]) == 34
    assert matrix.columns == ["split", "image_path", "features", C.LABEL]


def test_checks_stop_a_broken_dataset(built):
    with pytest.raises(ValueError, match="missing together"):
        clinical.prepared(built.selectExpr("* except (glucose_min)", "cast(null as double) as glucose_min"))
    with pytest.raises(ValueError, match="not allowed to be missing"):
        clinical.prepared(built.selectExpr("* except (age)", "cast(null as bigint) as age"))
    with pytest.raises(ValueError, match="unexpected gender"):
        clinical.prepared(built.selectExpr("* except (gender)", "case when subject_id = 12 then 'x' else gender end as gender"))


def test_absent_null_and_nan_features_stop_the_matrix(frame):
    rows = frame("a double, b double", (1.0, 2.0), (2.0, None))
    with pytest.raises(ValueError, match="'b'"):
        clinical.require_features(rows, ["a", "b"])
    with pytest.raises(ValueError, match="'b'"):
        clinical.require_features(rows.fillna(float("nan")), ["a", "b"])
    with pytest.raises(ValueError, match="'c'"):
        clinical.require_features(rows.select("a"), ["a", "c"])
    clinical.require_features(rows.select("a"), ["a"])
    clinical.require_features(rows.fillna(0.0).limit(0), ["b", "a"][::-1])
