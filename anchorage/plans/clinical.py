"""The clinical dataset: manifest, cohort, features, dataset, splits, matrix.

Each function is lazy unless it says that it materialises. The two tables every
later step hangs on, the cohort and the joined dataset, are written once: they
are read several times, are small next to the event tables, and once written
their true size lets the planner choose between broadcast and shuffle joins.
"""

from pyspark.sql import functions as F

from anchorage import config as C
from anchorage.functions import images, times
from anchorage.operators import features as feats
from anchorage.operators import lookback, prepare, quality, ranking, split
from anchorage.sources import sinks, tables


def frontal_images(cxr_meta):
    """Frontal images with a parsed time and a numeric subject."""
    kept = cxr_meta.where(F.col("ViewPosition").isin(C.FRONTAL_VIEWS))
    timed = kept.select(
        "subject_id",
        "study_id",
        "dicom_id",
        times.parse_study_time("StudyDate", "StudyTime").alias("cxr_time"),
    )
    return tables.cast_key(timed, "subject_id", "long")


def first_stays(icustays):
    return ranking.first(
        icustays.select("subject_id", "stay_id", "intime"), "subject_id", ["intime", "stay_id"]
    )


def images_manifest(t):
    """(subject_id, stay_id, study_id, dicom_id, icu_intime): one image per first stay."""
    stays = first_stays(t.icustays).withColumnRenamed("intime", "icu_intime")
    best = lookback.nearest(
        stays,
        frontal_images(t.cxr_meta),
        "subject_id",
        "icu_intime",
        "cxr_time",
        before=t.lookback.hours,
        tie="dicom_id",
        pick=t.lookback.pick,
    )
    return best.select("subject_id", "stay_id", "study_id", "dicom_id", "icu_intime")


def cohort(t, manifest=None):
    """Manifest joined to stay, admission and patient; one row per selected stay."""
    m = images_manifest(t) if manifest is None else manifest
    stays = t.icustays.select("stay_id", "subject_id", "hadm_id", F.col("intime").alias("icu_intime"))
    admissions = t.admissions.select("hadm_id", "admittime", C.LABEL)
    patients = t.patients.select("subject_id", "gender", "anchor_age", "anchor_year")
    joined = (
        m.select("stay_id", "dicom_id", "study_id")
        .join(stays, "stay_id")
        .join(admissions, "hadm_id")
        .join(patients, "subject_id")
    )
    return joined.select(
        "subject_id",
        "stay_id",
        "dicom_id",
        "study_id",
        "hadm_id",
        "icu_intime",
        "gender",
        times.age("anchor_age", "anchor_year", "admittime").alias("age"),
        C.LABEL,
    )


def lab_features(anchor, labevents, hours, found=None):
    """Labs belong to the subject: their admission is often unknown."""
    rows = feats.only_items(
        labevents.select("subject_id", "itemid", "charttime", "valuenum"), "itemid", "valuenum", C.LAB_CODES
    )
    near = lookback.join(anchor, rows, "subject_id", "icu_intime", "charttime", hours, found=found)
    return feats.flatten_long(near, "stay_id", "itemid", "valuenum", C.LAB_CODES)


def chart_features(anchor, chartevents, hours, found=None):
    """Bedside vitals, by stay."""
    rows = feats.only_items(
        chartevents.select("stay_id", "itemid", "charttime", "valuenum"), "itemid", "valuenum", C.CHART_CODES
    )
    stays = anchor.select("stay_id", "icu_intime")
    near = lookback.join(stays, rows, "stay_id", "icu_intime", "charttime", hours, found=found)
    return feats.flatten_long(near, "stay_id", "itemid", "valuenum", C.CHART_CODES, "_icu")


def ed_features(anchor, vitalsign, hours, found=None):
    """Emergency-department vitals, by subject."""
    rows = vitalsign.select("subject_id", "charttime", *C.ED_COLUMNS.values())
    near = lookback.join(anchor, rows, "subject_id", "icu_intime", "charttime", hours, found=found)
    return feats.flatten_wide(near, "stay_id", C.ED_COLUMNS, "_ed")


def measured(t, stays, kept):
    """The ``kept`` columns of every cohort stay and its 24 measurements, null where there are none.

    ``stays`` is read five times, so it should be a materialised cohort. It is
    looked over once to choose the joins. The three sources arrive partitioned by
    stay, so the left joins move only the cohort.
    """
    anchor = stays.select("stay_id", "subject_id", "icu_intime")
    hours = t.lookback.hours
    found = lookback.span(anchor, "subject_id", "icu_intime", hours)
    wide = (
        stays.select(*kept)
        .join(lab_features(anchor, t.labevents, hours, found), "stay_id", "left")
        .join(chart_features(anchor, t.chartevents, hours, found), "stay_id", "left")
        .join(ed_features(anchor, t.vitalsign, hours, found), "stay_id", "left")
    )
    labs = [f"{f}_{s}" for f in C.LABS for s in ("min", "max", "mean")]
    return wide.select(*kept, *labs, *feats.merged(C.VITALS, "_ed", "_icu"))


def features(t, stays):
    """(subject_id, stay_id, gender, age, label, 24 measurements) of a materialised cohort."""
    return measured(t, stays, ["subject_id", "stay_id", "gender", "age", C.LABEL])


def dataset(t, stays):
    """All cohort columns with the measurements."""
    return measured(t, stays, stays.columns)


def build(t):
    """Materialise the cohort and then the dataset; returns the dataset."""
    stays = sinks.materialize(cohort(t))
    return sinks.materialize(dataset(t, stays))


def check(ds):
    """Fail on nulls that differ within a feature, on any other missing value, on odd categories."""
    uneven = quality.null_consistency(ds, C.CORE).where("not ok")
    absent = quality.mandatory(ds, [c for c in ds.columns if c not in C.MEASUREMENTS])
    odd = quality.domain(ds.where(F.col("gender").isNotNull()), "gender", list(C.GENDER_CODES))
    problems = (
        uneven.selectExpr("'min, max and mean must be missing together' as problem", "feature as what")
        .unionByName(absent.selectExpr("'not allowed to be missing' as problem", "column as what"))
        .unionByName(odd.selectExpr("'unexpected gender' as problem", "value as what"))
    )
    quality.require(problems, "the dataset cannot be prepared")


def prepared(ds, key="subject_id", checked=True):
    """Dataset to model-ready rows with a ``split`` column.

    ``ds`` is read once for the checks, twice to fit the medians of the training
    split, and once for the result, so pass a materialised one.
    """
    if checked:
        check(ds)
    parts = split.by_hash(ds, key, C.SPLIT_FRACTIONS, C.SPLIT_SEED)
    medians = prepare.fit_medians(parts.where("split = 'train'"), C.MEASUREMENTS)
    return finish(parts, medians)


def finish(parts, medians):
    """Encode, flag and impute rows with medians fitted elsewhere."""
    slim = parts.drop("icu_intime", "stay_id", "hadm_id")
    coded = prepare.encode(slim, "gender", C.GENDER_CODES)
    return prepare.impute(prepare.indicators(coded, C.CORE), medians)


def training_stats(rows):
    """Mean and deviation of the imputed training rows."""
    return prepare.fit_stats(rows.where("split = 'train'"), C.CONTINUOUS)


def require_features(rows, order):
    """Fail where a feature is absent, null or NaN."""
    there = rows.select(*[c for c in order if c in rows.columns])
    quality.require(quality.contract(there, order).where("not ok"), "the features are not as agreed")


def model_matrix(rows, stats, base, ext, order=None, checked=True):
    """(split, image_path, features, label): standardised vectors in contract order.

    ``checked`` takes one pass over the standardised rows first. With fewer
    than two training rows there is no deviation to standardise by, and the matrix is empty.
    """
    if all(v is None for v in stats.select("std.*").first()):
        rows = rows.limit(0)
    scaled = prepare.standardize(rows, stats, C.CONTINUOUS)
    if checked:
        require_features(scaled, order or C.FEATURE_ORDER)
    located = scaled.withColumn(
        "image_path", images.path(base, "subject_id", "study_id", "dicom_id", ext)
    ).drop("subject_id", "study_id", "dicom_id")
    return prepare.assemble(located, order or C.FEATURE_ORDER, C.LABEL)
