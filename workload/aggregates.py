"""Aggregations, checks, reports, evaluation, lineage."""

from pyspark.sql import functions as F

from anchorage import config as C
from anchorage.operators import explore, features, learn, lookback, manifest, metrics, prepare, quality, split
from anchorage.plans import clinical, report
from anchorage.sources import files, sinks, stores
from workload.basics import (
    LINE_NUMBERS,
    MANIFEST_SQL,
    STATS_SQL,
    SUBJECT_VITALS_SQL,
    VITAL_COLUMNS,
    missing_sql,
    path_sql,
    rounded,
    split_case,
    stats_rows,
    subject_vitals,
)
from workload.joins import ANCHORS_SQL, COHORT_SQL, FLAT_SQL, merged_sql, rounded_sql, timed_images
from workload.registry import query
from workload.standins import HOURS, with_tables

LAB_COLUMNS = [f"{f}_{t}" for f in C.LABS for t in ("min", "max", "mean")]


def stat_columns(feats, suffix=""):
    return [f"{f}_{t}{suffix}" for f in feats for t in ("min", "max", "mean")]


# --- flattening and merging ---


@query(
    "agg_long_labs",
    sql=with_tables(f"select stay_id, {rounded_sql(LAB_COLUMNS)} from labs", anchors=ANCHORS_SQL, labs=FLAT_SQL["labs"]),
)
def agg_long_labs(s):
    return clinical.lab_features(s.anchors, s.labevents, HOURS).select("stay_id", *rounded(*LAB_COLUMNS))


@query(
    "agg_long_vitals",
    sql=with_tables(
        f"select stay_id, {rounded_sql(stat_columns(C.VITALS, '_icu'))} from icu",
        anchors=ANCHORS_SQL,
        icu=FLAT_SQL["icu"],
    ),
)
def agg_long_vitals(s):
    flat = clinical.chart_features(s.anchors, s.chartevents, HOURS)
    return flat.select("stay_id", *rounded(*stat_columns(C.VITALS, "_icu")))


@query(
    "agg_wide_vitals",
    sql=with_tables(
        f"select stay_id, {rounded_sql(stat_columns(C.VITALS, '_ed'))} from ed", anchors=ANCHORS_SQL, ed=FLAT_SQL["ed"]
    ),
)
def agg_wide_vitals(s):
    flat = clinical.ed_features(s.anchors, s.vitalsign, HOURS)
    return flat.select("stay_id", *rounded(*stat_columns(C.VITALS, "_ed")))


VITAL_MEASURES = [m for m in C.MEASUREMENTS if m not in LAB_COLUMNS]


@query(
    "merge_sources",
    sql=with_tables(
        f"""select stay_id, {rounded_sql(VITAL_MEASURES)} from (
  select anchors.stay_id, {merged_sql()} from anchors left join ed using (stay_id) left join icu using (stay_id))""",
        anchors=ANCHORS_SQL,
        icu=FLAT_SQL["icu"],
        ed=FLAT_SQL["ed"],
    ),
)
def merge_sources(s):
    both = (
        s.anchors.select("stay_id")
        .join(clinical.ed_features(s.anchors, s.vitalsign, HOURS), "stay_id", "left")
        .join(clinical.chart_features(s.anchors, s.chartevents, HOURS), "stay_id", "left")
    )
    return both.select("stay_id", *features.merged(C.VITALS, "_ed", "_icu")).select("stay_id", *rounded(*VITAL_MEASURES))


# --- fits ---


@query(
    "fit_median",
    sql=with_tables(
        "select " + ", ".join(f"round(median({c}), 6) as {c}" for c in VITAL_COLUMNS) + " from train",
        train=f"select * from vitalsign where {split_case('subject_id')} = 'train'",
    ),
)
def fit_median(s):
    parts = split.by_hash(s.vitalsign, "subject_id", C.SPLIT_FRACTIONS, C.SPLIT_SEED)
    return prepare.fit_medians(parts.where("split = 'train'"), VITAL_COLUMNS).select(*rounded(*VITAL_COLUMNS))


@query("fit_stats", sql=STATS_SQL)
def fit_stats(s):
    return stats_rows(prepare.fit_stats(s.raw("lineitem"), LINE_NUMBERS), LINE_NUMBERS)


# --- checks ---


@query(
    "missing_counts",
    sql=with_tables(missing_sql(["subject_id", "charttime", *VITAL_COLUMNS], "vitalsign")),
)
def missing_counts(s):
    return quality.missing_counts(s.vitalsign)


@query(
    "null_consistency",
    sql=with_tables(
        " union all ".join(
            f"""select '{f}' as feature, count(*) - count({f}_min) as min_nulls, count(*) - count({f}_max) as max_nulls,
       count(*) - count({f}_mean) as mean_nulls,
       count(*) filter (where ({f}_min is null) <> ({f}_max is null) or ({f}_max is null) <> ({f}_mean is null)) as rows_differing,
       true as ok from vitals"""
            for f in C.VITALS
        ),
        vitals=SUBJECT_VITALS_SQL,
    ),
)
def null_consistency(s):
    return quality.null_consistency(subject_vitals(s), C.VITALS)


@query(
    "domain_check",
    sql="select l_returnflag as value, count(*) as rows from lineitem where l_returnflag not in ('A', 'N') group by 1",
)
def domain_check(s):
    return quality.domain(s.raw("lineitem"), "l_returnflag", ["A", "N"])


@query(
    "mandatory_check",
    sql=with_tables(f"select * from ({missing_sql(['heartrate', 'sbp', 'o2sat'], 'vitalsign')}) where missing > 0"),
)
def mandatory_check(s):
    return quality.mandatory(s.vitalsign, ["heartrate", "sbp", "o2sat"])


# --- reports ---


@query(
    "label_balance",
    sql="""select cast(sum(quality) as bigint) as positives, count(quality) as total,
       round((count(quality) - sum(quality)) / sum(quality)::double, 6) as pos_weight from labels""",
)
def label_balance(s):
    return explore.label_balance(s.raw("labels"), "quality").withColumn("pos_weight", F.round("pos_weight", 6))


@query(
    "rate_by_flag",
    sql="""select toxic as flag, count(quality) as rows, round(avg(quality) * 100, 6) as rate_pct,
       round((select abs(avg(quality) filter (where toxic = 0) - avg(quality) filter (where toxic = 1)) * 100
              from labels), 6) as difference_pct
from labels group by toxic""",
)
def rate_by_flag(s):
    rates = explore.rate_by(s.raw("labels"), "toxic", "quality")
    return rates.select("flag", "rows", *rounded("rate_pct", "difference_pct"))


@query(
    "rate_ci",
    sql="""select toxic, count(quality) as rows, round(avg(quality), 6) as mean, true as interval_ok
from labels where quality is not null group by toxic""",
)
def rate_ci(s):
    """Draws have no SQL; the interval must hold the mean and be about as wide as the analytic one."""
    found = explore.bootstrap_mean(s.raw("labels"), "toxic", "quality")
    width = 2 * 1.96 * F.sqrt(F.col("mean") * (1 - F.col("mean")) / F.col("rows"))
    about = F.abs(F.col("high") - F.col("low") - width) <= 0.2 * width
    return found.select(
        "toxic", "rows", F.round("mean", 6).alias("mean"), (about & F.col("mean").between(F.col("low"), F.col("high"))).alias("interval_ok")
    )


@query(
    "corr_matrix",
    sql=with_tables(
        " union all ".join(
            f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r from vitalsign"
            for a in VITAL_COLUMNS
            for b in VITAL_COLUMNS
        )
    ),
)
def corr_matrix(s):
    return explore.corr(s.vitalsign, VITAL_COLUMNS).withColumn("r", F.round("r", 6))


WIDE = {f"{c}_{k}": f"{c} * {k} + abs({c} - {20 * k})" for c in VITAL_COLUMNS for k in range(1, 6)}
WIDE_SQL = f"select {', '.join(f'{e} as {n}' for n, e in WIDE.items())} from vitalsign"


@query(
    "corr_matrix_wide",
    sql=with_tables(
        " union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r from wide" for a in WIDE for b in WIDE),
        wide=WIDE_SQL,
    ),
)
def corr_matrix_wide(s):
    """25 columns, many of them with nulls."""
    wide = s.vitalsign.select(*[F.expr(f"{e} as {n}") for n, e in WIDE.items()])
    return explore.corr(wide).withColumn("r", F.round("r", 6))


RETURNED_SQL = f"select {', '.join(LINE_NUMBERS)}, l_linenumber, cast(l_returnflag = 'R' as int) as returned from lineitem"


def returned(s):
    """Line items with a 0/1 label."""
    return s.raw("lineitem").select(
        *LINE_NUMBERS, "l_linenumber", (F.col("l_returnflag") == "R").cast("int").alias("returned")
    )


@query(
    "corr_with_label",
    sql=f"""with rows as ({RETURNED_SQL}), r as ("""
    + " union all ".join(
        f"select '{c}' as \"column\", corr({c}, returned) as r from rows" for c in [*LINE_NUMBERS, "l_linenumber"]
    )
    + ') select "column", round(r, 6) as r from r order by r desc, "column" limit 9',
)
def corr_with_label(s):
    return explore.top_corr(returned(s), "returned", 10).withColumn("r", F.round("r", 6))


@query(
    "histogram_by_label",
    sql="""with r as (select min(l_extendedprice) as lo, (max(l_extendedprice) - min(l_extendedprice)) / 10.0::double as w
           from lineitem)
select l_returnflag, cast(least(floor((l_extendedprice - lo) / w), 9) as int) as bin,
       round(lo + least(floor((l_extendedprice - lo) / w), 9) * w, 6) as low, count(*) as rows
from lineitem, r group by all""",
)
def histogram_by_label(s):
    bins = explore.histogram(s.raw("lineitem"), "l_extendedprice", "l_returnflag", 10)
    return bins.withColumn("low", F.round("low", 6))


@query(
    "density_grid",
    sql="""with cells as (select l_returnflag, l_quantity as x, count(*) as n from lineitem group by all),
spread as (select l_returnflag, count(*) as rows, stddev_samp(l_quantity) * power(count(*), -0.2) as h
           from lineitem group by all),
grid as (select i as point, 0e0 + i * (51e0 / 24) as g from range(25) t(i))
select l_returnflag, cast(point as int) as point, round(g, 6) as x,
       round(sum(n * exp(-0.5 * ((g - cells.x) / h) * ((g - cells.x) / h))) / (any_value(rows) * any_value(h) * sqrt(2 * pi())), 6) as density
from cells join spread using (l_returnflag), grid group by l_returnflag, point, g""",
)
def density_grid(s):
    grid = explore.kde(s.raw("lineitem"), "l_quantity", "l_returnflag", 0.0, 51.0, 25)
    return grid.select("l_returnflag", "point", *rounded("x", "density"))


@query(
    "density_grid_binned",
    sql="""with r as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi,
                  (max(l_extendedprice) - min(l_extendedprice)) / 999e0 as w from lineitem),
placed as (select l_returnflag, lo, w, (l_extendedprice - lo) / w as t from lineitem, r),
cells as (select l_returnflag, lo + floor(t) * w as x, 1 - (t - floor(t)) as n from placed
          union all select l_returnflag, lo + (floor(t) + 1) * w as x, t - floor(t) as n from placed),
spread as (select l_returnflag, count(*) as rows, stddev_samp(l_extendedprice) * power(count(*), -0.2) as h
           from lineitem group by all),
grid as (select i as point, lo + i * ((hi - lo) / 24) as g from range(25) t(i), r)
select l_returnflag, cast(point as int) as point, round(g, 6) as x,
       round(1e6 * sum(n * exp(-0.5 * ((g - cells.x) / h) * ((g - cells.x) / h))) / (any_value(rows) * any_value(h) * sqrt(2 * pi())), 6) as density
from cells join spread using (l_returnflag), grid group by l_returnflag, point, g""",
)
def density_grid_binned(s):
    grid = explore.kde(s.raw("lineitem"), "l_extendedprice", "l_returnflag", points=25, bins=1000)
    return grid.withColumn("density", F.col("density") * 1e6).select("l_returnflag", "point", *rounded("x", "density"))


@query(
    "scatter_pairs",
    sql=with_tables(
        """select resprate, temperature, subject_id from vitalsign where resprate is not null and temperature is not null"""
    ),
)
def scatter_pairs(s):
    return explore.scatter(s.vitalsign, "resprate", "temperature", "subject_id")


@query(
    "distinct_subjects",
    sql=with_tables(
        """select subject_id, cxr_time, min(dicom_id) as dicom_id from images group by subject_id, cxr_time"""
    ),
)
def distinct_subjects(s):
    rows = timed_images(s).select("subject_id", "cxr_time", "dicom_id")
    return explore.first_per(rows, ["subject_id", "cxr_time"], ["dicom_id"])


@query("row_count", sql="select count(*) as rows from lineitem")
def row_count(s):
    return explore.row_count(s.raw("lineitem"))


# --- evaluation ---


@query(
    "epoch_loss",
    sql=with_tables(
        """select k % 10 as epoch, round(avg(value), 6) as mean_loss,
       round(sum(value * (1 + event_id % 32)) / sum(1 + event_id % 32), 6) as row_mean_loss
from ev group by 1"""
    ),
)
def epoch_loss(s):
    log = s.ev.select(
        (F.col("k") % 10).alias("epoch"), F.col("value").alias("loss"), (1 + F.col("event_id") % 32).alias("rows")
    )
    return metrics.epoch_loss(log, rows="rows").select("epoch", *rounded("mean_loss", "row_mean_loss"))


LOSS_SQL = f"""({C.POSITIVE_WEIGHT!r}::double * quality * ln(1 + exp(-logit))
              + (1 - quality) * ln(1 + exp(logit)))"""


@query("weighted_bce", sql=with_tables(f"select round(avg({LOSS_SQL}), 6) as loss from scored"))
def weighted_bce(s):
    return metrics.weighted_bce(s.scored, "logit", "quality", C.POSITIVE_WEIGHT).select(*rounded("loss"))


ORDERED_TEXT = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def text_sql(cols):
    return " || '|' || ".join(f"coalesce(length({c}::varchar)::varchar || ':' || {c}::varchar, '~')" for c in cols)


@query(
    "content_hash",
    sql=f"""select count(*) as rows, cast(sum(('0x' || substr(h, 1, 15))::bigint) as varchar) as slice_a,
       cast(sum(('0x' || substr(h, 16, 15))::bigint) as varchar) as slice_b
from (select md5({text_sql(ORDERED_TEXT)}) as h from events)""",
)
def content_hash(s):
    return manifest.fingerprint(s.raw("events"), ORDERED_TEXT, digest="md5")


def curve_sql(by="", source="scored"):
    """Running counts per distinct score in descending order, optionally per group."""
    keep, part = (f"{by}, ", f"partition by {by}") if by else ("", "")
    return f"""select {keep}score, rows, pos, rows - pos as neg,
       sum(pos) over ({part} order by score desc) as tp, sum(rows - pos) over ({part} order by score desc) as fp,
       sum(pos) over ({part}) as p, sum(rows - pos) over ({part}) as n
from (select {keep}{'n_chars' if source == 'scored' else 'score'}::double as score, count(*) as rows, sum(quality) as pos
      from {source} group by all)"""


AUROC_SQL = "sum(neg * (tp - pos / 2.0::double)) / nullif(max(p)::double * max(n), 0)"
AP_SQL = "coalesce(sum(pos / nullif(p, 0)::double * (tp / (tp + fp)::double)), 0)"
SENS_SQL = """case when max(p) > 0 then
       coalesce(max(tp / nullif(p, 0)::double) filter (where fp / nullif(n, 0)::double <= 0.05::double), 0) end"""


@query(
    "cumulative_counts",
    sql=with_tables(
        """select score, cast(rows as bigint) as rows, cast(tp as bigint) as tp, cast(fp as bigint) as fp from c""",
        c=curve_sql(),
    ),
)
def cumulative_counts(s):
    return metrics.curve(s.scored, "n_chars", "quality").select("score", "rows", "tp", "fp")


@query(
    "roc_curve",
    sql=with_tables(
        """select score as threshold, round(fp / n::double, 6) as fpr, round(tp / p::double, 6) as tpr from c
union all select 'infinity'::double, 0.0, 0.0""",
        c=curve_sql(),
    ),
)
def roc_curve(s):
    return metrics.roc(s.scored, "n_chars", "quality").select("threshold", *rounded("fpr", "tpr"))


@query("auroc", sql=with_tables(f'select round({AUROC_SQL}, 6) as "AUROC" from c', c=curve_sql()))
def auroc(s):
    return metrics.auroc(s.scored, "n_chars", "quality").select(*rounded("AUROC"))


@query("average_precision", sql=with_tables(f'select round({AP_SQL}, 6) as "AUPRC" from c', c=curve_sql()))
def average_precision(s):
    return metrics.average_precision(s.scored, "n_chars", "quality").select(*rounded("AUPRC"))


@query("sens_at_spec", sql=with_tables(f"select round({SENS_SQL}, 6) as sensitivity from c", c=curve_sql()))
def sens_at_spec(s):
    return metrics.sens_at_spec(s.scored, "n_chars", "quality").select(*rounded("sensitivity"))


@query(
    "evaluation_report",
    sql=with_tables(
        f"""select lang, round({AUROC_SQL}, 6) as "AUROC", round({AP_SQL}, 6) as "AUPRC",
       round({SENS_SQL}, 6) as sens_at_95_spec, round(any_value(l), 6) as loss
from c join (select lang, avg({LOSS_SQL}) as l from scored group by lang) using (lang) group by lang""",
        c=curve_sql("lang"),
    ),
)
def evaluation_report(s):
    table = metrics.report(s.scored, "logit", "quality", C.POSITIVE_WEIGHT, by="lang")
    return table.select("lang", *rounded("loss", *metrics.METRICS))


@query(
    "best_epoch",
    sql=with_tables(
        """select epoch, round(mean_loss, 6) as mean_loss from (select k % 10 as epoch, avg(value) as mean_loss from ev group by 1)
order by mean_loss, epoch limit 1"""
    ),
)
def best_epoch(s):
    log = s.ev.select((F.col("k") % 10).alias("epoch"), F.col("value").alias("loss"))
    found = metrics.best(metrics.epoch_loss(log), "mean_loss", mode="lower")
    return found.select("epoch", *rounded("mean_loss"))


BASELINE_FEATURES = [*LINE_NUMBERS, "l_linenumber"]


def baseline(s):
    """The model, and the rows it is fitted to and scored on."""
    rows = s.raw("lineitem").select(
        "l_orderkey", *BASELINE_FEATURES, (F.col("l_returnflag") == "R").cast("int").alias("returned")
    )
    parts = split.by_hash(rows, "l_orderkey", C.SPLIT_FRACTIONS, C.SPLIT_SEED)
    train, val = (parts.where(F.col("split") == name) for name in ("train", "val"))
    return learn.fit_baseline(train, BASELINE_FEATURES, "returned", C.POSITIVE_WEIGHT), train, val


@query(
    "weighted_baseline",
    sql=f"""with train as (select (l_returnflag = 'R')::int as returned from lineitem where {split_case('l_orderkey')} = 'train')
select unnest({["intercept", *BASELINE_FEATURES]}) as term, rows, positives, true as converged
from (select count(*) as rows, cast(sum(returned) as bigint) as positives from train)""",
)
def weighted_baseline(s):
    """At the best fit, and only there, the loss has no slope in any term."""
    model, train, _ = baseline(s)
    found = learn.gradients(model, train, BASELINE_FEATURES, "returned", C.POSITIVE_WEIGHT)
    return found.select("term", "rows", "positives", (F.abs("gradient") < 1e-4).alias("converged"))


@query("baseline_report")
def baseline_report(s):
    model, _, val = baseline(s)
    return metrics.report(learn.score(model, val), "logit", "returned", 1.0)


# --- lineage and contracts ---


MANIFEST_PARAMS = {"dataset.loss_positive_weight": C.POSITIVE_WEIGHT, "lookback.hours": HOURS}
MANIFEST_ROWS = {
    "source.git_sha": "stand-in",
    "source.git_ref": "workload",
    "dataset.events_filepath": "events.parquet",
    "dataset.customer_filepath": "customer.parquet",
    **{k: str(v) for k, v in MANIFEST_PARAMS.items()},
}
CUSTOMER_TEXT = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
MANIFEST_RANGE = 1000  # bytes, so that most of the files have several ranges


def fingerprint_sql(key, cols, source):
    return f"""select 'dataset.{key}' as key, count(*)::varchar || ':'
       || cast(sum(('0x' || substr(h, 1, 15))::bigint) as varchar) || ':'
       || cast(sum(('0x' || substr(h, 16, 15))::bigint) as varchar) as value
from (select md5({text_sql(cols)}) as h from {source})"""


@query(
    "run_manifest",
    sql=f"""with written as (
    select 'n' || c_nationkey % 5 || '/nation-' || c_nationkey || '.csv' as path,
        string_agg(c_custkey || ',' || c_name || ',' || c_mktsegment || chr(10), '' order by c_custkey) as content
    from customer group by c_nationkey
),
ranges as (select *, unnest(range(0, length(content), {MANIFEST_RANGE})) as a from written),
files as (
    select path, length(content) as length, sha256(string_agg(sha256(substr(content, a + 1, {MANIFEST_RANGE})), '' order by a)) as sha256
    from ranges group by path, content
)
{fingerprint_sql("events_fingerprint", ORDERED_TEXT, "events")}
union all {fingerprint_sql("customer_fingerprint", CUSTOMER_TEXT, "customer")}
union all {fingerprint_sql("customer_files", ["path", "length", "sha256"], "files")}
"""
    + "".join(f" union all select '{k}', '{v}'" for k, v in MANIFEST_ROWS.items()),
)
def run_manifest(s):
    """Both inputs and the files written from one; all but the environment rows, which differ from machine to machine."""
    line = F.concat_ws(",", "c_custkey", "c_name", "c_mktsegment")
    lines = F.array_sort(F.collect_list(F.struct("c_custkey", F.concat(line, F.lit("\n")).alias("line"))))
    name = F.format_string("n%d/nation-%d.csv", F.col("c_nationkey") % 5, F.col("c_nationkey"))
    content = s.raw("customer").groupBy("c_nationkey").agg(F.array_join(lines["line"], "").alias("content"))
    folder = files.write_files(content.withColumn("path", name), sinks.scratch(s.spark))
    stores.delete_at_exit(s.spark, folder)
    table = manifest.build(
        s.spark,
        {"events": s.raw("events").select(*ORDERED_TEXT), "customer": s.raw("customer").select(*CUSTOMER_TEXT)},
        MANIFEST_PARAMS,
        {k: MANIFEST_ROWS[f"dataset.{k}_filepath"] for k in ("events", "customer")},
        revision=MANIFEST_ROWS["source.git_sha"],
        ref=MANIFEST_ROWS["source.git_ref"],
        folders={"customer": folder},
        digest="md5",
        size=MANIFEST_RANGE,
    )
    return table.where("key not like 'environment.%'")


@query(
    "feature_contract",
    sql=with_tables(
        " union all ".join(
            f"""select {i} as position, '{w}' as expected, '{h}' as actual,
       count(*) - count({h}) as bad_rows, count(*) = count({h}) and {w == h} as ok from vitalsign"""
            for i, (w, h) in enumerate(
                zip(["sbp", "heartrate", "resprate", "temperature", "o2sat"], VITAL_COLUMNS)
            )
        )
    ),
)
def feature_contract(s):
    wanted = ["sbp", "heartrate", "resprate", "temperature", "o2sat"]
    return quality.contract(s.vitalsign.select(*VITAL_COLUMNS), wanted)


# --- composed plans from the features on ---

PLAN_SQL = {
    "manifest": MANIFEST_SQL,
    "stays": COHORT_SQL,
    "anchors": "select stay_id, subject_id, icu_intime from stays",
    **FLAT_SQL,
    "measured": f"""select stays.stay_id, labs.* exclude (stay_id), {merged_sql()}
from stays left join labs using (stay_id) left join icu using (stay_id) left join ed using (stay_id)""",
    "ds": "select * from stays left join measured using (stay_id)",
}


@query(
    "features",
    sql=with_tables(
        f"""select subject_id, stay_id, gender, age, hospital_expire_flag, {rounded_sql(C.MEASUREMENTS)} from ds""",
        **PLAN_SQL,
    ),
)
def features_query(s):
    t = s.tables()
    wide = clinical.features(t, sinks.materialize(clinical.cohort(t)))
    return wide.select("subject_id", "stay_id", "gender", "age", C.LABEL, *rounded(*C.MEASUREMENTS))


COHORT_COLUMNS = ["subject_id", "stay_id", "dicom_id", "study_id", "hadm_id", "icu_intime", "gender", "age", C.LABEL]


@query(
    "dataset",
    sql=with_tables(f"select {', '.join(COHORT_COLUMNS)}, {rounded_sql(C.MEASUREMENTS)} from ds", **PLAN_SQL),
)
def dataset(s):
    return clinical.build(s.tables()).select(*COHORT_COLUMNS, *rounded(*C.MEASUREMENTS))


PREPARED_SQL = {
    **PLAN_SQL,
    "parts": f"select *, {split_case('subject_id')} as split from ds",
    "med": "select "
    + ", ".join(f"median({c}) as {c}" for c in C.MEASUREMENTS)
    + " from parts where split = 'train'",
    "ready": "select p.subject_id, p.dicom_id, p.study_id, cast(case p.gender when 'M' then 0 else 1 end as int) as gender, "
    "p.age, p.hospital_expire_flag, p.split, "
    + ", ".join(f"coalesce(p.{c}, med.{c}) as {c}" for c in C.MEASUREMENTS)
    + ", "
    + ", ".join(f"cast(p.{f}_max is null as int) as {f}_missing" for f in C.CORE)
    + " from parts p, med",
}
READY_COLUMNS = ["subject_id", "dicom_id", "study_id", "gender", "age", C.LABEL, "split", *C.INDICATORS]


@query(
    "prepared_splits",
    sql=with_tables(f"select {', '.join(READY_COLUMNS)}, {rounded_sql(C.MEASUREMENTS)} from ready", **PREPARED_SQL),
)
def prepared_splits(s):
    rows = clinical.prepared(clinical.build(s.tables()))
    return rows.select(*READY_COLUMNS, *rounded(*C.MEASUREMENTS))


def scaled_sql(c):
    if c not in C.CONTINUOUS:
        return f"ready.{c}::double"
    return f"(ready.{c} - (select avg({c}) from train)) / ((select stddev_samp({c}) from train) + 1e-8)"


@query(
    "model_matrix",
    sql=with_tables(
        "select split, image_path, hospital_expire_flag::float as hospital_expire_flag, "
        + ", ".join(f"round(cast({scaled_sql(c)} as float)::double, 4) as {c}" for c in C.FEATURE_ORDER)
        + f" from ready join ({path_sql('ready').replace('as path', 'as image_path, dicom_id')}) using (dicom_id)"
        + " where (select count(*) from train) > 1",
        **PREPARED_SQL,
        train="select * from ready where split = 'train'",
    ),
)
def model_matrix(s):
    rows = sinks.materialize(clinical.prepared(clinical.build(s.tables())))
    matrix = clinical.model_matrix(rows, sinks.materialize(clinical.training_stats(rows)), "b/", ".jpg")
    # the vector is spread over named columns so that it can be compared by value
    return matrix.select(
        "split",
        "image_path",
        C.LABEL,
        *[F.round(F.col("features")[i].cast("double"), 4).alias(c) for i, c in enumerate(C.FEATURE_ORDER)],
    )


@query(
    "explore_report",
    sql=with_tables(
        """select 'missing' as section, name, value from missing where value > 0
union all select 'balance', 'positives', cast(sum(hospital_expire_flag) as double) from flagged
union all select 'balance', 'total', cast(count(*) as double) from flagged
union all select 'balance', 'pos_weight', round((count(*) - sum(hospital_expire_flag)) / sum(hospital_expire_flag)::double, 6) from flagged
union all select 'rate', resp_rate_missing::varchar, round(avg(hospital_expire_flag) * 100, 6) from flagged group by resp_rate_missing
union all select 'correlation', name, round(r, 6) from (select * from r order by r desc, name limit 9)""",
        vitals=SUBJECT_VITALS_SQL,
        flagged="select *, cast(resp_rate_max is null as int) as resp_rate_missing, "
        "cast(subject_id % 3 = 0 as int) as hospital_expire_flag from vitals",
        missing=" union all ".join(
            f"select '{f}_{t}' as name, cast(count(*) - count({f}_{t}) as double) as value from flagged"
            for f in C.VITALS
            for t in ("min", "max", "mean")
        ),
        r=" union all ".join(
            f"select '{f}_{t}' as name, corr({f}_{t}, hospital_expire_flag) as r from flagged"
            for f in C.VITALS
            for t in ("min", "max", "mean")
        ),
    ),
)
def explore_report(s):
    rows = prepare.indicators(subject_vitals(s), ["resp_rate"]).withColumn(
        C.LABEL, (F.col("subject_id") % 3 == 0).cast("int")
    )
    table = report.explore_report(rows, C.LABEL, "resp_rate_missing", stat_columns(C.VITALS))
    return table.withColumn("value", F.round("value", 6))
