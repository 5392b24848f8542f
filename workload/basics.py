"""Scans, sources and sinks, scalar functions, filters."""

import uuid
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anchorage import config as C
from anchorage.functions import images, times, values
from anchorage.operators import explore, features, moments, prepare, profiles, quality, ranking, split
from anchorage.plans import clinical
from anchorage.sources import files, runs, sinks, stores, tables
from workload.registry import query
from workload.standins import HOURS, with_tables

CXR_SCHEMA = T.StructType(
    [
        T.StructField("subject_id", T.StringType()),
        T.StructField("dicom_id", T.StringType()),
        T.StructField("study_id", T.LongType()),
        T.StructField("StudyDate", T.StringType()),
        T.StructField("StudyTime", T.StringType()),
        T.StructField("ViewPosition", T.StringType()),
    ]
)
VITAL_COLUMNS = list(C.ED_COLUMNS.values())
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def rounded(*cols, digits=6):
    return [F.expr(f"round(`{c}`, {digits}) as `{c}`") for c in cols]


# --- scans, sources, sinks ---


@query("scan_table", sql="select event_id, user_id, event_type from events")
def scan_table(s):
    return tables.table(s.spark, f"{s.dir}/events.parquet", ["event_id", "user_id", "event_type"])


@query("csv_typed_scan", sql=with_tables("select * from cxr_meta"))
def csv_typed_scan(s):
    path = sinks.write(s.cxr_meta, sinks.scratch(s.spark), "csv")
    return tables.read_csv(s.spark, path, CXR_SCHEMA)


@query(
    "csv_inferred_scan",
    sql=with_tables(
        """select cast(subject_id as bigint) as subject_id, dicom_id, study_id,
       cast(StudyDate as bigint) as study_date, cast(StudyTime as double) as study_time
from cxr_meta"""
    ),
)
def csv_inferred_scan(s):
    path = sinks.write(s.cxr_meta, sinks.scratch(s.spark), "csv")
    # inference reads ids as numbers and the time as a double, losing its zeros
    return tables.read_csv(s.spark, path).select(
        F.col("subject_id").cast("bigint"),
        "dicom_id",
        F.col("study_id").cast("bigint"),
        F.col("StudyDate").cast("bigint").alias("study_date"),
        F.col("StudyTime").alias("study_time"),
    )


BROKEN_SQL = """case study_id % 7 when 0 then line || ',more' when 1 then 'x' || line when 2 then 'only,two' else line end"""


@query(
    "csv_rejects",
    sql=with_tables(
        """select 'good' as state, study_id, cast(null as varchar) as line from lines where study_id % 7 > 2
union all select 'rejected', null, broken from lines where study_id % 7 <= 2
union all select 'counted', count(*), cast(null as varchar) from lines""",
        lines=f"""select study_id, {BROKEN_SQL} as broken
from (select study_id, study_id || ',' || dicom_id || ',' || ViewPosition as line from cxr_meta)""",
    ),
)
def csv_rejects(s):
    """Lines with a field too many, too few or of a wrong type go to the rejected ones; none is lost."""
    line = s.cxr_meta.select("study_id", F.concat_ws(",", "study_id", "dicom_id", "ViewPosition").alias("line"))
    path = sinks.write_lines(line.select(F.expr(BROKEN_SQL).alias("line")), sinks.scratch(s.spark), "line")
    stores.delete_at_exit(s.spark, path)
    schema = "study_id long, dicom_id string, ViewPosition string"
    good, rejected = tables.read_csv_rejects(s.spark, path, schema, header=False)
    counted = good.select("study_id").union(rejected.select(F.lit(0).cast("long"))).agg(F.count(F.lit(1)).alias("study_id"))
    return (
        good.select(F.lit("good").alias("state"), "study_id", F.lit(None).cast("string").alias("line"))
        .union(rejected.select(F.lit("rejected"), F.lit(None).cast("long"), "line"))
        .union(counted.select(F.lit("counted"), "study_id", F.lit(None).cast("string")))
    )


@query(
    "cast_key_rejects",
    sql="""select 'good' as state, count(*) as rows, sum(k)::bigint as total
from (select try_cast(case when user_id % 5 = 0 then 'u' || user_id else user_id::varchar end as bigint) as k from events) where k is not null
union all select 'rejected', count(*), cast(null as bigint) from events where user_id % 5 = 0""",
)
def cast_key_rejects(s):
    """Keys as text, of which every fifth is no number."""
    key = F.when(F.col("user_id") % 5 == 0, F.concat(F.lit("u"), F.col("user_id"))).otherwise(F.col("user_id").cast("string"))
    good, rejected = tables.cast_key_rejects(s.raw("events").select(key.alias("k")), "k", "bigint")
    return good.agg(F.lit("good").alias("state"), F.count(F.lit(1)).alias("rows"), F.sum("k").alias("total")).union(
        rejected.agg(F.lit("rejected"), F.count(F.lit(1)), F.lit(None).cast("long"))
    )


@query(
    "frame_as_relation",
    sql=with_tables(
        """select p.gender, count(*) as stays, min(s.intime) as earliest
from icustays s join patients p on p.subject_id = s.subject_id group by p.gender"""
    ),
)
def frame_as_relation(s):
    return tables.sql(
        s.spark,
        """select p.gender, count(*) as stays, min(s.intime) as earliest
           from {stays} s join {people} p on p.subject_id = s.subject_id group by p.gender""",
        stays=s.icustays,
        people=s.patients,
    )


def split_case(key, seed=42, train=8000, val=9800):
    bucket = f"('0x' || substr(md5(concat('{seed}|', {key}::varchar)), 1, 8))::bigint % 10000"
    return f"case when {bucket} < {train} then 'train' when {bucket} < {val} then 'val' else 'test' end"


@query(
    "write_splits",
    sql=with_tables(f"select subject_id, stay_id, hadm_id, {split_case('subject_id')} as split from first_stay"),
)
def write_splits(s):
    """All splits become readable at once; each is its own dataset."""
    parts = split.by_hash(
        s.first_stay.select("subject_id", "stay_id", "hadm_id"), "subject_id", C.SPLIT_FRACTIONS, C.SPLIT_SEED
    )
    root, names = sinks.scratch(s.spark), list(C.SPLIT_FRACTIONS)
    sinks.publish_splits(parts, root, names)
    stores.delete_at_exit(s.spark, root)
    found = sinks.published(s.spark, root)
    return reduce(DataFrame.unionByName, [found[n].withColumn("split", F.lit(n)) for n in names])


@query(
    "write_intermediate",
    sql=with_tables(
        "select subject_id, count(*) as readings, max(heartrate) as heartrate_max from vitalsign group by subject_id"
    ),
)
def write_intermediate(s):
    """Two stored steps of a run that goes on from its ledger when it is started again."""
    with runs.Run(s.spark, f"vitals-{uuid.uuid4().hex}", {"inputs": s.dir}, keep=True) as run:
        run.step("vitalsign", lambda: s.vitalsign)
    with runs.Run(s.spark, run.name, {"inputs": s.dir}) as again:
        vitals = again.step("vitalsign", lambda: s.vitalsign.limit(0))  # from the ledger
        counted = vitals.groupBy("subject_id").agg(
            F.count(F.lit(1)).alias("readings"), F.max("heartrate").alias("heartrate_max")
        )
        return sinks.materialize(again.step("counted", lambda: counted))


def stats_rows(stats, cols, digits=6):
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.round(F.col(f"mean.{c}"), digits).alias("mean"),
            F.round(F.col(f"std.{c}"), digits).alias("std"),
        )
        for c in cols
    ]
    return stats.select(F.inline(F.array(*cells)))


STATS_SQL = " union all ".join(
    f"select '{c}' as \"column\", round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std from lineitem"
    for c in LINE_NUMBERS
)


@query("stats_json", sql=STATS_SQL)
def stats_json(s):
    path = sinks.write_stats(prepare.fit_stats(s.raw("lineitem"), LINE_NUMBERS), sinks.scratch(s.spark))
    return stats_rows(sinks.read_stats(s.spark, path, LINE_NUMBERS), LINE_NUMBERS)


@query("stats_json_merged", sql=STATS_SQL.replace(", 6)", ", 5)"))
def stats_json_merged(s):
    """Statistics of the whole from the stored states of three parts, without their rows."""
    rows, paths = s.raw("lineitem"), []
    for k in range(3):
        part = moments.state(rows.where(F.col("l_orderkey") % 3 == k), LINE_NUMBERS)
        paths.append(moments.write(part, sinks.scratch(s.spark)))
        stores.delete_at_exit(s.spark, paths[-1])
    merged = moments.merge(*[moments.read(s.spark, p) for p in paths])
    return stats_rows(moments.stats(merged, LINE_NUMBERS), LINE_NUMBERS, digits=5)


@query(
    "corr_merged",
    sql=" union all ".join(
        f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r from lineitem" for a, b in combinations(LINE_NUMBERS, 2)
    ),
)
def corr_merged(s):
    """Correlations of the whole from the states of parts."""
    rows = s.raw("lineitem")
    parts = [moments.state(rows.where(F.col("l_orderkey") % 2 == k), LINE_NUMBERS, pairs=True) for k in range(2)]
    return moments.corr(moments.merge(*parts)).withColumn("r", F.round("r", 6))


VITALSIGN_TYPES = [
    ("subject_id", "bigint"),
    ("charttime", "timestamp_ntz"),
    ("heartrate", "double"),
    ("sbp", "double"),
    ("resprate", "double"),
    ("temperature", "double"),
    ("o2sat", "double"),
]


@query(
    "schema_report",
    sql=with_tables(
        " union all ".join(
            f"select {i} as position, '{c}' as \"column\", '{t}' as type, {c == 'sbp'} as onehot, "
            f"count(*) as rows, count(*) - count({c}) as nulls from vitalsign"
            for i, (c, t) in enumerate(VITALSIGN_TYPES)
        )
    ),
)
def schema_report(s):
    return quality.schema_report(s.vitalsign, onehot=["sbp"])


PROFILED = ["event_id", "user_id", "event_type", "value"]


@query(
    "column_profiles",
    sql=" union all ".join(
        f"select {i} as position, '{c}' as \"column\", count(*) as rows, count(*) - count({c}) as nulls, "
        f"{f'count(distinct {c})' if c == 'event_type' else 'null'} as \"distinct\", true as within from events"
        for i, c in enumerate(PROFILED)
    ),
)
def column_profiles(s):
    """Profiles of two parts, merged; estimates must be within three standard errors of a plain count."""
    events = s.raw("events")
    parts = [profiles.state(events.where(F.col("event_id") % 2 == k), PROFILED) for k in range(2)]
    found = profiles.report(profiles.merge(*parts))
    exact = events.agg(*[F.count_distinct(c).alias(c) for c in PROFILED]).unpivot([], PROFILED, "column", "exact")
    error = F.abs(F.col("distinct") - F.col("exact"))
    return found.join(exact, "column").select(
        "position",
        "column",
        "rows",
        "nulls",
        # few values are counted exactly
        F.when(F.col("column") == "event_type", F.col("distinct")).alias("distinct"),
        (error <= 0.05 * F.col("exact")).alias("within"),
    )


@query(
    "frequent_values",
    sql=" union all ".join(
        f"select '{c}' as \"column\", cast({c} as varchar) as value, count(*) as count from lineitem "
        f"where {c} is not null group by {c}"
        for c in ("l_returnflag", "l_linestatus", "l_linenumber")
    ),
)
def frequent_values(s):
    """All values of three columns with few of them, from states of two parts."""
    cols = ["l_returnflag", "l_linestatus", "l_linenumber"]
    rows = s.raw("lineitem")
    parts = [profiles.state(rows.where(F.col("l_orderkey") % 2 == k), cols) for k in range(2)]
    return profiles.frequent(profiles.merge(*parts), 100)


LISTED = ["customer", "documents", "events", "lineitem", "orders", "part"]


@query(
    "table_listing",
    sql=" union all ".join(f"select '{t}' as name, count(*) as rows from {t}" for t in LISTED),
)
def table_listing(s):
    """The given tables as views, as the catalog lists them, with their numbers of rows."""
    views = {f"listed_{t}": t for t in LISTED}
    for view, t in views.items():
        s.raw(t).createOrReplaceTempView(view)
    names = tables.list_tables(s.spark).where(F.col("name").isin(list(views)))
    counts = [s.spark.table(v).agg(F.lit(v).alias("name"), F.count(F.lit(1)).alias("rows")) for v in views]
    listed = names.join(reduce(lambda a, b: a.unionByName(b), counts), "name")
    return listed.select(F.replace("name", F.lit("listed_"), F.lit("")).alias("name"), "rows")


def path_sql(table, base="b", ext="jpg"):
    return (
        f"select '{base}/p' || substr(subject_id::varchar, 1, 2) || '/p' || subject_id || '/s' || study_id "
        f"|| '/' || dicom_id || '.{ext}' as path from {table}"
    )


def image_paths(df, base="b/", ext=".jpg"):
    return df.select(images.path(base, "subject_id", "study_id", "dicom_id", ext).alias("path"))


@query(
    "image_inventory",
    sql=with_tables(
        f"""select path, 'missing' as state from (select path from expected except select path from present)
union all select path, 'surplus' from (select path from present except select path from expected)""",
        expected=path_sql("cxr_meta"),
        present=f"""{path_sql("cxr_meta where ViewPosition in ('AP', 'PA')")}
union all {path_sql("cxr_meta where ViewPosition not in ('AP', 'PA') and study_id % 2 = 0", ext="dicom")}""",
    ),
)
def image_inventory(s):
    """Expected images against a folder that holds the frontal ones, and others in another format."""
    frontal = F.col("ViewPosition").isin(C.FRONTAL_VIEWS)
    others = s.cxr_meta.where(~frontal & (F.col("study_id") % 2 == 0))
    present = image_paths(s.cxr_meta.where(frontal)).union(image_paths(others, ext=".dicom"))
    root = sinks.scratch(s.spark)
    files.write_files(present.select(F.expr("substr(path, 3)").alias("path"), F.col("path").alias("content")), f"{root}/b")
    stores.delete_at_exit(s.spark, root)
    found = quality.listing(s.spark, f"{root}/b").withColumn("path", F.expr(f"substr(path, {len(root) + 2})"))
    return quality.inventory(image_paths(s.cxr_meta), found)


MANIFEST_SQL = f"""
select f.subject_id, f.stay_id, i.study_id, i.dicom_id, f.intime as icu_intime
from first_stay f join images i on i.subject_id = f.subject_id
where i.ViewPosition in ('AP', 'PA') and f.intime - i.cxr_time between interval 0 hours and interval {HOURS} hours
qualify row_number() over (partition by f.stay_id order by i.cxr_time desc, i.dicom_id) = 1"""


@query(
    "image_urls",
    sql=with_tables(
        """select 'https://example.org/files/p' || substr(subject_id::varchar, 1, 2) || '/p' || subject_id
       || '/s' || study_id || '/' || dicom_id || '.jpg' as url from manifest""",
        manifest=MANIFEST_SQL,
    ),
)
def image_urls(s):
    urls = clinical.images_manifest(s.tables()).select(
        images.url("https://example.org/files", "subject_id", "study_id", "dicom_id").alias("url")
    )
    return s.spark.read.text(sinks.write_lines(urls, sinks.scratch(s.spark), "url")).toDF("url")


@query(
    "study_listing",
    sql=with_tables(
        """select subject_id, StudyDate, count(*) as files, count(distinct study_id) as studies
from cxr_meta group by subject_id, StudyDate"""
    ),
)
def study_listing(s):
    return explore.study_counts(s.cxr_meta)


# --- projections and scalar functions ---


@query(
    "project_alias",
    sql="""select l_orderkey as order_id, l_linenumber as line, l_extendedprice as price,
       l_shipdate as shipped from lineitem""",
)
def project_alias(s):
    return s.raw("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("shipped"),
    )


@query("star_exclude", sql="select * exclude (o_orderpriority, o_orderstatus) from orders")
def star_exclude(s):
    return s.raw("orders").drop("o_orderpriority", "o_orderstatus")


@query(
    "conditional_value",
    sql=with_tables(
        """select subject_id, charttime, case when itemid in (50809, 50931) then valuenum end as glucose,
       case when itemid = 50813 then valuenum end as lactate,
       case when itemid = 50912 then valuenum end as creatinine
from labevents"""
    ),
)
def conditional_value(s):
    return s.labevents.select(
        "subject_id",
        "charttime",
        *[values.when_item("itemid", codes, "valuenum").alias(f) for f, codes in C.LAB_CODES.items()],
    )


@query("parse_study_time", sql=with_tables("select dicom_id, cxr_time from images"))
def parse_study_time(s):
    return s.cxr_meta.select("dicom_id", times.parse_study_time("StudyDate", "StudyTime").alias("cxr_time"))


@query("cast_key", sql=with_tables("select subject_id, dicom_id from images"))
def cast_key(s):
    return tables.cast_key(s.cxr_meta.select("subject_id", "dicom_id"), "subject_id", "long")


@query(
    "interval_bounds",
    sql=with_tables(
        """select stay_id, intime - interval 24 hours as low, intime + interval 24 hours as high from icustays"""
    ),
)
def interval_bounds(s):
    low, high = times.bounds("intime", 24, 24)
    return s.icustays.select("stay_id", low.alias("low"), high.alias("high"))


@query(
    "seconds_between",
    sql=with_tables(
        """select stay_id, dicom_id, date_diff('second', intime, cxr_time) as signed,
       abs(date_diff('second', intime, cxr_time)) as gap
from first_stay join images using (subject_id)"""
    ),
)
def seconds_between(s):
    timed = tables.cast_key(
        s.cxr_meta.select(
            "subject_id", "dicom_id", times.parse_study_time("StudyDate", "StudyTime").alias("cxr_time")
        ),
        "subject_id",
        "long",
    )
    diff = times.seconds("intime", "cxr_time")
    return s.first_stay.join(timed, "subject_id").select(
        "stay_id", "dicom_id", diff.alias("signed"), F.abs(diff).alias("gap")
    )


@query(
    "derive_age",
    sql=with_tables(
        """select a.hadm_id, cast(anchor_age + year(admittime) - anchor_year as bigint) as age
from admissions a join patients p using (subject_id)"""
    ),
)
def derive_age(s):
    return s.admissions.join(s.patients, "subject_id").select(
        "hadm_id", times.age("anchor_age", "anchor_year", "admittime").alias("age")
    )


@query(
    "prefer_first",
    sql=with_tables("select subject_id, charttime, coalesce(sbp, resprate, o2sat) as chosen from vitalsign"),
)
def prefer_first(s):
    return s.vitalsign.select("subject_id", "charttime", values.prefer("sbp", "resprate", "o2sat").alias("chosen"))


@query(
    "merge_extrema",
    sql=with_tables(
        """select subject_id, charttime, least(sbp, resprate, o2sat) as low, greatest(sbp, resprate, o2sat) as high
from vitalsign"""
    ),
)
def merge_extrema(s):
    cols = ["sbp", "resprate", "o2sat"]
    return s.vitalsign.select(
        "subject_id", "charttime", values.merge_min(*cols).alias("low"), values.merge_max(*cols).alias("high")
    )


@query(
    "encode_category",
    sql=with_tables(
        """select subject_id, cast(case gender when 'M' then 0 else 1 end as int) as gender, anchor_age, anchor_year
from patients"""
    ),
)
def encode_category(s):
    return prepare.encode(s.patients, "gender", C.GENDER_CODES)


def subject_vitals(s):
    """Each subject's whole history of vitals, flattened."""
    return features.flatten_wide(s.vitalsign, "subject_id", C.ED_COLUMNS)


SUBJECT_VITALS_SQL = "select subject_id, " + ", ".join(
    f"min({c}) as {f}_min, max({c}) as {f}_max, avg({c}) as {f}_mean" for f, c in C.ED_COLUMNS.items()
) + " from vitalsign group by subject_id"


@query(
    "missing_indicator",
    sql=with_tables(
        "select subject_id, "
        + ", ".join(f"cast({f}_max is null as int) as {f}_missing" for f in C.VITALS)
        + " from vitals",
        vitals=SUBJECT_VITALS_SQL,
    ),
)
def missing_indicator(s):
    flagged = prepare.indicators(subject_vitals(s), C.VITALS)
    return flagged.select("subject_id", *[f"{f}_missing" for f in C.VITALS])


@query(
    "impute",
    sql=with_tables(
        "select subject_id, charttime, "
        + ", ".join(f"round(coalesce({c}, (select median({c}) from vitalsign)), 6) as {c}" for c in VITAL_COLUMNS)
        + " from vitalsign"
    ),
)
def impute(s):
    filled = prepare.impute(s.vitalsign, prepare.fit_medians(s.vitalsign, VITAL_COLUMNS))
    return filled.select("subject_id", "charttime", *rounded(*VITAL_COLUMNS))


@query(
    "standardize",
    sql="select l_orderkey, l_linenumber, "
    + ", ".join(
        f"round(({c} - (select avg({c}) from lineitem)) / ((select stddev_samp({c}) from lineitem) + 1e-8), 6) as {c}"
        for c in LINE_NUMBERS
    )
    + " from lineitem",
)
def standardize(s):
    lines = s.raw("lineitem").select("l_orderkey", "l_linenumber", *LINE_NUMBERS)
    scaled = prepare.standardize(lines, prepare.fit_stats(lines, LINE_NUMBERS))
    return scaled.select("l_orderkey", "l_linenumber", *rounded(*LINE_NUMBERS))


def vector_text(col, scale):
    """An array as text of rounded integers, comparable across engines."""
    cells = F.transform(col, lambda x: F.round(x.cast("double") * F.lit(float(scale))).cast("bigint").cast("string"))
    return F.array_join(cells, ",")


def vector_text_sql(expr, scale):
    return (
        f"array_to_string(list_transform({expr}, lambda x: "
        f"cast(cast(round(cast(x as double) * {float(scale)}) as bigint) as varchar)), ',')"
    )


@query(
    "feature_vector",
    sql=f"""select l_orderkey, cast(l_linenumber as float) as l_linenumber, cast(4 as int) as width,
       {vector_text_sql('[' + ', '.join(f'cast({c} as float)' for c in LINE_NUMBERS) + ']', 100)} as vector
from lineitem""",
)
def feature_vector(s):
    lines = s.raw("lineitem").select("l_orderkey", "l_linenumber", *LINE_NUMBERS)
    rows = prepare.assemble(lines, LINE_NUMBERS, "l_linenumber")
    return rows.select(
        "l_orderkey", "l_linenumber", F.size("features").alias("width"), vector_text("features", 100).alias("vector")
    )


@query(
    "sigmoid_score",
    sql=with_tables("select doc_id, round(1 / (1 + exp(-logit)), 6) as score from scored"),
)
def sigmoid_score(s):
    return s.scored.select("doc_id", F.round(values.sigmoid("logit"), 6).alias("score"))


@query("image_path", sql=with_tables(path_sql("cxr_meta")))
def image_path(s):
    return image_paths(s.cxr_meta)


@query(
    "ext_check",
    sql=with_tables(
        """select name, lower(regexp_extract(name, '([^./]*)$', 1)) as ext
from (select dicom_id || case ViewPosition when 'AP' then '.jpg' when 'PA' then '.DICOM'
                                           when 'LATERAL' then '.png' else '' end as name from cxr_meta)
where lower(regexp_extract(name, '([^./]*)$', 1)) in ('jpg', 'jpeg', 'dcm', 'dicom')"""
    ),
)
def ext_check(s):
    view = F.col("ViewPosition")
    ext = F.when(view == "AP", ".jpg").when(view == "PA", ".DICOM").when(view == "LATERAL", ".png").otherwise("")
    names = s.cxr_meta.select(F.concat("dicom_id", ext).alias("name"))
    return names.where(images.has_known_ext("name")).select("name", images.ext_of("name").alias("ext"))


@query(
    "pad_plan",
    sql=with_tables(
        """select event_id, (greatest(h, w) - w) // 2 as pad_left, (greatest(h, w) - w + 1) // 2 as pad_right,
       (greatest(h, w) - h) // 2 as pad_top, (greatest(h, w) - h + 1) // 2 as pad_bottom
from (select event_id, 200 + event_id % 300 as h, cast(200 + k * 3 as bigint) as w from ev)"""
    ),
)
def pad_plan(s):
    sized = s.ev.select(
        "event_id", (200 + F.col("event_id") % 300).alias("h"), (200 + F.col("k") * 3).cast("bigint").alias("w")
    )
    p = images.pad_plan("h", "w")
    return sized.select("event_id", *[p[side].alias(f"pad_{side}") for side in ("left", "right", "top", "bottom")])


@query("tag_rows", sql="select c_custkey, c_mktsegment, 'training' as purpose from customer")
def tag_rows(s):
    return s.raw("customer").select("c_custkey", "c_mktsegment").withColumn("purpose", F.lit("training"))


# --- filters ---


@query("filter_in", sql=with_tables("select * from cxr_meta where ViewPosition in ('AP', 'PA')"))
def filter_in(s):
    return s.cxr_meta.where(F.col("ViewPosition").isin(C.FRONTAL_VIEWS))


@query("filter_not_null", sql=with_tables("select * from labevents where valuenum is not null"))
def filter_not_null(s):
    return s.labevents.where(F.col("valuenum").isNotNull())


@query(
    "filter_time_window",
    sql="""select event_id, ts from events
where ts between timestamp '2024-01-05 00:00:00' and timestamp '2024-01-06 00:00:00'""",
)
def filter_time_window(s):
    low, high = (F.expr(f"timestamp_ntz'{d} 00:00:00'") for d in ("2024-01-05", "2024-01-06"))
    return s.raw("events").where(F.col("ts").between(low, high)).select("event_id", "ts")


@query("filter_rank", sql=with_tables("select subject_id, stay_id, intime from first_stay"))
def filter_rank(s):
    return ranking.first(s.icustays.drop("hadm_id"), "subject_id", ["intime", "stay_id"])


@query(
    "filter_point",
    sql=with_tables("select intime, subject_id from icustays where subject_id = 7"),
)
def filter_point(s):
    return s.icustays.where(F.col("subject_id") == 7).select("intime", "subject_id").orderBy("intime")


def missing_sql(cols, table):
    return " union all ".join(
        f"select '{c}' as \"column\", count(*) - count({c}) as missing from {table}" for c in cols
    )


@query(
    "filter_counted",
    sql=with_tables(
        f"select * from ({missing_sql(['subject_id', 'charttime', *VITAL_COLUMNS], 'vitalsign')}) where missing > 0"
    ),
)
def filter_counted(s):
    return quality.counted(quality.missing_counts(s.vitalsign))
