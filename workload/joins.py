"""Joins, windows, sorting, sets, splitting."""

from pyspark.sql import functions as F

from anchorage import config as C
from anchorage.functions import times
from anchorage.operators import learn, lookback, ranking, split
from anchorage.plans import clinical
from anchorage.sources import tables
from workload.basics import MANIFEST_SQL, split_case, vector_text, vector_text_sql
from workload.registry import query
from workload.standins import HOURS, with_tables


def timed_images(s):
    """All images with a numeric subject and a parsed time."""
    timed = s.cxr_meta.select(
        "subject_id", "study_id", "dicom_id", times.parse_study_time("StudyDate", "StudyTime").alias("cxr_time")
    )
    return tables.cast_key(timed, "subject_id", "long")


@query(
    "join_inner_chain",
    sql=with_tables(
        """select stay_id, subject_id, hadm_id, intime, admittime, hospital_expire_flag, gender, anchor_age
from icustays join admissions using (hadm_id, subject_id) join patients using (subject_id)"""
    ),
)
def join_inner_chain(s):
    return (
        s.icustays.join(s.admissions, ["hadm_id", "subject_id"])
        .join(s.patients, "subject_id")
        .select(
            "stay_id", "subject_id", "hadm_id", "intime", "admittime", "hospital_expire_flag", "gender", "anchor_age"
        )
    )


@query(
    "join_lookback",
    sql=with_tables(
        f"""select stay_id, itemid, charttime, valuenum
from first_stay f join labevents l on f.subject_id = l.subject_id
where charttime >= intime - interval {HOURS} hours and charttime <= intime"""
    ),
)
def join_lookback(s):
    near = lookback.join(s.first_stay, s.labevents, "subject_id", "intime", "charttime", HOURS)
    return near.select("stay_id", "itemid", "charttime", "valuenum")


@query(
    "join_symmetric_window",
    sql=with_tables(
        """select stay_id, intime, dicom_id, cxr_time from icustays s join images i on s.subject_id = i.subject_id
where cxr_time >= intime - interval 24 hours and cxr_time <= intime + interval 24 hours"""
    ),
)
def join_symmetric_window(s):
    near = lookback.join(s.icustays, timed_images(s), "subject_id", "intime", "cxr_time", 24, 24)
    return near.select("stay_id", "intime", "dicom_id", "cxr_time")


def nearest_sql(order):
    return with_tables(
        f"""select subject_id, stay_id, dicom_id, cxr_time, intime
from first_stay join images using (subject_id)
where cxr_time between intime - interval {HOURS} hours and intime
qualify row_number() over (partition by stay_id order by cxr_time {order}, dicom_id) = 1"""
    )


def nearest_image(s, pick):
    found = lookback.nearest(
        s.first_stay.select("subject_id", "stay_id", "intime"),
        timed_images(s).drop("study_id"),
        "subject_id",
        "intime",
        "cxr_time",
        HOURS,
        tie="dicom_id",
        pick=pick,
    )
    return found.select("subject_id", "stay_id", "dicom_id", "cxr_time", "intime")


@query("join_nearest_before", sql=nearest_sql("desc"))
def join_nearest_before(s):
    return nearest_image(s, "closest")


@query("join_farthest_before", sql=nearest_sql("asc"))
def join_farthest_before(s):
    return nearest_image(s, "farthest")


@query(
    "join_semi_window",
    sql=with_tables(
        """select distinct s.subject_id from icustays s join images i on s.subject_id = i.subject_id
where cxr_time >= intime - interval 24 hours and cxr_time <= intime"""
    ),
)
def join_semi_window(s):
    return lookback.exists(s.icustays, timed_images(s), "subject_id", "intime", "cxr_time", 24)


def flat_sql(table, key, mapping, suffix=""):
    """Per-stay min / max / mean of the lookback rows of a table; mapping = {feature: value expression}."""
    aggs = ", ".join(
        f"min({e}) as {f}_min{suffix}, max({e}) as {f}_max{suffix}, avg({e}) as {f}_mean{suffix}"
        for f, e in mapping.items()
    )
    return f"""select a.stay_id, {aggs} from anchors a join {table} t on t.{key} = a.{key}
where t.charttime between a.icu_intime - interval {HOURS} hours and a.icu_intime group by a.stay_id"""


def by_code(codes):
    return {f: f"case when itemid in ({', '.join(map(str, c))}) then valuenum end" for f, c in codes.items()}


ANCHORS_SQL = "select stay_id, subject_id, intime as icu_intime from first_stay"
FLAT_SQL = {
    "labs": flat_sql(
        "(select * from labevents where valuenum is not null and itemid in (50809, 50931, 50813, 50912))",
        "subject_id",
        by_code(C.LAB_CODES),
    ),
    "icu": flat_sql(
        "(select * from chartevents where valuenum is not null and itemid in (220045, 220181, 220210, 223761, 220277))",
        "stay_id",
        by_code(C.CHART_CODES),
        "_icu",
    ),
    "ed": flat_sql("vitalsign", "subject_id", C.ED_COLUMNS, "_ed"),
}


def merged_sql(feats=C.VITALS):
    return ", ".join(
        f"coalesce({f}_mean_ed, {f}_mean_icu) as {f}_mean, least({f}_min_ed, {f}_min_icu) as {f}_min, "
        f"greatest({f}_max_ed, {f}_max_icu) as {f}_max"
        for f in feats
    )


def rounded_sql(cols):
    return ", ".join(f"round({c}, 6) as {c}" for c in cols)


WIDE_SQL = f"""select a.*, labs.* exclude (stay_id), {merged_sql()}
from anchors a left join labs using (stay_id) left join icu using (stay_id) left join ed using (stay_id)"""


@query(
    "join_left_chain",
    sql=with_tables(
        f"select stay_id, {rounded_sql(C.MEASUREMENTS)} from wide", anchors=ANCHORS_SQL, **FLAT_SQL, wide=WIDE_SQL
    ),
)
def join_left_chain(s):
    stays = s.first_stay.select(
        "stay_id",
        "subject_id",
        F.col("intime").alias("icu_intime"),
        F.lit("M").alias("gender"),
        F.lit(0).alias("age"),
        F.lit(0).alias(C.LABEL),
    )
    wide = clinical.features(s.tables(), stays)
    return wide.select("stay_id", *[F.round(c, 6).alias(c) for c in C.MEASUREMENTS])


@query(
    "join_left_dedup_cols",
    sql=with_tables(
        """select s.*, a.* exclude (hadm_id, subject_id) from icustays s left join admissions a on a.hadm_id = s.hadm_id"""
    ),
)
def join_left_dedup_cols(s):
    return tables.left_join(s.icustays, s.admissions, "hadm_id")


@query(
    "join_cast_key",
    sql=with_tables(
        """select i.subject_id, dicom_id, gender from patients p join cxr_meta i
on cast(p.subject_id as varchar) = i.subject_id"""
    ),
)
def join_cast_key(s):
    numeric = tables.cast_key(s.cxr_meta.select("subject_id", "dicom_id"), "subject_id", "long")
    joined = numeric.join(s.patients.select("subject_id", "gender"), "subject_id")
    return tables.cast_key(joined, "subject_id", "string")


# --- windows ---


@query(
    "number_stays",
    sql=with_tables(
        """select subject_id, stay_id, intime,
       row_number() over (partition by subject_id order by intime, stay_id) as stay_number from icustays"""
    ),
)
def number_stays(s):
    return ranking.number(s.icustays.drop("hadm_id"), "subject_id", ["intime", "stay_id"])


@query("first_per_key", sql=with_tables("select * from first_stay"))
def first_per_key(s):
    return ranking.first(s.icustays, "subject_id", ["intime", "stay_id"])


@query(
    "rank_by_gap",
    sql=with_tables(
        f"""select stay_id, dicom_id, abs(date_diff('second', intime, cxr_time)) as gap_seconds,
       row_number() over (partition by stay_id order by abs(date_diff('second', intime, cxr_time)), dicom_id) as gap_rank
from first_stay join images using (subject_id)
where cxr_time between intime - interval {HOURS} hours and intime"""
    ),
)
def rank_by_gap(s):
    pairs = lookback.join(s.first_stay, timed_images(s), "subject_id", "intime", "cxr_time", HOURS)
    ranked = lookback.rank(pairs.select("stay_id", "dicom_id", "intime", "cxr_time"), "stay_id", "intime", "cxr_time", "dicom_id")
    return ranked.select("stay_id", "dicom_id", "gap_seconds", "gap_rank")


# --- sort, limit, sets ---


@query("sort_rows", sql=with_tables("select intime, subject_id, stay_id from icustays"))
def sort_rows(s):
    return s.icustays.select("intime", "subject_id", "stay_id").orderBy("intime", "stay_id")


@query(
    "top_k",
    sql="""select l_orderkey, l_linenumber, l_extendedprice from (
  select *, row_number() over (order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_suppkey) as n from lineitem)
where n between 2 and 10""",
)
def top_k(s):
    # one sortable tie-break built from the whole key
    lines = s.raw("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("tie"),
    )
    return ranking.top_k(lines, "l_extendedprice", 9, skip=1, tie="tie").drop("tie")


@query("peek", sql="select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 10")
def peek(s):
    return ranking.peek(s.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"], 10)


@query(
    "union_by_name",
    sql=with_tables(
        """select subject_id, gender, anchor_age, anchor_year, null::bigint as hadm_id, 'people' as purpose from patients
union all by name select subject_id, hadm_id, 'stays' as purpose from icustays
union all by name select hadm_id, subject_id, 'admissions' as purpose from admissions"""
    ),
)
def union_by_name(s):
    people = s.patients.withColumn("purpose", F.lit("people"))
    stays = s.icustays.select("subject_id", "hadm_id").withColumn("purpose", F.lit("stays"))
    admitted = s.admissions.select("hadm_id", "subject_id").withColumn("purpose", F.lit("admissions"))
    return people.unionByName(stays, allowMissingColumns=True).unionByName(admitted, allowMissingColumns=True)


# --- splitting ---


@query("split_dataset", sql=f"select c_custkey, {split_case('c_custkey')} as split from customer")
def split_dataset(s):
    return split.by_hash(s.raw("customer").select("c_custkey"), "c_custkey", C.SPLIT_FRACTIONS, C.SPLIT_SEED)


@query(
    "split_exact",
    sql="""with keys as (select o_custkey, min(o_orderpriority) as stratum from orders group by o_custkey),
placed as (
    select o_custkey, count(*) over (partition by stratum) as n,
        row_number() over (partition by stratum order by ('0x' || substr(md5(concat('42|', o_custkey::varchar)), 1, 15))::bigint, o_custkey) as place
    from keys
)
select o_orderkey, o_custkey, case when place <= floor(n * 0.8 + 0.5) then 'train' when place <= floor(n * 0.98 + 0.5) then 'val' else 'test' end as split
from orders join placed using (o_custkey)""",
)
def split_exact(s):
    """Customers in splits of exact size within each stratum; all orders of one stay together."""
    orders = s.raw("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return split.exact(orders, "o_custkey", C.SPLIT_FRACTIONS, C.SPLIT_SEED, by="o_orderpriority").drop("o_orderpriority")


@query(
    "subsample",
    sql="""select o_orderkey, o_totalprice from orders
where ('0x' || substr(md5(concat('7|', o_orderkey::varchar)), 1, 8))::bigint % 10000 < 2500""",
)
def subsample(s):
    return split.sample(s.raw("orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 0.25, seed=7)


@query(
    "shuffle_rows",
    sql="""select o_orderkey, o_custkey, ('0x' || substr(md5(concat('42|', o_orderkey::varchar)), 1, 15))::bigint as shuffle_key
from orders""",
)
def shuffle_rows(s):
    return split.shuffle(s.raw("orders").select("o_orderkey", "o_custkey"), "o_orderkey")


@query(
    "split_features_label",
    sql=with_tables("select hadm_id, subject_id, admittime from admissions"),
)
def split_features_label(s):
    x, _ = split.features_label(s.admissions, "hospital_expire_flag")
    return x


@query(
    "fuse_vectors",
    sql=f"""select a.vec_id, cast(len(list_concat(a.embedding, b.embedding)) as int) as width,
       {vector_text_sql('list_concat(a.embedding, b.embedding)', 10000)} as fused
from embeddings a join embeddings b on a.vec_id = b.vec_id""",
)
def fuse_vectors(s):
    vectors = s.raw("embeddings")
    fused = learn.fuse(
        vectors.select("vec_id", F.col("embedding").alias("a")),
        vectors.select("vec_id", F.col("embedding").alias("b")),
        "vec_id",
    )
    return fused.select("vec_id", F.size("fused").alias("width"), vector_text("fused", 10000).alias("fused"))


# --- composed plans up to the dataset ---


@query("images_manifest", sql=with_tables(MANIFEST_SQL.strip()))
def images_manifest(s):
    return clinical.images_manifest(s.tables())


@query(
    "images_manifest_farthest",
    sql=with_tables(MANIFEST_SQL.replace("i.cxr_time desc", "i.cxr_time asc").strip()),
)
def images_manifest_farthest(s):
    return clinical.images_manifest(s.tables("farthest"))


COHORT_SQL = """
select m.subject_id, m.stay_id, m.dicom_id, m.study_id, s.hadm_id, s.intime as icu_intime, p.gender,
       cast(anchor_age + year(admittime) - anchor_year as bigint) as age, a.hospital_expire_flag
from manifest m join icustays s on s.stay_id = m.stay_id join admissions a on a.hadm_id = s.hadm_id
join patients p on p.subject_id = s.subject_id"""


@query("cohort", sql=with_tables(COHORT_SQL, manifest=MANIFEST_SQL))
def cohort(s):
    return clinical.cohort(s.tables())
