"""Clinical-shaped tables derived from ``events`` and ``customer``.

The clinical tables are licensed and not here, so the same shapes are derived
from the given tables: signups are stays, views are images, clicks, errors and
purchases are measurements. ``StandIns`` builds them with the DataFrame API and
``with_tables`` states them in SQL.
"""

from functools import cached_property

from pyspark.sql import functions as F

from anchorage import config as C
from anchorage.functions import times
from anchorage.operators import ranking

HOURS = 72


class StandIns:
    """The stand-in tables over one data folder, as lazy DataFrames."""

    def __init__(self, spark, sf_dir):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def raw(self, name):
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def ev(self):
        k = F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k")
        return self.raw("events").select("event_id", "ts", "user_id", "event_type", "value", k)

    def of(self, *kinds):
        return self.ev.where(F.col("event_type").isin(*kinds))

    @cached_property
    def icustays(self):
        return self.of("signup").select(
            F.col("user_id").alias("subject_id"),
            F.col("event_id").alias("stay_id"),
            (F.col("event_id") + 1000000).alias("hadm_id"),
            F.col("ts").alias("intime"),
        )

    @cached_property
    def admissions(self):
        return self.icustays.select(
            "hadm_id",
            "subject_id",
            (F.col("intime") - times.hours(5)).alias("admittime"),
            F.when(F.col("subject_id") % 3 == 0, 1).otherwise(0).alias("hospital_expire_flag"),
        )

    @cached_property
    def patients(self):
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("subject_id"),
            F.when(F.col("c_nationkey") % 2 == 0, "M").otherwise("F").alias("gender"),
            (18 + key % 70).cast("int").alias("anchor_age"),
            (2019 + key % 5).cast("int").alias("anchor_year"),
        )

    @cached_property
    def cxr_meta(self):
        text = F.col("ts").cast("string")
        view = F.col("k") % 4
        clock = F.regexp_replace(F.substring(text, 12, 8), ":", "").cast("int").cast("string")
        return self.of("view").select(
            F.col("user_id").cast("string").alias("subject_id"),
            F.concat(F.lit("d"), F.col("event_id").cast("string")).alias("dicom_id"),
            (F.col("user_id") * 100 + F.col("k") % 3).alias("study_id"),
            F.regexp_replace(F.substring(text, 1, 10), "-", "").alias("StudyDate"),
            F.concat(clock, F.lit(".875")).alias("StudyTime"),
            F.when(view == 0, "AP")
            .when(view == 1, "PA")
            .when(view == 2, "LATERAL")
            .otherwise("LL")
            .alias("ViewPosition"),
        )

    @cached_property
    def labevents(self):
        click = F.col("event_type") == "click"
        item = (
            F.when(click & (F.col("k") % 2 == 0), 50809)
            .when(click, 50931)
            .when(F.col("event_type") == "purchase", 50813)
            .otherwise(50912)
        )
        return self.of("click", "purchase", "error").select(
            F.col("user_id").alias("subject_id"),
            item.alias("itemid"),
            F.col("ts").alias("charttime"),
            F.when(F.col("k") % 10 != 0, F.col("value")).alias("valuenum"),
        )

    @cached_property
    def first_stay(self):
        return ranking.first(self.icustays, "subject_id", ["intime", "stay_id"])

    @cached_property
    def chartevents(self):
        code = F.col("k") % 6
        item = (
            F.when(code == 0, 220045)
            .when(code == 1, 220181)
            .when(code == 2, 220210)
            .when(code == 3, 223761)
            .when(code == 4, 220277)
            .otherwise(999999)
        )
        stays = self.first_stay.select(F.col("subject_id").alias("user_id"), "stay_id")
        return (
            self.of("error", "click")
            .join(stays, "user_id")
            .select(
                "stay_id",
                item.alias("itemid"),
                F.col("ts").alias("charttime"),
                F.col("value").alias("valuenum"),
            )
        )

    @cached_property
    def vitalsign(self):
        v, k = F.col("value"), F.col("k")
        return self.of("purchase", "view").select(
            F.col("user_id").alias("subject_id"),
            F.col("ts").alias("charttime"),
            v.alias("heartrate"),
            F.when(k % 3 != 0, v * 1.5).alias("sbp"),
            F.when(k % 4 != 0, v / 4.0).alias("resprate"),
            F.when(k % 5 != 0, 96.0 + k / 20.0).alias("temperature"),
            F.when(k % 2 != 0, 90.0 + k / 10.0).alias("o2sat"),
        )

    @cached_property
    def scored(self):
        """Labelled documents with a score and a logit."""
        return (
            self.raw("labels")
            .join(self.raw("documents").select("doc_id", "lang", "n_chars"), "doc_id")
            .select(
                "doc_id",
                "lang",
                "quality",
                "toxic",
                "n_chars",
                ((F.col("n_chars") - 2000) / 1000.0).alias("logit"),
            )
        )

    @cached_property
    def anchors(self):
        """First stays in the shape the feature plans expect."""
        return self.first_stay.select("stay_id", "subject_id", F.col("intime").alias("icu_intime"))

    def tables(self, pick="closest"):
        return C.Tables(
            self.icustays,
            self.admissions,
            self.patients,
            self.labevents,
            self.chartevents,
            self.vitalsign,
            self.cxr_meta,
            C.Lookback(HOURS, pick),
        )


STAND_IN_SQL = {
    "ev": """
select event_id, ts, user_id, event_type, value,
       cast(regexp_extract(props, '([0-9]+)', 1) as int) as k
from events""",
    "icustays": """
select user_id as subject_id, event_id as stay_id, event_id + 1000000 as hadm_id, ts as intime
from ev where event_type = 'signup'""",
    "admissions": """
select hadm_id, subject_id, intime - interval 5 hours as admittime,
       case when subject_id % 3 = 0 then 1 else 0 end as hospital_expire_flag
from icustays""",
    "patients": """
select c_custkey as subject_id, case when c_nationkey % 2 = 0 then 'M' else 'F' end as gender,
       cast(18 + c_custkey % 70 as int) as anchor_age,
       cast(2019 + c_custkey % 5 as int) as anchor_year
from customer""",
    "cxr_meta": """
select cast(user_id as varchar) as subject_id, concat('d', cast(event_id as varchar)) as dicom_id,
       user_id * 100 + k % 3 as study_id,
       replace(substr(cast(ts as varchar), 1, 10), '-', '') as StudyDate,
       concat(cast(cast(replace(substr(cast(ts as varchar), 12, 8), ':', '') as int) as varchar), '.875') as StudyTime,
       case k % 4 when 0 then 'AP' when 1 then 'PA' when 2 then 'LATERAL' else 'LL' end as ViewPosition
from ev where event_type = 'view'""",
    "labevents": """
select user_id as subject_id,
       case when event_type = 'click' and k % 2 = 0 then 50809 when event_type = 'click' then 50931
            when event_type = 'purchase' then 50813 else 50912 end as itemid,
       ts as charttime, case when k % 10 = 0 then null else value end as valuenum
from ev where event_type in ('click', 'purchase', 'error')""",
    "first_stay": """
select subject_id, stay_id, hadm_id, intime from icustays
qualify row_number() over (partition by subject_id order by intime, stay_id) = 1""",
    "chartevents": """
select f.stay_id,
       case e.k % 6 when 0 then 220045 when 1 then 220181 when 2 then 220210 when 3 then 223761
                    when 4 then 220277 else 999999 end as itemid,
       e.ts as charttime, e.value as valuenum
from ev e join first_stay f on f.subject_id = e.user_id where e.event_type in ('error', 'click')""",
    "vitalsign": """
select user_id as subject_id, ts as charttime, value as heartrate,
       case when k % 3 = 0 then null else value * 1.5e0 end as sbp,
       case when k % 4 = 0 then null else value / 4e0 end as resprate,
       case when k % 5 = 0 then null else 96e0 + k / 20e0 end as temperature,
       case when k % 2 = 0 then null else 90e0 + k / 10e0 end as o2sat
from ev where event_type in ('purchase', 'view')""",
    "images": """
select cast(subject_id as bigint) as subject_id, study_id, dicom_id, ViewPosition,
       strptime(StudyDate || ' ' || lpad(split_part(StudyTime, '.', 1), 6, '0'), '%Y%m%d %H%M%S') as cxr_time
from cxr_meta""",
    "scored": """
select doc_id, lang, quality, toxic, n_chars, (n_chars - 2000) / 1000e0 as logit
from labels join documents using (doc_id)""",
}


def with_tables(body, **more):
    """Prefix a query with the stand-ins and further named steps."""
    steps = {**STAND_IN_SQL, **more}
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in steps.items()) + "\n" + body
