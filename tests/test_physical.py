"""What the plans look like: pushdown, pruning, joins, no single-task windows."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from anchorage import config as C
from anchorage.operators import lookback, metrics
from anchorage.plans import clinical
from anchorage.sources import sinks
from workload.standins import HOURS, StandIns

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    """Stand-ins written out, as a user would have them."""
    s = StandIns(spark, DATA)
    return {n: sinks.materialize(getattr(s, n)) for n in ("anchors", "labevents", "chartevents", "vitalsign")}


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_item_codes_times_and_columns_reach_the_scan(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    found = lookback.span(stored["anchors"], "subject_id", "icu_intime", HOURS)
    text = plan(clinical.lab_features(stored["anchors"], stored["labevents"], HOURS, found))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "itemid" in line)
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", scan)[1]
    assert "In(itemid" in pushed and "IsNotNull(valuenum)" in pushed
    assert "GreaterThanOrEqual(charttime" in pushed and "LessThanOrEqual(charttime" in pushed
    assert "BroadcastHashJoin" in text


def test_only_the_used_columns_are_read(spark):
    text = plan(entry.queries()["row_count"](spark, DATA))
    assert "ReadSchema: struct<>" in text
    text = plan(entry.queries()["split_dataset"](spark, DATA))
    assert "ReadSchema: struct<c_custkey:bigint>" in text


def test_many_anchors_are_joined_by_key_and_slot(stored, monkeypatch, no_broadcast):
    monkeypatch.setattr(lookback, "BROADCAST_ROWS", 0)
    found = lookback.span(stored["anchors"], "subject_id", "icu_intime", HOURS)
    text = plan(clinical.lab_features(stored["anchors"], stored["labevents"], HOURS, found))
    assert "Broadcast" not in text
    assert re.search(r"hashpartitioning\(subject_id#\d+L, _slot#\d+L", text)


def test_features_add_no_shuffle_after_their_aggregates(spark, stored, no_broadcast):
    stays = sinks.materialize(
        stored["anchors"].withColumns({"gender": F.lit("M"), "age": F.lit(1), C.LABEL: F.lit(0)})
    )
    t = C.Tables(None, None, None, stored["labevents"], stored["chartevents"], stored["vitalsign"], None, C.Lookback(HOURS))
    text = plan(clinical.features(t, stays))
    # three final aggregates and the cohort itself, all by stay
    assert len(re.findall(r"Exchange hashpartitioning\(stay_id#\d+L, \d+\)", text)) == 4


def test_curves_have_no_global_window(spark):
    df = spark.range(1000).select((F.col("id") / 7.0).alias("s"), (F.col("id") % 2).alias("y"))
    text = plan(metrics.curve(df, "s", "y"))
    single = [line for line in text.splitlines() if "SinglePartition" in line]
    # only the one-row-per-bucket table goes through a single task
    assert len(single) == 1
    assert re.search(r"Window \[sum\(pos#\d+L\) windowspecdefinition\(_ord_bucket", text)
