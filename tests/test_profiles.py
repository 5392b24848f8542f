"""Stored column profiles: parts against the whole, and against plain counts."""

import pytest
from pyspark.sql import functions as F

from anchorage.operators import profiles
from anchorage.sources import tables


@pytest.fixture
def table(spark):
    return spark.range(60_000).select(
        F.col("id"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("v"), F.col("id") % 7)).alias("odd name"),
        (F.col("id") % 9_973 / 3).alias("x"),
        F.lit(None).cast("string").alias("nothing"),
    )


def test_parts_make_the_whole_within_the_stated_error(table):
    parts = [profiles.state(table.where(F.col("id") % 3 == k)) for k in range(3)]
    got = {r["column"]: r for r in profiles.report(profiles.merge(*parts)).collect()}
    assert [got[c]["position"] for c in table.columns] == [0, 1, 2, 3]
    assert {c: (r["type"], r["rows"], r["nulls"]) for c, r in got.items()} == {
        "id": ("bigint", 60_000, 0),
        "odd name": ("string", 60_000, 8_572),
        "x": ("double", 60_000, 0),
        "nothing": ("string", 60_000, 60_000),
    }
    assert got["odd name"]["distinct"] == 6 and got["nothing"]["distinct"] == 0
    # three standard errors
    assert got["id"]["distinct"] == pytest.approx(60_000, rel=0.05)
    assert got["x"]["distinct"] == pytest.approx(9_973, rel=0.05)


def test_frequent_values_of_merged_parts(table):
    parts = [profiles.state(table.where(F.col("id") % 2 == k), ["odd name", "nothing"]) for k in range(2)]
    got = [tuple(r) for r in profiles.frequent(profiles.merge(*parts), 6).collect()]
    want = [("odd name", f"v{k}", sum(1 for i in range(60_000) if i % 7 == k)) for k in range(1, 7)]
    assert sorted(got) == want


def test_a_merged_state_survives_storage_and_an_empty_part(spark, table, tmp_path):
    old = profiles.state(table.where("id < 500"), ["odd name"])
    old.write.parquet(str(tmp_path / "old"))
    new = profiles.merge(spark.read.parquet(str(tmp_path / "old")), profiles.state(table.where("id < 0"), ["odd name"]))
    row = profiles.report(new).first()
    assert (row["rows"], row["nulls"], row["distinct"]) == (500, 72, 6)
    assert profiles.frequent(new, 1).count() == 1


def test_listing_of_tables(spark):
    spark.range(3).createOrReplaceTempView("listed_here")
    try:
        assert "listed_here" in [r["name"] for r in tables.list_tables(spark).collect()]
    finally:
        spark.catalog.dropTempView("listed_here")
