"""Statistics merged from parts, splits of exact size, and rejected input."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from anchorage.operators import moments, prepare, split
from anchorage.sources import tables

COLS = ["a", "b", "c d"]


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(8)
    # a far offset, at which sums of squares would cancel; nulls in different rows
    rows = [(1e9 + rng.gauss(0, 1), rng.gauss(0, 3) if i % 5 else None, float(i % 7) if i % 11 else None) for i in range(3000)]
    return rows, spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, a double, b double, `c d` double")


def by_force(rows, i, j):
    pairs = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
    x, y = (np.array(v, dtype=np.longdouble) for v in zip(*pairs))
    return len(pairs), x.mean(), y.mean(), ((x - x.mean()) ** 2).sum(), ((x - x.mean()) * (y - y.mean())).sum()


def close(a, b):
    return math.isclose(float(a), float(b), rel_tol=1e-12, abs_tol=1e-9)


def test_a_fit_of_parts_is_the_fit_of_the_whole(spark, numbers, tmp_path):
    rows, df = numbers
    sizes = [df.id < 10, (df.id >= 10) & (df.id < 2000), df.id >= 2000, df.id < 0]  # uneven and empty parts
    states = [moments.state(df.where(s), COLS, pairs=True) for s in sizes]
    stored = [moments.read(spark, moments.write(s, str(tmp_path / str(k)))) for k, s in enumerate(states)]
    merged = moments.merge(moments.merge(stored[2], stored[3]), stored[0], stored[1])
    found = {(r.a, r.b): r for r in merged.collect()}
    assert len(found) == 6
    for (a, b), r in found.items():
        n, x, y, xx, xy = by_force(rows, COLS.index(a), COLS.index(b))
        assert r.n == n and close(r.x, x) and close(r.y, y)
        assert math.isclose(r.xx, xx, rel_tol=1e-6) and math.isclose(r.xy, xy, rel_tol=1e-6, abs_tol=1e-3)  # no double near 1e9 is finer than 1e-7
        if a != "a":
            assert close(r.xx, xx) and math.isclose(r.xy, xy, rel_tol=1e-12, abs_tol=1e-9)
    whole, parts = prepare.fit_stats(df, COLS).first(), moments.stats(merged, COLS).first()
    for c in COLS:
        assert close(whole["mean"][c], parts["mean"][c])
        assert math.isclose(whole["std"][c], parts["std"][c], rel_tol=1e-6 if c == "a" else 1e-12)
    r = {(x.a, x.b): x.r for x in moments.corr(merged).collect()}
    assert math.isclose(r["b", "c d"], df.select(F.corr("b", F.col("`c d`"))).first()[0], rel_tol=1e-9)


def test_states_without_values(frame):
    df = frame("a double, b double", (1.0, None), (1.0, None))
    merged = moments.merge(moments.state(df, ["a", "b"], pairs=True), moments.state(df.limit(0), ["a", "b"], pairs=True))
    found = {(r.a, r.b): (r.n, r.x, r.xx) for r in merged.collect()}
    assert found == {("a", "a"): (2, 1, 0), ("b", "b"): (0, None, None), ("a", "b"): (0, None, None)}
    assert moments.corr(merged).first().r is None
    row = moments.stats(merged, ["a", "b"]).first()
    assert tuple(row["mean"]) == (1.0, None) and tuple(row["std"]) == (0.0, None)


# --- exact splits


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100, 1003])
@pytest.mark.parametrize("cells", [1, 64])
def test_sizes_are_exact(spark, n, cells):
    fractions = {"train": 0.8, "val": 0.18, "test": 0.02}
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 3).alias("label"))
    got = Counter(r.split for r in split.exact(df, "k", fractions, cells=cells).collect())
    cut = [math.floor(n * f + 0.5) for f in (0.8, 0.98)]
    assert [got[s] for s in fractions] == [cut[0], cut[1] - cut[0], n - cut[1]]
    if n > 100:
        by = Counter((r.label, r.split) for r in split.exact(df, "k", fractions, by="label", cells=cells).collect())
        for label in range(3):
            m = len(range(label, n, 3))
            cut = [math.floor(m * f + 0.5) for f in (0.8, 0.98)]
            assert [by[label, s] for s in fractions] == [cut[0], cut[1] - cut[0], m - cut[1]]


def test_exact_splits_keep_keys_together_and_do_not_hang_on_the_layout(spark):
    rows = [(k % 50 if k % 50 else None, k % 2, f"row {k}", "old") for k in range(500)] * 2
    df = spark.createDataFrame(rows, "k long, label long, v string, split string")
    fractions = {"a": 0.5, "b": 0.5}
    one = sorted(map(tuple, split.exact(df.repartition(3), "k", fractions, by="label").collect()), key=repr)
    two = sorted(map(tuple, split.exact(df.repartition(11), "k", fractions, by="label", cells=7).collect()), key=repr)
    assert one == two and len(one) == len(rows)
    of = {}
    for k, _, _, s in one:
        of.setdefault(k, set()).add(s)
    assert len(of) == 50 and all(len(s) == 1 for s in of.values())
    assert Counter(min(s) for s in of.values()) == {"a": 26, "b": 24}  # 13 of 25 in each stratum
    other = split.exact(df, "k", fractions, seed=1, by="label").collect()
    assert sorted(map(tuple, other), key=repr) != one
    with pytest.raises(ValueError, match="sum to 1"):
        split.exact(df, "k", {"a": 0.5})


# --- rejects


def test_bad_lines_are_kept_as_they_are(spark, tmp_path):
    lines = ["id,name,score", "1,a,1.5", 'x,b,2', "2,c", '3,"d, e",', "4,f,5,6", ",,", "5,g,no", '6,"h q",1e3']
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    good, bad = tables.read_csv_rejects(spark, str(tmp_path), "id long, name string, score double")
    assert sorted(map(tuple, good.collect()), key=repr) == sorted([(1, "a", 1.5), (3, "d, e", None), (None, None, None), (6, "h q", 1000.0)], key=repr)
    assert {r.line for r in bad.collect()} == {"x,b,2", "2,c", "4,f,5,6", "5,g,no"}
    assert all(r.file.endswith("a.csv") for r in bad.collect())
    assert good.count() + bad.count() == len(lines) - 1


def test_bad_keys_are_kept(frame):
    df = frame("k string, v int", ("1", 1), ("007", 2), ("x", 3), (None, 4), ("", 5), ("9" * 30, 6))
    good, bad = tables.cast_key_rejects(df, "k", "bigint")
    assert sorted(map(tuple, good.collect()), key=repr) == sorted([(1, 1), (7, 2), (None, 4)], key=repr)
    assert {r.v for r in bad.collect()} == {3, 5, 6} and dict(bad.dtypes)["k"] == "string"
