"""Files as tables, runs that survive a lost driver, and datasets published together."""

import hashlib
import os
import signal
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from anchorage.operators import manifest
from anchorage.sources import files, runs, sinks, stores

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def tree(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names)


# --- files


def test_files_round_trip_and_listing(spark, tmp_path):
    rows = [(f"p{k % 4}/s{k}/{k}.jpg", b"x" * k) for k in range(40)] + [("top.jpg", b"1"), ("p1/_hidden.jpg", b"1"), ("p1/é x.txt", b"")]
    root = files.write_files(spark.createDataFrame(rows, "path string, content binary"), f"file:{tmp_path}")
    assert tree(tmp_path) == sorted(p for p, _ in rows)
    found = {(r.shard, r.path, r.length) for r in files.listing(spark, root).collect()}
    assert found == {(p.split("/")[0] if "/" in p else "", p, len(c)) for p, c in rows if "_" not in p}
    jpgs = files.listing(spark, root, "*.jpg", shards=["p1", "p2", "no such shard"])
    assert {r.path for r in jpgs.collect()} == {p for p, _ in rows if p.startswith(("p1", "p2")) and p.endswith("jpg") and "_" not in p}
    plan = jpgs._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "FileScan" not in plan  # no file index on the driver
    assert jpgs.rdd.getNumPartitions() == 3


def test_hashes_by_ranges_are_those_of_a_plain_loop(spark, tmp_path):
    sizes = {"a/empty": 0, "a/one": 1, "a/even": 3000, "b/odd": 3001, "b/big": 70_001, "top": 999}
    want = set()
    for name, n in sizes.items():
        data = bytes(k * 7 % 251 for k in range(n))
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
        parts = [hashlib.sha256(data[k : k + 1000]).hexdigest() for k in range(0, max(n, 1), 1000)]
        want.add((name, n, len(parts), hashlib.sha256("".join(parts).encode()).hexdigest()))
    assert {tuple(r) for r in files.hashes(spark, str(tmp_path), size=1000).collect()} == want
    whole = manifest.file_hashes(spark, str(tmp_path)).where("path = 'b/big'").first()
    data = (tmp_path / "b/big").read_bytes()
    assert whole.ranges == 1 and whole.sha256 == hashlib.sha256(hashlib.sha256(data).hexdigest().encode()).hexdigest()


def test_hashes_tell_changed_swapped_and_moved_ranges(spark, tmp_path):
    def printed(**contents):
        for name, body in contents.items():
            (tmp_path / name).write_bytes(body)
        found = manifest.build(spark, {}, revision="r", ref="m", folders={"d": str(tmp_path)}, size=4)
        return found.where("key = 'dataset.d_files'").first()["value"]

    a = printed(x=b"aaaabbbb", y=b"cccc")
    assert a == printed() and len({a, printed(x=b"bbbbaaaa"), printed(x=b"aaaabbb", y=b"bcccc"), printed(x=b"aaaabbbb", y=b"cccd")}) == 4


def test_no_files(spark, tmp_path):
    assert files.listing(spark, str(tmp_path)).collect() == []
    assert files.hashes(spark, str(tmp_path)).collect() == []


# --- runs

KILLED = """
    import os, signal, sys
    from anchorage import session
    from anchorage.sources import runs
    spark = session.builder("killed").master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
    with runs.Run(spark, "night", {"seed": 1}, root=sys.argv[1]) as run:
        run.step("first", lambda: spark.range(10).selectExpr("id", "id % 3 as v"))
        def second():
            open(os.path.join(run.folder, "data", "second-cut-off"), "w").close()
            os.kill(os.getpid(), signal.SIGKILL)
        run.step("second", second)
"""


def test_a_run_goes_on_after_its_driver_was_killed(spark, tmp_path):
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(KILLED), str(tmp_path)], cwd=ROOT, capture_output=True, timeout=120)
    assert done.returncode == -signal.SIGKILL, done.stderr.decode()[-2000:]
    left = tree(tmp_path)
    assert any("second-cut-off" in f for f in left) and any(f.endswith("first.json") for f in left)

    def never():
        raise AssertionError("this step was finished")

    with runs.Run(spark, "night", {"seed": 2}, root=str(tmp_path)) as other:  # another signature is another run
        assert other.step("first", lambda: spark.range(3)).count() == 3 and other.made == ["first"]
    with runs.Run(spark, "night", {"seed": 1}, root=str(tmp_path)) as run:
        assert not any("second-cut-off" in f for f in tree(tmp_path))
        first = run.step("first", never)
        assert sorted(map(tuple, first.collect())) == [(i, i % 3) for i in range(10)]
        second = run.step("second", lambda: first.groupBy("v").count())
        assert {tuple(r) for r in second.collect()} == {(0, 4), (1, 3), (2, 3)}
        assert (run.reused, run.made) == (["first"], ["second"]) and set(run.finished()) == {"first", "second"}
    assert tree(tmp_path) == [] and os.listdir(tmp_path) == []


def test_a_failing_step_leaves_the_finished_ones(spark, tmp_path):
    with pytest.raises(ZeroDivisionError):
        with runs.Run(spark, "r", root=str(tmp_path)) as run:
            run.step("a", lambda: spark.range(2))
            run.step("b", lambda: 1 / 0)
    with runs.Run(spark, "r", root=str(tmp_path), keep=True) as again:
        assert set(again.finished()) == {"a"}
        assert again.step("a", lambda: 1 / 0).count() == 2
        assert again.step("none", lambda: spark.range(0)).dtypes == [("id", "bigint")]
    with runs.Run(spark, "r", root=str(tmp_path)) as last:
        assert last.step("none", lambda: 1 / 0).count() == 0
    assert os.listdir(tmp_path) == []


def test_materialized_folders_go_with_the_driver(tmp_path):
    script = f"""
    from anchorage import session
    from anchorage.sources import sinks
    spark = session.builder("short").master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "{tmp_path}").getOrCreate()
    assert sinks.materialize(spark.range(5)).count() == 5
    import glob
    assert len(glob.glob("{tmp_path}/anchorage-*")) == 1
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], cwd=ROOT, capture_output=True, timeout=120)
    assert done.returncode == 0, done.stderr.decode()[-2000:]
    for _ in range(100):  # the JVM ends a little later
        if not list(tmp_path.glob("anchorage-*")):
            break
        signal.sigtimedwait([], 0.1)
    assert not list(tmp_path.glob("anchorage-*"))


# --- published sets


def numbers(spark, root):
    return {k: sorted(r.id for r in df.collect()) for k, df in sinks.published(spark, root).items()}


def test_a_failing_writer_leaves_the_old_set(spark, tmp_path):
    root = str(tmp_path / "set")
    with pytest.raises(FileNotFoundError):
        sinks.published(spark, root)
    sinks.publish({"train": spark.range(3), "val": spark.range(1)}, root)
    assert numbers(spark, root) == {"train": [0, 1, 2], "val": [0]}
    before = sinks.published(spark, root)
    bad = spark.range(2).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish({"train": spark.range(9), "val": bad}, root)
    assert numbers(spark, root) == {"train": [0, 1, 2], "val": [0]}  # not the new train with the old val
    sinks.publish({"train": spark.range(4), "val": spark.range(2)}, root)
    assert numbers(spark, root) == {"train": [0, 1, 2, 3], "val": [0, 1]}
    assert before["train"].count() == 3  # one who still reads the version before
    assert len(stores.children(spark, root, folders=True)) == 2  # what the failed writer staged is gone
    sinks.publish({"test": spark.range(1)}, root, keep=1)
    assert numbers(spark, root) == {"test": [0]} and len(stores.children(spark, root, folders=True)) == 1


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_published_splits(spark, frame, tmp_path, fmt):
    df = frame("id long, name string, split string", (1, 'a "q", b', "train"), (2, None, "val"), (3, "c", "train"))
    sinks.publish_splits(df, str(tmp_path), ["train", "val", "test"], fmt)
    found = sinks.published(spark, str(tmp_path))
    assert sorted(map(tuple, found["train"].collect())) == [(1, 'a "q", b'), (3, "c")]
    assert found["val"].collect()[0].id == 2 and found["test"].collect() == [] and found["test"].columns == ["id", "name"]


def test_small_files_are_put_at_once(spark, tmp_path):
    path = str(tmp_path / "deep" / "marker")
    assert stores.read_text(spark, path) is None and not stores.exists(spark, path)
    for text in ("one", "zwei é"):
        stores.put_text(spark, path, text)
        assert stores.read_text(spark, path) == text
    assert [f for f in tree(tmp_path) if not f.endswith(".crc")] == ["deep/marker"]
