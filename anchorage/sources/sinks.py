"""Writers, the fit-statistics artefact, and materialisation between plan steps."""

import json
import tempfile
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from anchorage.sources import stores

_LOCAL = {}


def scratch_root(spark):
    """The folder for intermediates that every executor can reach.

    It is ``spark.checkpoint.dir`` or else the context's checkpoint folder; only a local
    session without either may use the machine's own temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="anchorage-")
            stores.delete_at_exit(spark, _LOCAL[app])
        root = _LOCAL[app]
    return root.rstrip("/")


def scratch(spark):
    """A fresh folder name under ``scratch_root``."""
    return f"{scratch_root(spark)}/anchorage-{uuid.uuid4().hex}"


def write(df, path, fmt="parquet", mode="overwrite"):
    """Write a dataset; CSV gets a header and quoted text."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"')
    writer.format(fmt).save(path)
    return path


def materialize(df):
    """Write once, read back: later steps neither recompute nor guess the size.

    Unlike a cached frame the files survive lost executors, and unlike a long
    lineage they give the planner a true size to choose join strategies by. The folder
    goes when the driver ends; ``runs.Run`` keeps steps beyond it, and removes them earlier.
    """
    spark = df.sparkSession
    path = write(df, scratch(spark))
    stores.delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def write_splits(df, root, fmt="parquet", split="split", mode="overwrite"):
    """One dataset per split, in ``root/split=<name>``; no index column."""
    writer = df.write.mode(mode).partitionBy(split)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(root)
    return root


def publish(datasets, root, fmt="parquet", keep=2):
    """Write several datasets that readers see all at once, or not at all.

    ``datasets`` = {name: DataFrame}. All of them are staged in a fresh version folder; one
    small marker then names the version. Until it is put there, and if any writer fails,
    readers see the version before. The last ``keep`` versions stay for those who still
    read; older ones, and what failed writers have staged before them, are removed. One
    publisher at a time. Returns the version's folder.
    """
    spark = next(iter(datasets.values())).sparkSession
    before = stores.read_text(spark, f"{root}/{MARKER}")
    number = (json.loads(before)["number"] if before else 0) + 1
    name = f"version-{number:08d}-{uuid.uuid4().hex}"
    for k, df in datasets.items():
        write(df, f"{root}/{name}/{k}", fmt)
    body = {"number": number, "version": name, "format": fmt, "datasets": {k: df.schema.jsonValue() for k, df in datasets.items()}}
    stores.put_text(spark, f"{root}/{MARKER}", json.dumps(body))
    for old in stores.children(spark, root, folders=True):
        if old.startswith("version-") and int(old.split("-")[1]) <= number - keep or old.startswith(f"version-{number:08d}-") and old != name:
            stores.delete(spark, f"{root}/{old}")
    return f"{root}/{name}"


MARKER = "CURRENT.json"


def published(spark, root):
    """{name: DataFrame} of the version that is in force; all are of the same one."""
    marker = stores.read_text(spark, f"{root}/{MARKER}")
    if marker is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    marker = json.loads(marker)
    reader = lambda: spark.read.option("header", True) if marker["format"] == "csv" else spark.read
    return {
        k: reader().schema(T.StructType.fromJson(schema)).format(marker["format"]).load(f"{root}/{marker['version']}/{k}")
        for k, schema in marker["datasets"].items()
    }


def publish_splits(df, root, names, fmt="parquet", split="split", keep=2):
    """``publish`` of one dataset per split; a split without rows is published empty."""
    return publish({n: df.where(F.col(split) == n).drop(split) for n in names}, root, fmt, keep)


def write_lines(df, path, col, mode="overwrite"):
    """One text column as plain lines."""
    df.select(F.col(col).cast("string")).write.mode(mode).text(path)
    return path


def write_stats(stats, path, mode="overwrite"):
    """Save the one-row mean / std frame as a JSON document."""
    body = stats.select(F.to_json(F.struct("mean", "std")).alias("value"))
    body.coalesce(1).write.mode(mode).text(path)
    return path


def stats_schema(cols):
    inner = T.StructType([T.StructField(c, T.DoubleType()) for c in cols])
    return T.StructType([T.StructField("mean", inner), T.StructField("std", inner)])


def read_stats(spark, path, cols):
    """Read back what ``write_stats`` saved, as the one-row frame."""
    text = spark.read.text(path, wholetext=True)
    parsed = text.select(F.from_json("value", stats_schema(cols)).alias("s"))
    return parsed.select("s.mean", "s.std")
