"""What a run was made from: dataset fingerprints, parameters, versions."""

import os
import platform

import pyspark
from pyspark.sql import functions as F

from anchorage.functions import hashing
from anchorage.sources import files


def fingerprint(df, cols=None, digest="sha2"):
    """(rows, slice_a, slice_b): an order-free fingerprint of a dataset.

    Each row is hashed with all its columns and two 60-bit slices of the hashes
    are added up, so copies count and no row order or sort is needed. Sums are
    decimal text, wide enough for 10^19 rows.
    """
    text = hashing.row_text(cols or df.columns, dict(df.dtypes))
    hashed = F.sha2(text, 256) if digest == "sha2" else F.md5(text)
    a, b = hashing.slices(hashed)
    total = [
        F.coalesce(F.sum(s.cast("decimal(28,0)")), F.lit(0)).cast("string").alias(n)
        for s, n in ((a, "slice_a"), (b, "slice_b"))
    ]
    return df.agg(F.count(F.lit(1)).alias("rows"), *total)


def file_hashes(spark, root, pattern="*", shards=None, size=files.RANGE):
    """(path, length, ranges, sha256) of files, hashed by ranges of ``size`` bytes in parallel."""
    return files.hashes(spark, root, pattern, shards, size)


def build(spark, datasets, params=None, paths=None, revision=None, ref=None, folders=None, digest="sha2", size=files.RANGE):
    """(key, value) rows describing a run; ``datasets`` = {name: DataFrame}, ``paths`` = {name: path}.

    Code revision and reference come from the caller or from ``GIT_SHA`` and
    ``GIT_REF``; it is an error if there is neither. ``folders`` = {name: folder} adds a
    hash over the relative paths, lengths and contents of the files of each folder, which
    are read by ranges of ``size`` bytes.
    """
    revision, ref = revision or os.getenv("GIT_SHA"), ref or os.getenv("GIT_REF")
    if not revision or not ref:
        raise ValueError("a run needs the revision and the reference of its code")
    # fixed values: the names of the keys
    fixed = {
        "source.git_sha": revision,
        "source.git_ref": ref,
        "environment.platform": platform.platform(),
        "environment.python_version": platform.python_version(),
        "environment.spark_version": spark.version,
        "environment.pyspark_version": pyspark.__version__,
        "environment.master": spark.sparkContext.master,
        "environment.shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }
    fixed |= {k: str(v) for k, v in (params or {}).items()}
    fixed |= {f"dataset.{k}_filepath": v for k, v in (paths or {}).items()}
    out = spark.createDataFrame(sorted(fixed.items()), "key string, value string")
    listed = {
        name: file_hashes(spark, root, size=size).select("path", "length", "sha256") for name, root in (folders or {}).items()
    }
    hashed = [(f"{k}_fingerprint", df) for k, df in datasets.items()]
    hashed += [(f"{k}_files", df) for k, df in listed.items()]
    for name, df in hashed:
        f = fingerprint(df, digest=digest)
        body = F.concat_ws(":", F.col("rows").cast("string"), "slice_a", "slice_b")
        out = out.unionByName(
            f.select(F.lit(f"dataset.{name}").alias("key"), body.alias("value"))
        )
    return out
