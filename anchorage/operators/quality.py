"""Checks and column profiles, each a single pass over the data."""

from itertools import zip_longest

from pyspark.sql import functions as F

from anchorage.functions.names import quoted, rows, text
from anchorage.sources import files


def _per_column(df, aggs, cells):
    """One global aggregate over all columns, turned into one row per cell."""
    return df.agg(*map(F.expr, aggs)).selectExpr(rows(cells))


def _nulls(cols):
    return [f"count_if({quoted(c)} is null) as c{i}" for i, c in enumerate(cols)]


def missing_counts(df, cols=None):
    """(column, missing)."""
    cols = cols or df.columns
    cells = [f"{text(c)} as column, c{i} as missing" for i, c in enumerate(cols)]
    return _per_column(df, _nulls(cols), cells)


def counted(missing):
    """Only the columns that miss something."""
    return missing.where(F.col("missing") > 0)


def schema_report(df, onehot=()):
    """(position, column, type, onehot, rows, nulls)."""
    cells = [
        f"{i} as position, {text(c)} as column, {text(t)} as type, {c in onehot} as onehot, "
        f"n as rows, c{i} as nulls"
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return _per_column(df, ["count(1) as n", *_nulls(df.columns)], cells)


def null_consistency(df, feats):
    """Do min, max and mean of a feature miss together, in number and row by row?"""
    aggs, cells = [], []
    for i, f in enumerate(feats):
        low, high, mean = (f"({quoted(f'{f}_{s}')} is null)" for s in ("min", "max", "mean"))
        aggs += [f"count_if({g}) as {n}{i}" for n, g in (("a", low), ("b", high), ("c", mean))]
        aggs.append(f"count_if({low} <> {high} or {high} <> {mean}) as d{i}")
        cells.append(
            f"{text(f)} as feature, a{i} as min_nulls, b{i} as max_nulls, c{i} as mean_nulls, "
            f"d{i} as rows_differing, a{i} = b{i} and b{i} = c{i} and d{i} = 0 as ok"
        )
    return _per_column(df, aggs, cells)


def domain(df, col, allowed):
    """Values outside the allowed set with their row counts; null is outside."""
    outside = F.col(col).isNull() | ~F.col(col).isin(list(allowed))
    return df.where(outside).groupBy(F.col(col).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def mandatory(df, cols):
    """Columns that may not be null but are, with their null counts."""
    return counted(missing_counts(df, cols))


def contract(df, expected):
    """Are the features the expected ones, in order, and free of null and NaN?"""
    aggs = ["count_if(false) as none"]
    for i, (c, kind) in enumerate(df.dtypes):
        nan = f" or isnan({quoted(c)})" if kind in ("double", "float") else ""
        aggs.append(f"count_if({quoted(c)} is null{nan}) as b{i}")
    cells = []
    for i, (want, have) in enumerate(zip_longest(expected, df.columns)):
        bad = "none" if have is None else f"b{i}"
        cells.append(
            f"{i} as position, {text(want)} as expected, {text(have)} as actual, {bad} as bad_rows, "
            f"{want == have} and {bad} = 0 as ok"
        )
    return _per_column(df, aggs, cells)


def require(found, message):
    """Run a check frame and fail if it has any row (shows at most twenty)."""
    some = found.limit(20).collect()
    if some:
        raise ValueError(f"{message}: " + "; ".join(str(r.asDict()) for r in some))


def require_consistent(df, feats):
    require(
        null_consistency(df, feats).where(~F.col("ok")),
        "min, max and mean must be missing together",
    )


def missing_paths(expected, present, col="path"):
    """Expected paths that are not present."""
    return expected.join(present.select(col).distinct(), col, "left_anti")


def inventory(expected, present, col="path"):
    """Paths of one side only: ``state`` is missing (expected, not present) or surplus (present, not expected)."""
    sides = [df.select(col).distinct().withColumn(f"_{k}", F.lit(True)) for k, df in enumerate((expected, present))]
    both = sides[0].join(sides[1], col, "full").where("_0 is null or _1 is null")
    return both.select(col, F.when(F.col("_1").isNull(), "missing").otherwise("surplus").alias("state"))


def listing(spark, root, pattern="*", shards=None):
    """(path, length) of the files under a folder, each shard folder listed by a task; contents are not read."""
    return files.listing(spark, root, pattern, shards).select(
        F.concat(F.lit(root.rstrip("/") + "/"), F.col("path")).alias("path"), "length"
    )


def absent_inputs(spark, paths):
    """Which of a few input paths do not exist, on any file system Spark knows."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def there(p):
        path = jvm.org.apache.hadoop.fs.Path(p)
        return path.getFileSystem(conf).exists(path)

    return [p for p in paths if not there(p)]


def require_inputs(spark, paths):
    gone = absent_inputs(spark, paths)
    if gone:
        raise FileNotFoundError(f"these inputs do not exist: {', '.join(gone)}")
