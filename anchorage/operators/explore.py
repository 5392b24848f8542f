"""Reports: rates, correlations, distributions. Rows are reduced before anything is multiplied."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from anchorage.functions.names import quoted, rows, text
from anchorage.operators import ranking, split

# groups whose bootstrap sums a task holds before it hands them on
HELD_GROUPS = 1000


def label_balance(df, label):
    """(positives, total, pos_weight): pos_weight is negatives / positives."""
    y = F.col(label)
    return df.agg(
        F.sum(y.cast("long")).alias("positives"), F.count(label).alias("total")
    ).withColumn("pos_weight", F.try_divide(F.col("total") - F.col("positives"), F.col("positives")))


def rate_by(df, flag, label):
    """(flag, rows, rate_pct, difference_pct): label rate per flag value and the gap of 0 and 1."""
    per = df.groupBy(F.col(flag).alias("flag")).agg(
        F.count(label).alias("rows"), (F.avg(label) * 100).alias("rate_pct")
    )
    # computed over the groups; asking for all of their columns lets the grouped shuffle be reused
    rate = "max(case when flag = {} then rate_pct end)"
    gap = per.agg(F.expr(f"struct(abs({rate.format(0)} - {rate.format(1)}) as pct, sum(rows) as rows)"))
    return per.withColumn("difference_pct", gap.scalar()["pct"])


def bootstrap_mean(df, by, label, replicates=1000, seed=42, level=0.95):
    """(by, rows, mean, low, high): group mean of a numeric label with its bootstrap interval.

    A replicate gives every row a Poisson(1) weight, so equal values of a group weigh
    Poisson(count) together. Values are counted first, the weighted sums are taken where
    the counts lie, and only one row per group and replicate is shuffled. Draws depend on
    seed, group and value alone. A null group is a group; null labels are left out.
    """
    seen = df.where(F.col(label).isNotNull()).select(by, F.col(label).cast("double").alias("_v"))
    means = seen.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.avg("_v").alias("mean"))
    key = F.col(by).cast("string")
    cells = seen.groupBy(by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    cells = cells.select(key.alias("_key"), "_v", "_n", F.xxhash64(F.lit(seed), key, "_v").alias("_seed"))

    def table(sums):
        return pd.DataFrame([(k, *s) for k, s in sums.items()], columns=["_key", "_weights", "_values"])

    def run(batches):
        sums = {}
        for batch in batches:
            for k, v, n, own in batch.itertuples(index=False):
                drawn = np.random.Generator(np.random.Philox(key=own % 2**64)).poisson(n, replicates)
                total = sums.setdefault(k, np.zeros((2, replicates)))
                total += [drawn, drawn * v]
                if len(sums) >= HELD_GROUPS:
                    yield table(sums)
                    sums = {}
        yield table(sums)

    draws = (
        cells.mapInPandas(run, "_key string, _weights array<double>, _values array<double>")
        .select("_key", F.posexplode(F.arrays_zip("_weights", "_values")).alias("_rep", "_sums"))
        .groupBy("_key", "_rep")
        .agg(F.try_divide(F.sum("_sums._values"), F.sum("_sums._weights")).alias("_draw"))
    )
    tail = (1 - level) / 2
    ends = draws.groupBy("_key").agg(F.percentile("_draw", [tail, 1 - tail]).alias("_ci"))
    return means.join(ends, key.eqNullSafe(F.col("_key"))).select(
        by, "rows", "mean", F.col("_ci")[0].alias("low"), F.col("_ci")[1].alias("high")
    )


def numeric_columns(df):
    return [
        c
        for c, t in df.dtypes
        if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")
    ]


def corr(df, cols=None):
    """Long Pearson matrix (a, b, r), pairwise complete.

    Each partition sums products of its columns, taken about the columns' means, as a few
    matrix products, and gives one row per pair of columns; so the cost of planning
    does not grow with the pairs. Without variance or with a single row r is null.
    """
    cols = cols or numeric_columns(df)
    wide = df.select(*[F.expr(f"cast({quoted(c)} as double)").alias(f"c{i}") for i, c in enumerate(cols)])
    # one row; only a shift for precision, so any finite value would do
    means = wide.agg(*[F.avg(c).alias(c) for c in wide.columns]).first()
    shift = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])

    def run(batches):
        total = np.zeros((4, len(cols), len(cols)))
        for batch in batches:
            known = np.array([c.is_valid().to_numpy(False) for c in batch.columns], dtype=float)
            x = np.array([c.fill_null(0.0).to_numpy(False) for c in batch.columns])
            x = np.where(known > 0, x - shift[:, None], 0.0)
            total += [known @ known.T, x @ known.T, (x * x) @ known.T, x @ x.T]
        i, j = np.indices(total.shape[1:]).reshape(2, -1)
        n, s, q, p = total
        values = (n, s, s.T, q, q.T, p)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype("int32")), pa.array(j.astype("int32")), *[pa.array(v.ravel()) for v in values]],
            ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"],
        )

    sums = wide.mapInArrow(run, "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double")
    sums = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    r = F.expr(
        "case when n > 1 then try_divide(sxy - sx * sy / n, "
        "sqrt(greatest(sxx - sx * sx / n, 0) * greatest(syy - sy * sy / n, 0))) end"
    )
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(names[F.col("i")].alias("a"), names[F.col("j")].alias("b"), r.alias("r"))


def _corr(a, b, out):
    return F.expr(f"corr(cast({quoted(a)} as double), cast({quoted(b)} as double)) as {out}")


def corr_with(df, label, cols=None):
    """(column, r): correlation of every numeric column with the label, label left out."""
    cols = [c for c in (cols or numeric_columns(df)) if c != label]
    one = df.agg(*[_corr(c, label, f"r{i}") for i, c in enumerate(cols)])
    return one.selectExpr(rows(f"{text(c)} as column, r{i} as r" for i, c in enumerate(cols)))


def top_corr(df, label, k=10, cols=None):
    """The ``k - 1`` columns that follow the label itself when sorted by correlation with it."""
    return ranking.top_k(corr_with(df, label, cols), "r", k - 1, tie="column")


def _range(df, x):
    """(low, high) of a column as a struct-valued scalar."""
    return df.agg(F.struct(F.min(x).alias("low"), F.max(x).alias("high")).alias("r")).scalar()


def histogram(df, x, by, bins=10, low=None, high=None):
    """(by, bin, low, rows): equal-width bins, the last one closed.

    Without ``low`` and ``high`` the column's range is taken, which costs a pass
    over that column; with them, values outside are left out.
    """
    seen = df.where(F.col(x).isNotNull()).select(by, F.col(x).cast("double").alias("_x"))
    if low is None or high is None:
        ranged = seen.withColumn("_r", _range(seen, "_x"))
    else:
        ends = F.struct(F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"))
        ranged = seen.where(F.col("_x").between(low, high)).withColumn("_r", ends)
    width = (F.col("_r.high") - F.col("_r.low")) / F.lit(float(bins))
    index = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_r.low")) / width), F.lit(bins - 1))
    )
    placed = ranged.select(by, index.cast("int").alias("bin"), F.col("_r.low").alias("_low"), width.alias("_w"))
    return (
        placed.groupBy(by, "bin", "_low", "_w")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(by, "bin", (F.col("_low") + F.col("bin") * F.col("_w")).alias("low"), "rows")
    )


def _binned(seen, bins):
    """Linear binning: each value's weight goes to its two neighbours on an even grid over the column's range."""
    width = (F.col("_r.high") - F.col("_r.low")) / F.lit(float(bins - 1))
    placed = seen.withColumn("_r", _range(seen, "_x")).withColumn("_w", width)
    at = F.when(F.col("_w") > 0, (F.col("_x") - F.col("_r.low")) / F.col("_w")).otherwise(0.0)
    placed = placed.withColumn("_at", at).withColumn("_i", F.floor("_at")).withColumn("_f", F.col("_at") - F.col("_i"))
    ends = F.array(
        F.struct(F.col("_i").alias("i"), (1 - F.col("_f")).alias("n")),
        F.struct((F.col("_i") + 1).alias("i"), F.col("_f").alias("n")),
    )
    cells = placed.select("_g", "_r", "_w", F.explode(ends).alias("_e")).where("_e.n > 0")
    return (
        cells.groupBy("_g", "_r", "_w", "_e.i")
        .agg(F.sum("_e.n").alias("_n"))
        .select("_g", (F.col("_r.low") + F.col("i") * F.col("_w")).alias("_x"), "_n")
    )


def kde(df, x, by, low=None, high=None, points=50, bins=None):
    """(by, x, density): Gaussian kernel density per group on an even grid.

    Bandwidth is Scott's, sample deviation times n^(-1/5), per group. Equal
    values are counted once first; each grid point is then a plain sum inside one
    aggregate, so no row is multiplied by the grid. Groups without spread give null.
    Without ``low`` and ``high`` the grid covers the column's range. ``bins`` puts the
    values on a grid of that many places first, for columns with few equal values: no
    more rows than groups times bins are shuffled, and with a bin width of w a density
    is off by at most (w / bandwidth)^2 / 8 of the kernel's height.
    """
    seen = df.where(F.col(x).isNotNull()).select(F.col(by).alias("_g"), F.col(x).cast("double").alias("_x"))
    if low is None or high is None:
        found = seen.agg(F.min("_x"), F.max("_x")).first()
        low = (found[0] or 0.0) if low is None else low
        high = (found[1] or 0.0) if high is None else high
    if bins:
        counted = _binned(seen, bins)
    else:
        counted = seen.groupBy("_g", "_x").agg(F.count(F.lit(1)).alias("_n"))
    spread = seen.groupBy("_g").agg(
        F.count(F.lit(1)).alias("_rows"), F.stddev_samp("_x").alias("_sd")
    ).withColumn("_h", F.col("_sd") * F.pow(F.col("_rows"), F.lit(-0.2)))
    step = (high - low) / (points - 1)
    grid = [low + step * i for i in range(points)]
    paired = counted.join(spread.where("_h > 0"), "_g").withColumn("_c", F.expr("-0.5D / (_h * _h)"))

    def height(g):
        away = f"(double('{g!r}') - _x)"
        return f"sum(_n * exp(_c * {away} * {away}))"

    sums = paired.groupBy("_g", "_rows", "_h").agg(
        *[F.expr(f"{height(g)} as k{i}") for i, g in enumerate(grid)]
    )
    cells = rows(
        f"{i} as point, double('{g!r}') as x, k{i} / (_rows * _h * sqrt(2 * pi())) as density"
        for i, g in enumerate(grid)
    )
    return sums.selectExpr(f"_g as {quoted(by)}", cells)


def scatter(df, x, y, by, key=None, frac=1.0, seed=42):
    """(x, y, by) rows with both values; ``frac`` < 1 thins them by the hash of ``key`` for drawing."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if frac < 1.0:
        both = split.sample(both, key, frac, seed)
    return both.select(x, y, by)


def study_counts(meta, subject="subject_id", date="StudyDate", study="study_id"):
    """(subject, date, files, studies): images and distinct studies per patient and day."""
    per_study = meta.groupBy(subject, date, study).agg(F.count(F.lit(1)).alias("_n"))
    return per_study.groupBy(subject, date).agg(
        F.sum("_n").alias("files"), F.count(study).alias("studies")
    )


def first_per(df, key, order):
    """One deterministic row per key, e.g. per (subject, timestamp); a global key is just fewer columns."""
    return ranking.first(df, key, order)


def row_count(df):
    return df.agg(F.count(F.lit(1)).alias("rows"))
