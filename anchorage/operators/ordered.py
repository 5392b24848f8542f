"""Running totals and numbering that never put a big group into one task.

A plain ``sum() over (partition by k order by v)`` sorts all rows of ``k`` in a
single task. Here the ordering column of big groups is first cut at its
quantiles. Rows are windowed inside (key, bucket), and each bucket starts from
the total of the buckets before it, taken from one small row per (key, bucket).
A bucket holds about 1/``buckets`` of the rows whatever the keys look like.

The cuts are explicit numbers on the driver (at most ``buckets`` of them), so a
recomputed task sees exactly the same buckets.
"""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anchorage.functions import times

_NUMBER, _CODE, BUCKET = "_ord_number", "_ord_code", "_ord_bucket"


# a group of up to this many rows is sorted by one task without trouble
GROUP_ROWS = 100_000


def default_buckets(spark):
    """Twice the shuffle width, which follows the cluster: each bucket is about half a task."""
    return max(16, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def _string_number(df, col):
    """Number that follows string order: the six bytes after the prefix all values share."""
    low, high = df.agg(F.min(col), F.max(col)).first()
    low, high = ((s or "").encode() for s in (low, high))
    shared = 0
    while shared < min(len(low), len(high)) and low[shared] == high[shared]:
        shared += 1
    piece = F.substring(F.col(col).cast("binary"), shared + 1, 6)
    return F.conv(F.rpad(F.hex(piece), 12, "0"), 16, 10).cast("double")


def _number(df, col):
    """The column as a double that never reverses its order."""
    kind = df.schema[col].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return times.micros(col).cast("double")
    if isinstance(kind, T.StringType):
        return _string_number(df, col)
    return F.col(col).cast("double")


def _cut(df, number, buckets):
    """Quantile cuts of a double column and the values heavy enough to span several cuts."""
    probs = [i / buckets for i in range(1, buckets)]
    points = df.select(number.alias(_NUMBER)).approxQuantile(_NUMBER, probs, 0.25 / buckets)
    # infinite values fall into the first or the last bucket
    points = [p for p in points if math.isfinite(p)]
    heavy = sorted({a for a, b in zip(points, points[1:]) if a == b})
    return sorted(set(points)), heavy


def _assign(df, number, cuts, out):
    """Bucket index of a double column; values equal to a cut open the next bucket."""
    if not cuts:
        return df.withColumn(out, F.lit(0).cast("long"))
    splits = [float("-inf"), *cuts, float("inf")]
    step = Bucketizer(
        splits=splits, inputCol=_NUMBER, outputCol=_CODE, handleInvalid="keep"
    ).transform(df.withColumn(_NUMBER, number))
    # never null, so joins on it need no filter that would run the cut again on every input row
    code = F.when(F.col(_NUMBER).isNotNull(), F.col(_CODE).cast("long"))
    return step.withColumn(out, F.coalesce(code, F.lit(-1).cast("long"))).drop(_NUMBER, _CODE)


def bucketing(df, order, buckets=None):
    """A function adding an order-preserving bucket number, with cuts taken from ``df``.

    The first ordering column is cut at its quantiles. A value so frequent that it
    fills whole buckets gets buckets of its own, cut by the second (tie-breaking)
    column, so even one repeated value is spread over many tasks.
    """
    buckets = buckets or default_buckets(df.sparkSession)
    number = _number(df, order[0])
    cuts, heavy = _cut(df, number, buckets)
    if not heavy or len(order) < 2:
        return lambda rows: _assign(rows, number, cuts, BUCKET)
    # a heavy value is always a cut, so it comes first in its bucket
    is_heavy = number.isin(heavy)
    tie = _number(df, order[1])
    tie_cuts, _ = _cut(df.where(is_heavy), tie, buckets)
    span = len(tie_cuts) + 2
    place = F.when(F.col("_ord_heavy"), F.col("_ord_tie") + 1).otherwise(F.lit(span))

    def assign(rows):
        coded = _assign(rows, number, cuts, BUCKET).withColumn("_ord_heavy", is_heavy)
        return (
            _assign(coded, tie, tie_cuts, "_ord_tie")
            .withColumn(BUCKET, F.col(BUCKET) * (span + 1) + place)
            .drop("_ord_heavy", "_ord_tie")
        )

    return assign


def with_buckets(df, order, buckets=None):
    """``df`` with the bucket numbers of its own cuts."""
    return bucketing(df, order, buckets)(df)


def _sorting(order, descending):
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def hot_keys(df, by, buckets, group_rows=GROUP_ROWS):
    """Keys with more than ``group_rows`` rows and more than 1/``buckets`` of all rows.

    At most ``buckets`` keys can hold such a share, which bounds this frame
    whatever the data, so it may be broadcast.
    """
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    share = counts.agg(F.sum("_rows") / F.lit(buckets)).scalar()
    return counts.where((F.col("_rows") > group_rows) & (F.col("_rows") > share)).select(*by)


def running_sums(
    df,
    by,
    order,
    sums,
    buckets=None,
    descending=False,
    totals=(),
    split_all=False,
    group_rows=GROUP_ROWS,
    made_from=None,
):
    """Add running sums of ``sums`` = {output: input} in ``order`` within ``by``.

    ``totals`` names outputs whose grand total per ``by`` is wanted too, as
    ``<output>_total``. Rows must be unique in (by, order).

    Big groups are found by a count per key and split. ``split_all`` skips the
    count and splits every group, for when there are few of them (or, with an
    empty ``by``, just one). With it, ``made_from`` may
    give the rows that ``df`` is an aggregate of, under the same column names: cuts
    and bucket totals are then taken from them, which spares computing ``df`` twice.
    """
    by, order = list(by), list(order)
    buckets = buckets or default_buckets(df.sparkSession)
    if buckets == 1:
        return _windowed(df, by, order, sums, descending, totals)
    if split_all or not by:
        source = df if made_from is None else made_from
        assign = bucketing(source, order, buckets)
        coded = assign(df)
        offsets = _offsets(assign(source), by, sums, descending, totals)
        joined = _join(coded, offsets, [*by, BUCKET], "inner")
        return _from_offsets(joined, by, order, sums, descending, totals)

    hot = hot_keys(df, by, buckets, group_rows)
    found = hot.collect()
    if not found:
        return _windowed(df, by, order, sums, descending, totals)
    hot = df.sparkSession.createDataFrame(found, hot.schema).withColumn("_hot", F.lit(True))
    marked = _join(df, hot, by, "left", F.broadcast)
    big = with_buckets(marked.where("_hot"), order, buckets)
    # at most one row per hot key and bucket
    offsets = _offsets(big, by, sums, descending, totals)
    rest = marked.where("_hot is null").withColumn(BUCKET, F.lit(-2).cast("long"))
    coded = big.unionByName(rest).drop("_hot")
    joined = _join(coded, offsets, [*by, BUCKET], "left", F.broadcast)
    return _from_offsets(joined, by, order, sums, descending, totals).select(
        *df.columns, *[f"{k}_total" for k in totals], *sums
    )


def _join(left, right, on, how, hint=lambda df: df):
    """Join on columns of equal names in which null is a value like any other."""
    renamed = {c: f"_right{i}" for i, c in enumerate(on)}
    right = hint(right.withColumnsRenamed(renamed))
    same = [F.col(c) == F.col(r) if c == BUCKET else F.col(c).eqNullSafe(F.col(r)) for c, r in renamed.items()]
    return left.join(right, same, how).drop(*renamed.values())


def _offsets(coded, by, sums, descending, totals):
    """Per (by, bucket) the sums of the buckets before it, and the totals of the group."""
    per_bucket = coded.groupBy(*by, BUCKET).agg(
        *[F.sum(v).alias(f"_sum_{k}") for k, v in sums.items()]
    )
    # as many rows per group as there are buckets, whatever the group's size
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    place = F.col(BUCKET).desc() if descending else F.col(BUCKET).asc()
    before = group.orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.select(
        *by,
        BUCKET,
        *[F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)).alias(f"_off_{k}") for k in sums],
        *[F.sum(f"_sum_{k}").over(group).alias(f"_all_{k}") for k in totals],
    )


def _from_offsets(joined, by, order, sums, descending, totals):
    group = Window.partitionBy(*by, BUCKET)
    upto = group.orderBy(*_sorting(order, descending)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # a group that was not split has no offsets: it starts at zero and is its own total
    return joined.withColumns(
        {
            **{k: F.coalesce(F.col(f"_off_{k}"), F.lit(0)) + F.sum(v).over(upto) for k, v in sums.items()},
            **{f"{k}_total": F.coalesce(F.col(f"_all_{k}"), F.sum(sums[k]).over(group)) for k in totals},
        }
    ).drop(BUCKET, *[f"_off_{k}" for k in sums], *[f"_all_{k}" for k in totals])


def _windowed(df, by, order, sums, descending, totals):
    """The plain window, where no group is big."""
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    upto = group.orderBy(*_sorting(order, descending)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return df.select(
        "*",
        *[F.sum(sums[k]).over(group).alias(f"{k}_total") for k in totals],
        *[F.sum(v).over(upto).alias(k) for k, v in sums.items()],
    )


def row_numbers(df, by, order, out="row_number", buckets=None, group_rows=GROUP_ROWS):
    """Number rows 1, 2, ... within ``by`` in ascending ``order``; the last key must be unique."""
    one = df.withColumn("_one", F.lit(1).cast("long"))
    return running_sums(one, by, order, {out: "_one"}, buckets, group_rows=group_rows).drop("_one")
