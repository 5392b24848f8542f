"""Places of rows within their groups, for groups of any size."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from anchorage.sources import sinks


def numbered(rows, group, order):
    """Add ``_i``, a row's place in its group from 0, and ``_n``, the rows of the group.

    Rows are dealt out by ranges of (group, order) and sorted within them, so that a group
    of any size, even one of equal rows, spreads over tasks; what joins the ranges is one
    small row per range and group. Null is a group, and nulls come first. Rows that are
    equal in all of ``order`` follow each other in any order, the same on every read.
    """
    keys = [group, *order, "_row"]
    # stored first, so that the numbers that break ties are the same in every attempt of a task
    rows = sinks.materialize(rows.withColumn("_row", F.monotonically_increasing_id()))
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = sinks.materialize(dealt.drop("_row").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)  # the number counts rows within a partition
    runs = dealt.groupBy(part.alias("_part"), F.col(group).alias("_run")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_first")
    )
    each = Window.partitionBy("_run")  # a row per range at most
    runs = sinks.materialize(
        runs.select(
            "_part",
            "_run",
            (F.sum("_c").over(each.orderBy("_part")) - F.col("_c") - F.col("_first")).alias("_shift"),
            F.sum("_c").over(each).alias("_n"),
        )
    )
    same = (part == F.col("_part")) & F.col(group).eqNullSafe(F.col("_run"))
    found = dealt.join(runs, same)
    return found.select(*rows.drop("_row").columns, (F.col("_at") + F.col("_shift")).alias("_i"), "_n")
