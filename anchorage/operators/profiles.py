"""Column profiles that are stored and merged: rows, nulls, distinct counts and frequent values.

A state has one row per column and a size that does not grow with the data, so old plus new
data are profiled without reading the old again. Distinct counts are HyperLogLog sketches
of 2^``LG`` registers: the relative standard error is about 1.04 / sqrt(2^LG), under 1.7 % at 12.
Frequent values are counted by a sketch that keeps up to ``TRACKED`` of them; counts are exact
while a column has fewer different values than three quarters of that, else too high or too low
by a share of the rows that falls with ``TRACKED``. Values are compared as text; null is no value.
"""

from functools import reduce

from pyspark.sql import functions as F

from anchorage.functions.names import quoted, rows, text

LG = 12
TRACKED = 1024


def state(df, cols=None):
    """(position, column, type, rows, nulls, sketch, items) of every column, in one pass.

    An empty frame has a state like any other, with no rows. Columns that are not texts,
    numbers, times or Booleans must be cast or left out by the caller.
    """
    kinds = dict(df.dtypes)
    cols = list(cols or df.columns)
    aggs, cells = ["count(1) as n"], []
    for i, c in enumerate(cols):
        value = f"cast({quoted(c)} as string)"
        aggs += [
            f"count_if({quoted(c)} is null) as c{i}",
            f"hll_sketch_agg({value}, {LG}) as d{i}",
            f"approx_top_k_accumulate({value}, {TRACKED}) as t{i}",
        ]
        cells.append(
            f"{i} as position, {text(c)} as column, {text(kinds[c])} as type, n as rows, c{i} as nulls, "
            f"d{i} as sketch, t{i} as items"
        )
    return df.agg(*map(F.expr, aggs)).selectExpr(rows(cells))


def merge(*states):
    """The state of all the parts together; parts must have the same columns."""
    parts = reduce(lambda a, b: a.unionByName(b), states)
    return parts.groupBy("position", "column", "type").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.hll_union_agg("sketch").alias("sketch"),
        F.expr(f"approx_top_k_combine(items, {TRACKED})").alias("items"),
    )


def report(states):
    """(position, column, type, rows, nulls, distinct): ``distinct`` is an estimate, null not counted."""
    return states.select(
        "position", "column", "type", "rows", "nulls", F.hll_sketch_estimate("sketch").alias("distinct")
    )


def frequent(states, k=10):
    """(column, value, count): the ``k`` most frequent values of each column, null not among them."""
    known = f"filter(approx_top_k_estimate(items, {k + 1}), e -> e.item is not null)"
    top = F.explode(F.expr(f"slice({known}, 1, {k})")).alias("e")
    return states.select("column", top).select("column", F.col("e.item").alias("value"), F.col("e.count").alias("count"))
