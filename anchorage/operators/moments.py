"""Sufficient statistics of columns and pairs of columns, stored and merged without the rows.

A state is a small table with one row per pair (a column with itself for its mean and
deviation): n, means and centred sums over the rows in which both are known. States of
parts are merged by the pairwise update of means and centred sums, which does not cancel
as sums of squares do. Stored as JSON they are what training statistics and correlations
of old plus new data are made from.
"""

from itertools import combinations

from pyspark.sql import functions as F

from anchorage.functions.names import quoted, rows, text
from anchorage.sources import sinks

SCHEMA = "a string, b string, n double, x double, y double, xx double, yy double, xy double"
SUMS = ["n", "x", "y", "xx", "yy", "xy"]


def state(df, cols, pairs=False):
    """The state of the columns, and of all pairs of them if asked, in one pass."""
    wanted = [(c, c) for c in cols] + (list(combinations(cols, 2)) if pairs else [])
    aggs = []
    for k, (a, b) in enumerate(wanted):
        a, b = (f"cast({quoted(c)} as double)" for c in (a, b))
        both = f"filter (where {a} is not null and {b} is not null)"
        aggs.append(
            f"struct(cast(count(*) {both} as double) as n, avg({a}) {both} as x, avg({b}) {both} as y, "
            f"var_pop({a}) {both} as vx, var_pop({b}) {both} as vy, covar_pop({a}, {b}) as cov) as s{k}"
        )
    cells = rows(
        f"{text(a)} as a, {text(b)} as b, s{k}.n as n, s{k}.x as x, s{k}.y as y, "
        f"s{k}.n * s{k}.vx as xx, s{k}.n * s{k}.vy as yy, s{k}.n * s{k}.cov as xy"
        for k, (a, b) in enumerate(wanted)
    )
    return df.agg(*map(F.expr, aggs)).selectExpr(cells)


MERGED = """aggregate(slice(s, 2, size(s)), s[0], (p, q) -> named_struct(
    'n', p.n + q.n,
    'x', p.x + (q.x - p.x) * (q.n / (p.n + q.n)), 'y', p.y + (q.y - p.y) * (q.n / (p.n + q.n)),
    'xx', p.xx + q.xx + (q.x - p.x) * (q.x - p.x) * (p.n * q.n / (p.n + q.n)),
    'yy', p.yy + q.yy + (q.y - p.y) * (q.y - p.y) * (p.n * q.n / (p.n + q.n)),
    'xy', p.xy + q.xy + (q.x - p.x) * (q.y - p.y) * (p.n * q.n / (p.n + q.n))))"""


def merge(*states):
    """The state of all rows; a pair that no state has a row for keeps n = 0."""
    together = states[0]
    for more in states[1:]:
        together = together.unionByName(more)
    some = F.array_sort(F.collect_list(F.when(F.col("n") > 0, F.struct(*SUMS))))  # an order, for the same rounding
    folded = together.groupBy("a", "b").agg(some.alias("s")).select("a", "b", F.expr(f"if(size(s) > 0, {MERGED}, null) as m"))
    return folded.select("a", "b", F.expr("coalesce(m.n, 0D) as n"), *[F.col(f"m.{c}").alias(c) for c in SUMS[1:]])


def write(state, path):
    """Save a state as JSON lines in one file."""
    return sinks.write(state.coalesce(1), path, "json")


def read(spark, path):
    return spark.read.schema(SCHEMA).json(path)


def stats(state, cols):
    """``fit_stats`` from a state: one row, structs ``mean`` and ``std`` (sample deviation)."""

    def struct(value, out):
        body = ", ".join(f"max(case when a = {text(c)} and b = {text(c)} then {value} end) as {quoted(c)}" for c in cols)
        return F.expr(f"struct({body}) as {out}")

    return state.agg(struct("x", "mean"), struct("case when n > 1 then sqrt(xx / (n - 1)) end", "std"))


def corr(state):
    """(a, b, r) of the pairs in a state; without variance r is null."""
    return state.where("a != b").selectExpr("a", "b", "case when n > 1 then try_divide(xy, sqrt(xx) * sqrt(yy)) end as r")
