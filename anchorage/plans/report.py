"""The exploration report as one long table."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from anchorage.functions.names import quoted, rows, text
from anchorage.operators import explore


def explore_report(df, label, flag, feats, k=10):
    """(section, name, value): missing counts, label balance, rates by flag, top correlations.

    Two passes: one global aggregate for everything but the rates by flag.
    """
    y = quoted(label)
    aggs = [f"sum(cast({y} as bigint)) as positives", f"count({y}) as total"]
    cells = [
        "'balance' as section, 'positives' as name, cast(positives as double) as value",
        "'balance' as section, 'total' as name, cast(total as double) as value",
        "'balance' as section, 'pos_weight' as name, try_divide(total - positives, positives) as value",
    ]
    for i, c in enumerate(feats):
        q = quoted(c)
        aggs += [
            f"count_if({q} is null) as m{i}",
            f"corr(cast({q} as double), cast({y} as double)) as r{i}",
        ]
        cells += [
            f"'missing' as section, {text(c)} as name, cast(m{i} as double) as value",
            f"'correlation' as section, {text(c)} as name, r{i} as value",
        ]
    # a few rows per column of the frame
    found = df.agg(*map(F.expr, aggs)).selectExpr(rows(cells))
    place = F.row_number().over(
        Window.partitionBy("section").orderBy(F.col("value").desc_nulls_last(), "name")
    )
    found = (
        found.withColumn("_place", place)
        .where(f"section = 'balance' or (section = 'missing' and value > 0) or (section = 'correlation' and _place < {int(k)})")
        .drop("_place")
    )
    rates = explore.rate_by(df, flag, label).selectExpr(
        "'rate' as section", "cast(flag as string) as name", "rate_pct as value"
    )
    return found.unionByName(rates)
