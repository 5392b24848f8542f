"""Flattening event tables to one row per key and merging several sources."""

from pyspark.sql import functions as F

from anchorage.functions.names import quoted

STATS = {"min": "min", "max": "max", "mean": "avg"}


def flatten_long(df, key, item, value, codes, suffix=""):
    """min / max / mean per feature of a long (item, value) table, one row per key.

    ``codes`` = {feature: [item codes]}; several codes pool into one feature. All
    features come out of a single hash aggregate with map-side combine.
    """
    wanted = {
        f: f"case when {quoted(item)} in ({', '.join(str(int(code)) for code in group)}) then {quoted(value)} end"
        for f, group in codes.items()
    }
    return _flatten(df, key, wanted, suffix)


def flatten_wide(df, key, cols, suffix=""):
    """The same for a wide table; ``cols`` = {feature: column}."""
    return _flatten(df, key, {f: quoted(c) for f, c in cols.items()}, suffix)


def _flatten(df, key, wanted, suffix):
    key = [key] if isinstance(key, str) else list(key)
    aggs = [
        f"{fn}({v}) as {quoted(f'{f}_{s}{suffix}')}" for f, v in wanted.items() for s, fn in STATS.items()
    ]
    return df.groupBy(*key).agg(*map(F.expr, aggs))


def only_items(df, item, value, codes):
    """Rows that can contribute: a wanted item code and a value (both reach the scan)."""
    flat = sorted({c for group in codes.values() for c in group})
    return df.where(F.col(item).isin(flat) & F.col(value).isNotNull())


def merged(feats, first, second):
    """Columns merging two flattened sources given their suffixes.

    The mean is the first source's if it has one; the extremes span both
    (``least`` and ``greatest`` skip nulls).
    """
    rules = {"mean": "coalesce", "min": "least", "max": "greatest"}
    return [
        F.expr(f"{rule}({quoted(f'{f}_{s}{first}')}, {quoted(f'{f}_{s}{second}')}) as {quoted(f'{f}_{s}')}")
        for f in feats
        for s, rule in rules.items()
    ]
