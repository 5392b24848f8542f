"""First, nearest and numbered rows per key, always with a full tie-break."""

from pyspark.sql import functions as F

from anchorage.operators import ordered


def first(df, key, order):
    """The earliest whole row per key.

    An aggregate, not a window: each task keeps one candidate per key before
    anything is shuffled, so no task gathers the rows of a busy key. Spark sorts each
    input partition by key for it. ``row_number() = 1`` sorts too, and by the order as
    well: 12 million rows of 300,000 keys took it 3.3 s against 2.6 s (three fixed-width
    columns) and 3.9 s against 3.2 s (a text column more), warm, on 8 cores.
    """
    key = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in key]
    best = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*key).agg(best.alias("_row")).select(*key, "_row.*").select(*df.columns)


def number(df, key, order, out="stay_number"):
    """Every row, numbered within its key."""
    return ordered.row_numbers(df, [key] if isinstance(key, str) else key, order, out)


def top_k(df, col, k, skip=0, tie=None):
    """The ``k`` largest rows after skipping ``skip``, largest first."""
    by = [F.col(col).desc_nulls_last()] + ([F.col(tie).asc()] if tie else [])
    return df.orderBy(*by).limit(k + skip).offset(skip)


def peek(df, order, n=5):
    """First ``n`` rows of a total order, so that it gives the same rows every time."""
    return df.orderBy(*order).limit(n)
