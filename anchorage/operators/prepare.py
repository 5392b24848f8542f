"""Fit on the training split, apply everywhere.

``fit_*`` returns a one-row frame. Applying it reads that row as one scalar
subquery, so there is no join and the plan stays lazy; it fits unseen data too.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from anchorage.functions.names import quoted, rows, text
from anchorage.operators import ordered
from anchorage.sources import sinks

EPSILON = 1e-8


def _row(one):
    """A one-row frame as a struct-valued scalar."""
    return one.select(F.struct(*one.columns)).scalar()


def encode(df, col, mapping):
    """Replace each category by its code; any other value, null included, is an error."""
    code = None
    for value, number in mapping.items():
        hit = F.col(col) == F.lit(value)
        code = F.when(hit, number) if code is None else code.when(hit, number)
    seen = F.coalesce(F.col(col).cast("string"), F.lit("null"))
    wrong = F.raise_error(
        F.concat(F.lit(f"{'/'.join(map(str, mapping))} are the only values of {col}, found "), seen)
    )
    return df.withColumn(col, code.otherwise(wrong.cast("int")))


def indicators(df, feats):
    """``<f>_missing`` = 1 where the feature was never measured; always for every feature."""
    flags = [f"cast({quoted(f'{f}_max')} is null as int) as {quoted(f'{f}_missing')}" for f in feats]
    return df.selectExpr("*", *flags)


STATE_SIZE = 4096  # of a KLL sketch; its rank error grows slower than 1 / size
SURE = 4  # brackets are as many stated errors (of 99 in 100 cases) wide to each side


def rank_error(size):
    """A KLL sketch's one-sided rank error, as a share of the rows, not surpassed in 99 of 100 cases."""
    return 2.296 / size**0.9021


def quantile_state(df, cols, size=STATE_SIZE):
    """What brackets quantiles later: a one-row frame with a KLL sketch (binary) per column.

    States of parts are merged by ``merge_states`` without reading rows again, and may be
    stored as any table. A column without a value has a null state; nulls and NaN are left out.
    """
    some = [f"kll_sketch_agg_double(cast({q} as double), {size}) filter (where not isnan(cast({q} as double)) and {q} is not null) as {q}" for q in map(quoted, cols)]
    there = [f"count_if(not isnan(cast({q} as double)) and {q} is not null) as {q}" for q in map(quoted, cols)]
    counted = df.select(*[F.col(quoted(c)) for c in cols]).agg(
        F.expr(f"struct({', '.join(some)}) as s"), F.expr(f"struct({', '.join(there)}) as n")
    )
    return counted.selectExpr(*[f"if(n.{q} > 0, s.{q}, null) as {q}" for q in map(quoted, cols)])


def merge_states(*states):
    """The state of all rows from the states of their parts."""
    merged = states[0]
    for more in states[1:]:
        merged = merged.unionByName(more)
    return merged.agg(*[F.expr(f"if(count({q}) > 0, kll_merge_agg_double({q}), null) as {q}") for q in map(quoted, merged.columns)])


def state_quantiles(state, shares):
    """{column: values at the shares} of a state, None where it has no value."""
    cells = [
        f"if({q} is null, null, array({', '.join(f'kll_sketch_get_quantile_double({q}, double({p!r}))' for p in shares)})) as {q}"
        for q in map(quoted, state.columns)
    ]
    return state.selectExpr(*cells).first().asDict()


def fit_medians(df, cols, approx=False, state=None, size=STATE_SIZE, group_rows=ordered.GROUP_ROWS):
    """Exact median of each column as a one-row frame; all-null columns give null.

    A quantile state brackets each median: that of ``df``, or a given one, such as old
    rows' state merged with that of the new. One pass counts what lies below and inside
    the brackets; one that misses its median is widened, at last to all values. Then only
    the values inside are counted by value, and running counts pick the middle one or two.
    Beyond ``group_rows`` values inside, the running counts are split over tasks. ``approx``
    stops at the state.
    """
    cols = list(cols)
    wide = df.selectExpr(*[f"cast({quoted(c)} as double) as {quoted(c)}" for c in cols])
    state = quantile_state(wide, cols, size) if state is None else state.select(*map(quoted, cols))
    if approx:
        found = state_quantiles(state, [0.5])
        values = [f"{_double(v[0]) if v else 'cast(null as double)'} as {quoted(c)}" for c, v in found.items()]
        return df.sparkSession.range(1).selectExpr(*values)
    bracket, counts = {}, {}
    for spans in _brackets(state, [SURE * rank_error(size), 10 * SURE * rank_error(size)]):
        some = {c: spans[c] for c in cols if c not in counts}
        bracket |= some
        counts |= _counted(wide, some)
        if len(counts) == len(cols):
            break
    filled = {c: n for c, n in counts.items() if n[0]}
    if not filled:
        return _each(wide.limit(0), cols, "max({})")
    return _middle(wide, cols, {c: bracket[c] for c in filled}, filled, group_rows)


def _each(df, cols, aggregate):
    return df.agg(*[F.expr(f"{aggregate.format(quoted(c))} as {quoted(c)}") for c in cols])


def _double(x):
    return f"double('{x!r}')"


def _brackets(state, slacks):
    """{column: (lowest, highest)} around each median, for each slack, and at last all values."""
    shares = [p for slack in slacks for p in (max(0.0, 0.5 - slack), min(1.0, 0.5 + slack))]
    found = state_quantiles(state, shares)
    everything = dict.fromkeys(found, (float("-inf"), float("nan")))
    spans = [{c: (v[2 * k], v[2 * k + 1]) for c, v in found.items() if v} for k in range(len(slacks))]
    return [*(everything | s for s in spans), everything]


def _counted(wide, bracket):
    """{column: (values, below, inside)} of the brackets that hold the median, or are of columns without a value."""
    counts = wide.agg(
        *[
            F.expr(
                f"array(count({quoted(c)}), count_if({quoted(c)} < {_double(lo)}), "
                f"count_if({quoted(c)} between {_double(lo)} and {_double(hi)})) as {quoted(c)}"
            )
            for c, (lo, hi) in bracket.items()
        ]
    ).first()
    found = {c: tuple(counts[c]) for c in bracket}
    return {c: (n, below, inside) for c, (n, below, inside) in found.items() if below < (n + 1) // 2 and n // 2 + 1 <= below + inside or not n}


def _middle(wide, cols, bracket, counts, group_rows):
    """Medians from the counts of the values inside the brackets."""
    cells = rows(
        f"{text(c)} as column, case when {quoted(c)} between {_double(lo)} and {_double(hi)} then {quoted(c)} end as v"
        for c, (lo, hi) in bracket.items()
    )
    inside = wide.selectExpr(cells).where("v is not null").groupBy("column", "v").agg(F.expr("count(1) as rows"))
    if max(n for _, _, n in counts.values()) <= group_rows:
        upto = Window.partitionBy("column").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = inside.withColumn("upto", F.sum("rows").over(upto))
    else:
        placed = ordered.running_sums(sinks.materialize(inside), ["column"], ["v"], {"upto": "rows"}, split_all=True)
    below = " ".join(f"when {text(c)} then {n[1]}" for c, n in counts.items())
    total = " ".join(f"when {text(c)} then {n[0]}" for c, n in counts.items())
    placed = placed.selectExpr("column", "v", f"case column {below} end + upto as last", "rows", f"case column {total} end as n")

    def at(k):
        return f"max(case when last - rows < {k} and {k} <= last then v end)"

    middle = placed.groupBy("column").agg(F.expr(f"({at('(n + 1) div 2')} + {at('n div 2 + 1')}) / 2 as median"))
    return middle.agg(
        *[F.expr(f"max(case when column = {text(c)} then median end) as {quoted(c)}") for c in cols]
    )


def impute(df, medians):
    """Fill nulls of the fitted columns with their medians."""
    fitted = set(medians.columns)
    filled = [
        f"coalesce({quoted(c)}, _fit.{quoted(c)}) as {quoted(c)}" if c in fitted else quoted(c)
        for c in df.columns
    ]
    return df.withColumn("_fit", _row(medians)).selectExpr(*filled)


def fit_stats(df, cols):
    """Mean and sample standard deviation of each column: one row, structs ``mean`` and ``std``."""

    def struct(aggregate, out):
        body = ", ".join(f"{aggregate}({quoted(c)}) as {quoted(c)}" for c in cols)
        return F.expr(f"struct({body}) as {out}")

    return df.agg(struct("avg", "mean"), struct("stddev_samp", "std"))


def standardize(df, stats, cols=None):
    """``(x - mean) / (std + 1e-8)`` for the fitted columns; the others are left as they are."""
    fitted = set(cols or stats.schema["mean"].dataType.names)
    scaled = [
        f"({q} - _fit.mean.{q}) / (_fit.std.{q} + double('{EPSILON}')) as {q}" if c in fitted else q
        for c, q in ((c, quoted(c)) for c in df.columns)
    ]
    return df.withColumn("_fit", _row(stats)).selectExpr(*scaled)


def assemble(df, order, label=None, out="features"):
    """Ordered features as one ``array<float>``, plus a float label."""
    kept = [quoted(c) for c in df.columns if c not in order and c != label]
    vector = f"array({', '.join(f'cast({quoted(c)} as float)' for c in order)}) as {quoted(out)}"
    y = [f"cast({quoted(label)} as float) as {quoted(label)}"] if label else []
    return df.selectExpr(*kept, vector, *y)
