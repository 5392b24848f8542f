"""Interval joins between an anchor time per subject and a large event table.

In general this is an equi-join on (key, time slot) with the exact window as
residual. Slots are as long as the window, so an anchor row is needed in two slots
at most, while the events of one very busy key spread over as many join groups as
it has slots. What stays hot after that is split by AQE's skew join: all consumers
aggregate on another key, so no required partitioning stands in its way. The
planner broadcasts a side only when it knows it to be below its threshold.

Stored anchors can be looked over first (``span``). If they then turn out to be
few, they are broadcast and the events are not moved at all, which makes slots
needless; in any case the event scan is cut to the span of all windows.
"""

from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anchorage.functions import times
from anchorage.operators import ordered

_SLOT = "_slot"
# anchors (a few fixed-width columns each) that any executor can hold as a hash table
BROADCAST_ROWS = 1_000_000
# more anchors than this under one key are better told apart by slots
BROADCAST_PER_KEY = 8


@dataclass(frozen=True)
class Span:
    """Size and extent of a set of anchors.

    The ends of a zoned column are microseconds since 1970, which no time zone of the
    driver or the session can shift; those of a column without zone are its own times.
    """

    rows: int
    per_key: int
    low: datetime | int | None
    high: datetime | int | None
    window: tuple = ()

    @property
    def small(self):
        return self.rows <= BROADCAST_ROWS and self.per_key <= BROADCAST_PER_KEY


def span(anchor, on, t0, before, after=0):
    """Look over the anchors with one small job; they should be stored, not computed."""
    low, high = times.bounds(t0, before, after)
    if isinstance(anchor.select(low).schema[0].dataType, T.TimestampType):
        low, high = F.unix_micros(low), F.unix_micros(high)
    per_key = anchor.groupBy(*_keys(on)).agg(
        F.count(F.lit(1)).alias("n"), F.min(low).alias("low"), F.max(high).alias("high")
    )
    row = per_key.agg(F.sum("n"), F.max("n"), F.min("low"), F.max("high")).first()
    return Span(row[0] or 0, row[1] or 0, row[2], row[3], (t0, before, after))


def _width(before, after):
    if before + after <= 0:
        raise ValueError("the window must have a length")
    return times.hours(before + after)


def slot(t, width):
    """Index of the time slot of length ``width`` that ``t`` falls in; -1 without a time."""
    return F.coalesce(times.since_origin(t, width), F.lit(-1))


def _keys(on):
    return [on] if isinstance(on, str) else list(on)


def join(anchor, events, on, t0, t, before, after=0, found=None):
    """Pairs with ``t`` in ``[t0 - before, t0 + after]`` hours, both ends included.

    ``found`` is the ``span`` of these anchors and this window, if it is known.
    """
    on, width = _keys(on), _width(before, after)
    low, high = times.bounds(t0, before, after)
    if found is not None:
        if found.window != (t0, before, after):
            raise ValueError(f"the span is that of {found.window}, not of {(t0, before, after)}")
        # reaches the scan, which skips files and row groups outside
        events = events.where(F.col(t).between(_stamp(found.low), _stamp(found.high)))
        if found.small and _fixed_width(anchor):
            return F.broadcast(anchor).join(events, on).where(F.col(t).between(low, high))
    left = anchor.withColumn(_SLOT, F.explode(F.sequence(slot(low, width), slot(high, width))))
    right = events.withColumn(_SLOT, slot(t, width))
    # null counts as outside; saying so keeps the planner from adding a null filter
    # below the join, which would compute a derived time twice for every event
    inside = F.coalesce(F.col(t).between(low, high), F.lit(False))
    return left.join(right, [*on, _SLOT]).where(inside).drop(_SLOT)


def _fixed_width(df):
    """Whether the number of rows bounds the bytes too."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return all(isinstance(f.dataType, fixed) for f in df.schema)


def _stamp(t):
    if isinstance(t, int):
        return F.timestamp_micros(F.lit(t))
    return F.lit(None if t is None else t.isoformat(" ")).cast("timestamp_ntz")


def exists(anchor, events, on, t0, t, before, after=0):
    """Distinct keys having any event in the window of any of their anchors.

    No pair is ever formed. A window is exactly as long as a slot, so it covers
    the end of one slot and the beginning of the next. An event lies in the end
    part if the slot's latest event is not before the window start, and in the
    beginning part if the slot's earliest event is not after the window end. The
    extremes per (key, slot) of both sides therefore decide.
    """
    on, width = _keys(on), _width(before, after)
    low, high = times.bounds(t0, before, after)
    edges = F.explode(
        F.array(
            F.struct(slot(low, width).alias(_SLOT), low.alias("low"), F.lit(None).cast("timestamp_ntz").alias("high")),
            F.struct(slot(high, width).alias(_SLOT), F.lit(None).cast("timestamp_ntz").alias("low"), high.alias("high")),
        )
    )
    windows = (
        anchor.select(*on, edges.alias("e"))
        .groupBy(*on, F.col(f"e.{_SLOT}").alias(_SLOT))
        .agg(F.min("e.low").alias("_low"), F.max("e.high").alias("_high"))
    )
    extremes = (
        events.select(*on, slot(t, width).alias(_SLOT), F.col(t).alias("_t"))
        .groupBy(*on, _SLOT)
        .agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    )
    hit = (F.col("_last") >= F.col("_low")) | (F.col("_first") <= F.col("_high"))
    return windows.join(extremes, [*on, _SLOT]).where(hit).select(*on).distinct()


def nearest(anchor, events, on, t0, t, before, tie, key=None, after=0, pick="closest", group_rows=ordered.GROUP_ROWS):
    """For each anchor the one event of its window closest to ``t0``.

    ``pick="farthest"`` takes the other end of the window. Equal gaps go to the
    smallest ``tie``. ``key`` names the columns that identify an anchor (default:
    all of its columns). Anchors without an event in the window drop out, and so do
    rows without a key or a time.

    No pair is formed: anchors and events lie in one order of time, and each anchor takes the
    last event carried up to it (or the first one after it), so the work grows with the rows
    of both, not with their product. An anchor looks into two slots at most. Slots of one key with
    more than ``group_rows`` rows and more than a task's share are split by time (``_split``).
    """
    if pick not in ("closest", "farthest"):
        raise ValueError(f"pick must be 'closest' or 'farthest', not {pick!r}")
    on, width = _keys(on), _width(before, after)
    low, high = times.bounds(t0, before, after)
    probes = _probes(pick, F.col(t0), low, high, before, after)
    named = [F.col(c).isNotNull() for c in on]
    points = F.array(*[F.struct(point.alias("at"), F.lit(back).alias("back")) for point, back in probes])
    left = (
        anchor.where(reduce(and_, named))
        .select("*", F.explode(F.sequence(slot(low, width), slot(high, width))).alias(_SLOT), low.alias("_low"), high.alias("_high"))
        .select("*", F.explode(points).alias("_p"))
        .select(*on, _SLOT, F.col("_p.at").alias("_at"), F.lit(1).alias("_side"), F.col("_p.back").alias("_back"),
                F.struct("_low", "_high", *[c for c in anchor.columns if c not in on]).alias("_anchor"))
    )
    own = [c for c in events.columns if c not in on]
    right = events.where(reduce(and_, named)).select(
        *on, slot(t, width).alias(_SLOT), F.col(t).alias("_at"), F.lit(0).alias("_side"), F.col(tie).alias("_tie"),
        F.struct(*own).alias("_event")
    )
    rows = right.unionByName(left, allowMissingColumns=True)
    carried = _carried(rows, on, {back for _, back in probes}, group_rows).where("_side = 1").drop("_at", "_side", "_tie")
    found = carried.where(F.col(f"_found.{t}").between(F.col("_anchor._low"), F.col("_anchor._high")))
    pairs = found.select(*on, "_anchor.*", "_found.*").drop("_low", "_high")
    gap = F.abs(F.col(t0) - F.col(t))
    if pick == "farthest":
        gap = -gap
    key = list(key) if key else list(anchor.columns)
    kept = [c for c in pairs.columns if c not in key]
    best = F.min_by(F.struct(*kept), F.struct(gap, F.col(tie)))
    return pairs.groupBy(*key).agg(best.alias("_row")).select(*key, "_row.*").select(*pairs.columns)


def _probes(pick, t0, low, high, before, after):
    """Where an anchor looks: (time, backwards?). The wanted event is the nearest found from one of them."""
    if pick == "farthest":
        return [(low, False)] * (before > 0 or after <= 0) + [(high, True)] * (after > 0)
    if before <= 0:
        return [(t0 if before == 0 else low, False)]
    if after <= 0:
        return [(t0 if after == 0 else high, True)]
    return [(t0, True), (t0, False)]


def _order(back):
    # at one time events come before anchors, and the one with the smallest tie comes last
    return [F.col("_at").asc() if back else F.col("_at").desc(), F.col("_side"), F.col("_tie").desc()]


def _carry(group, back):
    """The event of the group that was met last on the way to a row."""
    upto = group.orderBy(*_order(back)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last("_event", ignorenulls=True).over(upto)


def _toward(backs, value):
    """``value(back)`` in the direction in which an anchor looks."""
    if len(backs) == 1:
        return value(*backs)
    return F.when(F.col("_back"), value(True)).otherwise(value(False))


def _carried(rows, on, backs, group_rows):
    """Anchor rows with ``_found``, the event carried to them inside (key, slot)."""
    by = [*on, _SLOT]
    largest = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    buckets = ordered.default_buckets(rows.sparkSession)
    hot = ordered.hot_keys(rows, by, buckets, group_rows)
    some = hot.collect() if largest > group_rows else []  # at most ``buckets`` rows
    if not some:
        return rows.withColumn("_found", _toward(backs, lambda back: _carry(Window.partitionBy(*by), back)))
    hot = F.broadcast(rows.sparkSession.createDataFrame(some, hot.schema))
    rest = rows.join(hot, by, "left_anti")
    rest = rest.withColumn("_found", _toward(backs, lambda back: _carry(Window.partitionBy(*by), back)))
    return rest.unionByName(_split(rows.join(hot, by), by, backs, buckets))


def _split(rows, by, backs, buckets):
    """The same for groups too big for one task: cut by time, each cut begins with what the ones before hand on.

    Events of one key and time count as the one with the smallest tie, which is found before
    the shuffle, so even one time repeated without end is no big group.
    """
    same = rows.where("_side = 0").groupBy(*by, "_at").agg(F.min_by(F.struct("_tie", "_event"), F.struct("_tie")).alias("_e"))
    events = same.select(*by, "_at", F.lit(0).alias("_side"), "_e.*")
    rows = events.unionByName(rows.where("_side = 1"), allowMissingColumns=True)
    coded = ordered.with_buckets(rows, ["_at"], buckets)
    bucket = ordered.BUCKET
    ends = coded.groupBy(*by, bucket).agg(
        *[(F.max_by if back else F.min_by)("_event", F.when(F.col("_side") == 0, F.col("_at"))).alias(f"_end{back:d}") for back in backs]
    )

    def before(back):
        place = F.col(bucket).asc() if back else F.col(bucket).desc()
        group = Window.partitionBy(*by).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
        return F.last(f"_end{back:d}", ignorenulls=True).over(group).alias(f"_before{back:d}")

    # one row per hot group and cut
    handed = ends.select(*by, bucket, *[before(back) for back in backs])
    joined = coded.join(handed, [*by, bucket])
    group = Window.partitionBy(*by, bucket)
    found = _toward(backs, lambda back: F.coalesce(_carry(group, back), F.col(f"_before{back:d}")))
    return joined.withColumn("_found", found).drop(bucket, *[f"_before{back:d}" for back in backs])


def rank(pairs, key, t0, t, tie, out="gap_rank", signed=False):
    """Number the events of each anchor by their gap in seconds to ``t0``, ties by ``tie``.

    ``signed`` ranks by ``t - t0`` instead of its absolute value, which puts the
    farthest earlier event first.
    """
    gap = times.seconds(t0, t)
    gap = gap if signed else F.abs(gap)
    key = _keys(key)
    return ordered.row_numbers(pairs.withColumn("gap_seconds", gap), key, ["gap_seconds", tie], out)
