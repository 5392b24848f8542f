"""Timestamps without zone: parsing, window bounds, whole-second differences."""

from pyspark.sql import functions as F

# Far enough back that every difference from it is positive, so that dividing
# the difference rounds down.
_ORIGIN = "timestamp_ntz'0001-01-01 00:00:00'"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def parse_study_time(date, time, strict=True):
    """Text date ``yyyyMMdd`` and text time ``Hmmss[.fff]`` to a timestamp.

    The fraction is cut and lost leading zeros of the hour are put back. An
    unparsable value is an error, or null with ``strict=False``. The fields are
    cut out by position, several times faster than a date pattern.
    """
    day = _col(date)
    clock = F.lpad(F.split_part(_col(time), F.lit("."), F.lit(1)), 6, "0")
    fields = [
        F.substring(day, 1, 4),
        F.substring(day, 5, 2),
        F.substring(day, 7, 9),
        F.substring(clock, 1, 2),
        F.substring(clock, 3, 2),
        F.substring(clock, 5, 2),
    ]
    if strict:
        return F.make_timestamp_ntz(*[f.cast("int") for f in fields])
    return F.try_make_timestamp_ntz(*[f.try_cast("int") for f in fields])


def hours(n):
    """An interval of whole hours."""
    if n != int(n):
        raise ValueError(f"windows are given in whole hours, not {n}")
    return F.make_dt_interval(hours=F.lit(int(n)))


def bounds(t, before, after=0):
    """(t - before, t + after) for whole hours."""
    t = _col(t)
    return t - hours(before), t + hours(after)


def since_origin(t, unit):
    """How many whole intervals ``unit`` lie between a fixed origin and ``t``, exactly.

    Interval arithmetic stays without zone; ``timestampdiff`` would go through
    the session's.
    """
    return F.call_function("div", _col(t).cast("timestamp_ntz") - F.expr(_ORIGIN), unit)


def micros(t):
    """Microseconds since a fixed origin."""
    return since_origin(t, F.expr("interval '0.000001' second"))


def seconds(a, b):
    """Signed count of second boundaries crossed from ``a`` to ``b``.

    Counting boundaries (not elapsed whole seconds) makes 23:59:59.5 lie one
    second before 00:00:00.
    """
    second = F.expr("interval '1' second")
    return since_origin(b, second) - since_origin(a, second)


def age(anchor_age, anchor_year, at):
    """Age at ``at`` given the age in an anchor year."""
    return (_col(anchor_age) + F.year(_col(at)) - _col(anchor_year)).cast("long")
