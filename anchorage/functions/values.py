"""Scalar value rules: conditional values, source preference, merged extrema, scores."""

from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def when_item(item, codes, value):
    """The value where the item code is one of ``codes``, else null."""
    return F.when(_col(item).isin(list(codes)), _col(value))


def prefer(*sources):
    """First non-null in the order given."""
    return F.coalesce(*[_col(s) for s in sources])


def merge_min(*sources):
    """Smallest non-null."""
    return F.least(*[_col(s) for s in sources])


def merge_max(*sources):
    """Largest non-null."""
    return F.greatest(*[_col(s) for s in sources])


def sigmoid(logit):
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(logit)))


def bce_with_logits(logit, label, weight=1.0):
    """Cross-entropy of one row from its logit, positives weighted; stable for large logits."""
    z, y = _col(logit).cast("double"), _col(label).cast("double")
    tail = F.log1p(F.exp(-F.abs(z)))
    on_negative = F.greatest(z, F.lit(0.0)) + tail
    on_positive = F.greatest(-z, F.lit(0.0)) + tail
    return F.lit(float(weight)) * y * on_positive + (F.lit(1.0) - y) * on_negative
