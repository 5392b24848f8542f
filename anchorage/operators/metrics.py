"""Scores of a binary classifier from a table of (score, label) rows.

Everything derives from one curve: rows are first collapsed to one per distinct
score, then running counts are taken in descending score order without a global
window (see ``ordered``). ``by`` evaluates many models or epochs in the same job.

A group with only one class has no area (null); without positives its average
precision is 0 and its sensitivity null, without negatives its sensitivity is 0.
"""

from pyspark.sql import functions as F

from anchorage.functions import values
from anchorage.operators import ordered

METRICS = ("AUROC", "AUPRC", "sens_at_95_spec")


def _list(by):
    return [by] if isinstance(by, str) else list(by)


def curve(df, score, label, by=(), buckets=None):
    """(by, score, rows, pos, neg, tp, fp, tp_total, fp_total), one row per distinct score.

    ``tp`` and ``fp`` count the rows scored at least as high. Rows without score
    or label do not count.
    """
    by = _list(by)
    y = F.col(label).cast("long")
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        *by, F.col(score).cast("double").alias("score"), y.alias("pos"), (1 - y).alias("neg")
    )
    cells = known.groupBy(*by, "score").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    # few models or epochs, each with very many scores
    return ordered.running_sums(
        cells,
        by,
        ["score"],
        {"tp": "pos", "fp": "neg"},
        buckets,
        descending=True,
        totals=("tp", "fp"),
        split_all=True,
        made_from=known,
    )


def _tpr():
    return F.try_divide("tp", "tp_total")


def _fpr():
    return F.try_divide("fp", "fp_total")


def roc(df, score, label, by=(), buckets=None, origin=True):
    """(by, threshold, fpr, tpr), every distinct score kept; the origin has an infinite threshold."""
    by = _list(by)
    points = curve(df, score, label, by, buckets)
    cells = F.struct(
        F.col("score").alias("threshold"), _fpr().alias("fpr"), _tpr().alias("tpr")
    )
    if not origin:
        return points.select(*by, "score", cells.alias("p")).select(*by, "p.*")
    # the first running count of each group is its highest score
    top = (F.col("tp") + F.col("fp")) == F.col("rows")
    start = F.struct(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    both = F.when(top, F.array(start, cells)).otherwise(F.array(cells))
    return points.select(*by, F.inline(both))


def _auroc():
    # each tied group of negatives beats half of the positives tied with it
    area = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / F.lit(2.0)))
    return F.try_divide(area, F.max("tp_total").cast("double") * F.max("fp_total"))


def _average_precision():
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return F.coalesce(F.sum(F.try_divide("pos", "tp_total") * precision), F.lit(0.0))


def _sensitivity(spec):
    found = F.max(F.when(_fpr() <= F.lit(round(1 - spec, 12)), _tpr()))
    return F.when(F.max("tp_total") > 0, F.coalesce(found, F.lit(0.0)))


def from_curve(points, by=(), spec=0.95):
    """The three metrics of each group from its curve, in one aggregate."""
    by = _list(by)
    return points.groupBy(*by).agg(
        _auroc().alias("AUROC"),
        _average_precision().alias("AUPRC"),
        _sensitivity(spec).alias(f"sens_at_{100 * spec:g}_spec"),
    )


def auroc(df, score, label, by=()):
    """Area under the ROC curve; ties count one half."""
    by = _list(by)
    return curve(df, score, label, by).groupBy(*by).agg(_auroc().alias("AUROC"))


def average_precision(df, score, label, by=()):
    """Sum of precision over recall steps (the step form, not a trapezoid)."""
    by = _list(by)
    return curve(df, score, label, by).groupBy(*by).agg(_average_precision().alias("AUPRC"))


def sens_at_spec(df, score, label, by=(), spec=0.95):
    """Best true-positive rate among thresholds whose false-positive rate is at most 1 - spec."""
    by = _list(by)
    return curve(df, score, label, by).groupBy(*by).agg(_sensitivity(spec).alias("sensitivity"))


def weighted_bce(df, logit, label, weight, by=()):
    """Mean class-weighted cross-entropy from logits."""
    loss = F.avg(values.bce_with_logits(logit, label, weight)).alias("loss")
    return df.groupBy(*_list(by)).agg(loss)


def report(df, logit, label, weight, by=(), spec=0.95):
    """Loss and the three metrics per group, scores being the sigmoid of the logits.

    The loss rides along the collapsed scores, so the rows are read once.
    """
    by = _list(by)
    # the sigmoid is monotone, so the curve of the logits is the curve of the scores
    points = curve(df, logit, label, by)
    one = F.lit(1)
    zero = F.lit(0)
    loss = F.sum(
        F.col("pos") * values.bce_with_logits("score", one, weight)
        + F.col("neg") * values.bce_with_logits("score", zero, weight)
    ) / F.sum("rows")
    return points.groupBy(*by).agg(
        loss.alias("loss"),
        _auroc().alias("AUROC"),
        _average_precision().alias("AUPRC"),
        _sensitivity(spec).alias(f"sens_at_{100 * spec:g}_spec"),
    )


def epoch_loss(log, epoch="epoch", loss="loss", rows=None):
    """Mean of the batch losses per epoch; with ``rows`` also the mean weighted by batch size."""
    aggs = [F.avg(loss).alias("mean_loss")]
    if rows:
        known = F.sum(F.when(F.col(loss).isNotNull(), F.col(rows)))
        weighted = F.try_divide(F.sum(F.col(loss) * F.col(rows)), known)
        aggs.append(weighted.alias("row_mean_loss"))
    return log.groupBy(epoch).agg(*aggs)


def best(df, metric, mode="higher", epoch="epoch"):
    """The row of the earliest epoch with the best value of the metric."""
    if mode not in ("higher", "lower"):
        raise ValueError(f"mode must be 'higher' or 'lower', not {mode!r}")
    sign = F.lit(-1) if mode == "higher" else F.lit(1)
    scored = df.where(F.col(metric).isNotNull())
    row = F.min_by(F.struct(*df.columns), F.struct(sign * F.col(metric), F.col(epoch)))
    return scored.agg(row.alias("r")).where("r is not null").select("r.*")
