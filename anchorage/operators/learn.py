"""Vectors for training and a class-weighted linear baseline."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F


def fuse(a, b, on, left="a", right="b", out="fused"):
    """Join two per-row vectors and concatenate them."""
    return a.join(b, on, "inner").select(
        *([on] if isinstance(on, str) else on), F.concat(F.col(left), F.col(right)).alias(out)
    )


def fit_baseline(train, features, label, weight=None, max_iter=200, tol=1e-9):
    """Logistic regression on the tabular features; positives count ``weight`` times.

    ``weight=None`` takes negatives / positives of the training rows. The fit runs
    as aggregates over the partitions of ``train``; it is an error if it has not
    converged to ``tol`` after ``max_iter`` rounds.
    """
    y = F.col(label).cast("double")
    if weight is None:
        counts = train.agg(F.sum(y).alias("p"), F.count(label).alias("n")).first()
        if not counts["p"]:
            raise ValueError(f"no training row has a positive {label}, so none can be weighted")
        weight = (counts["n"] - counts["p"]) / counts["p"]
    rows = train.where(F.col(label).isNotNull()).select(
        *features,
        y.alias("_label"),
        F.when(y == 1.0, F.lit(float(weight))).otherwise(F.lit(1.0)).alias("_weight"),
    )
    steps = [
        VectorAssembler(inputCols=list(features), outputCol="_vector"),
        LogisticRegression(
            featuresCol="_vector", labelCol="_label", weightCol="_weight", maxIter=max_iter, tol=tol
        ),
    ]
    model = Pipeline(stages=steps).fit(rows)
    if model.stages[-1].summary.totalIterations >= max_iter:
        raise ValueError(f"the baseline has not converged in {max_iter} rounds")
    return model


def gradients(model, df, features, label, weight):
    """(term, rows, positives, gradient): mean weighted derivative of the loss by each standardised term.

    All are near zero on the rows a converged model was fitted to, whatever fitted it.
    """
    y = F.col(label).cast("double")
    scored = score(model, df.where(F.col(label).isNotNull()), "_p", "_logit")
    pull = (F.col("_p") - y) * F.when(y == 1.0, F.lit(float(weight))).otherwise(1.0)
    terms = {"intercept": F.avg(pull)}
    for c in features:
        terms[c] = F.try_divide(F.avg(pull * F.col(c)), F.stddev_samp(c))
    one = scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(y).cast("long").alias("positives"),
        F.array(*[F.struct(F.lit(k).alias("term"), v.alias("gradient")) for k, v in terms.items()]).alias("t"),
    )
    return one.select("rows", "positives", F.inline("t")).select("term", "rows", "positives", "gradient")


def score(model, df, out="score", logit="logit"):
    """Append the logit and the probability of the positive class."""
    scored = model.transform(df)
    return (
        scored.withColumn(logit, vector_to_array("rawPrediction")[1])
        .withColumn(out, vector_to_array("probability")[1])
        .drop("_vector", "rawPrediction", "probability", "prediction")
    )
