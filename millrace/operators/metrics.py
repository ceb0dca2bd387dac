"""Model evaluation on (label, prediction) or (label, score) columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import running_total
from millrace.session import materialize


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return df.agg(F.avg(F.when(F.col(label) == F.col(pred), 1.0).otherwise(0.0)).alias("accuracy"))


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction", classes: list | None = None) -> DataFrame:
    """Count of every (label, prediction) pair of the classes, absent pairs as 0.

    The counts form a classes × classes grid, so this is for class labels, not
    for free values; without ``classes`` the values found in either column count.
    """
    counts = df.dropna(subset=[label, pred]).groupBy(
        F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(F.count("*").alias("n"))
    if classes is None:
        found = counts.select(F.explode(F.array("label", "prediction")).alias("c")).distinct().collect()
        classes = sorted(r.c for r in found)
    kind = counts.schema["label"].dataType.simpleString()
    every = F.array(*[F.lit(c).cast(kind) for c in classes])
    spark = df.sparkSession
    grid = (
        spark.range(1).select(F.explode(every).alias("label"))
        .select("label", F.explode(every).alias("prediction"))
    )
    return grid.join(counts, ["label", "prediction"], "left").fillna({"n": 0})


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction", classes: list | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class with macro and weighted means.

    An undefined ratio counts as 0. Computed from the counts of all rows with a
    label, one row per class: a missing prediction, or one outside ``classes``,
    counts as a miss. ``classes`` only selects (and adds) the classes shown.
    """
    cells = df.filter(F.col(label).isNotNull()).groupBy(
        F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(F.count("*").alias("n"))
    hit = F.col("label").eqNullSafe(F.col("prediction"))
    sides = cells.select(
        F.explode(F.array(
            F.struct(F.col("label").alias("class"), F.when(hit, F.col("n")).otherwise(0).alias("tp"),
                     F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
            F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("tp"),
                     F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
        )).alias("s")
    ).select("s.*").filter(F.col("class").isNotNull())
    if classes is not None:
        kind = cells.schema["label"].dataType.simpleString()
        none = F.lit(0).cast("long")
        shown = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c).cast(kind) for c in classes])).alias("class"))
        sides = sides.join(F.broadcast(shown), "class", "left_semi").unionByName(
            shown.select("class", none.alias("tp"), none.alias("support"), none.alias("predicted")))
    zero = F.lit(0.0)
    per = (
        sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
        .withColumns({
            "precision": F.coalesce(F.try_divide("tp", "predicted"), zero),
            "recall": F.coalesce(F.try_divide("tp", "support"), zero),
        })
        .withColumn("f1", F.coalesce(
            F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero))
        .select(F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support")
    )
    names = ("precision", "recall", "f1")
    weighted = [
        F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")), zero).alias(c) for c in names
    ]
    macro = per.agg(*[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    weigh = per.agg(*weighted, F.sum("support").alias("support"))
    return (
        per.unionByName(macro.withColumn("class", F.lit("macro avg")))
        .unionByName(weigh.withColumn("class", F.lit("weighted avg")))
    )


def _score_steps(df: DataFrame, label: str, score: str, buckets: int) -> DataFrame:
    """Per distinct score, falling: own and preceding positives and negatives.

    Folding equal scores first keeps a hot score to one row; the running counts
    are made range by range (see ``ranking``). ``P`` and ``N`` are the totals.
    """
    known = df.dropna(subset=[label, score])
    steps = materialize(known.groupBy((-F.col(score).cast("double")).alias("_order")).agg(
        F.count_if(F.col(label) == 1).alias("tp"), F.count_if(F.col(label) != 1).alias("fp")), "steps")
    p, n = steps.agg(F.sum("tp"), F.sum("fp")).first()
    run = running_total(steps, "_order", ["tp", "fp"], buckets=buckets, stored=True)
    return run.withColumns({
        "score": -F.col("_order"), "P": F.lit(p).cast("long"), "N": F.lit(n).cast("long")})


def roc_points(df: DataFrame, label: str = "label", score: str = "score", buckets: int = 64) -> DataFrame:
    """False and true positive rate at every distinct score used as threshold."""
    s = _score_steps(df, label, score, buckets)
    return s.select(
        "score",
        F.try_divide(F.col("fp_before") + F.col("fp"), "N").alias("fpr"),
        F.try_divide(F.col("tp_before") + F.col("tp"), "P").alias("tpr"),
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", buckets: int = 64) -> DataFrame:
    """Area under the ROC curve by trapezoids; null when a class is missing."""
    s = _score_steps(df, label, score, buckets)
    area = F.sum(F.col("fp") * (F.col("tp_before") + F.col("tp") / 2))
    return s.agg(F.try_divide(area, F.max(F.col("P").cast("double") * F.col("N"))).alias("auc"))


def _pr(s: DataFrame) -> DataFrame:
    seen = F.col("tp_before") + F.col("fp_before")
    return s.withColumns({
        "precision": (F.col("tp_before") + F.col("tp")) / (seen + F.col("tp") + F.col("fp")),
        "recall": F.try_divide(F.col("tp_before") + F.col("tp"), "P"),
        "_precision_before": F.coalesce(F.try_divide("tp_before", seen), F.lit(1.0)),
    })


def pr_points(df: DataFrame, label: str = "label", score: str = "score", buckets: int = 64) -> DataFrame:
    """Precision and recall at every distinct score, and the end point (0, 1) with null score."""
    curve = _pr(_score_steps(df, label, score, buckets)).select("score", "precision", "recall")
    spark = df.sparkSession
    end = spark.range(1).select(
        F.lit(None).cast("double").alias("score"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return curve.unionByName(end)


def pr_auc(df: DataFrame, label: str = "label", score: str = "score", buckets: int = 64) -> DataFrame:
    """Area under the precision–recall curve by trapezoids, from recall 0 and precision 1."""
    s = _pr(_score_steps(df, label, score, buckets))
    width = F.try_divide(F.col("tp").cast("double"), "P")
    return s.agg(F.sum(width * (F.col("precision") + F.col("_precision_before")) / 2).alias("pr_auc"))


def rmse(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    d = F.col(label) - F.col(pred)
    return df.agg(F.sqrt(F.avg(d * d)).alias("rmse"))
